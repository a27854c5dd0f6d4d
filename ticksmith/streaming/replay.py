"""Replay of a feed in many batches, stopped and resumed between them.

A ``Replay`` has one folder of files a source.  Each ``step`` appends the files of
one arrival batch, starts the query anew on its checkpoint, lets it process
what is there and stops it: every step is one micro-batch of new rows, followed by
Spark's batch without rows when the watermark moved.  What a step sees therefore
depends on its number only, never on file times, so a replay can be
compared with plain SQL.

``admitted_stream`` passes on the ticks that the bars' watermark admits, each
(partition, seq) once, however often the log delivers it; ``admission`` says the
same from stored ticks with their batch numbers: the report of what the bars left out.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ticksmith.functions.timefn import floor_time, instant_to_utc, parse_instant, parse_to_utc
from ticksmith.operators.bars import BAR_WIDTH
from ticksmith.streaming.jobs import DEFAULT_DELAY, run_available_now, skew_bound, too_early

# What became of a tick.
ADMITTED, LATE, AHEAD, UNREADABLE = "admitted", "late", "ahead", "unreadable"


class Replay:
    """A streaming query fed one arrival batch at a time.

    ``sources`` names the schema of each source; ``build`` gets a stream of each, by
    name, and returns the query's rows.  ``root`` is a folder every executor shares.
    """

    def __init__(self, spark: SparkSession, root: str, sources: Mapping[str, StructType],
                 build: Callable[..., DataFrame], partition_col: str | None = None):
        self.spark, self.root, self.sources = spark, root.rstrip("/"), dict(sources)
        self.build, self.partition_col = build, partition_col
        self.progress: list[dict] = []
        for name, schema in self.sources.items():      # a stream needs its folder, and a batch may have no rows
            spark.createDataFrame([], schema).write.mode("append").parquet(self._log(name))

    def _log(self, name: str) -> str:
        return f"{self.root}/source={name}"

    @property
    def out(self) -> str:
        return f"{self.root}/out"

    def step(self, **rows: DataFrame) -> StreamingQuery:
        """One batch of some of the sources: written, processed from the checkpoint, stopped."""
        for name, df in rows.items():
            df.select(*self.sources[name].fieldNames()).write.mode("append").parquet(self._log(name))
        streams = {n: self.spark.readStream.schema(s).parquet(self._log(n)) for n, s in self.sources.items()}
        query = run_available_now(self.build(**streams), self.out, f"{self.root}/checkpoint", self.partition_col)
        self.progress += [p for p in query.recentProgress]
        return query

    def run(self, rows: DataFrame, batch: str, source: str) -> Replay:
        """Every value of the column ``batch`` of ``rows``, in ascending order, as a step of ``source``.

        Only the numbers of the batches come to the driver.
        """
        for r in rows.select(batch).where(F.col(batch).isNotNull()).distinct().orderBy(batch).toLocalIterator():
            self.step(**{source: rows.where(F.col(batch) == r[0])})
        return self

    def read(self, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.out)


def admitted_stream(ticks: DataFrame, delay: str = DEFAULT_DELAY, width: str = BAR_WIDTH,
                    max_skew: str | None = None) -> DataFrame:
    """The ticks whose bar the watermark holds open, with the bar's start and end; one row a (partition, seq).

    The same bounds as ``bar_stream``: a tick goes when its time is unreadable or too
    far ahead of its arrival, or its bar's end isn't after the watermark.  State
    is a key for each tick of the open bars.
    """
    ticks = ticks.filter(~too_early(ticks, skew_bound(delay, max_skew)))
    timed = ticks.withColumn("_event_ts", parse_instant(F.col("fetched_at"))).filter(F.col("_event_ts").isNotNull())
    keys = [c for c in ("partition", "seq") if c in ticks.columns]
    barred = timed.withWatermark("_event_ts", delay).withColumn("_bar", F.window("_event_ts", width))
    once = barred.dropDuplicates([*keys, "_bar"])
    return once.select(*ticks.columns, instant_to_utc(F.col("_bar.start")).alias("window_start"),
                       instant_to_utc(F.col("_bar.end")).alias("window_end"))


def admitted_schema(ticks: StructType) -> StructType:
    """Columns that ``admitted_stream`` gives for ticks of this schema."""
    return StructType([*ticks.fields]).add("window_start", "timestamp_ntz").add("window_end", "timestamp_ntz")


def admission(ticks: DataFrame, batch: str, delay: str = DEFAULT_DELAY, width: str = BAR_WIDTH,
              max_skew: str | None = None) -> DataFrame:
    """``ticks`` with the watermark that met them and their ``verdict``, from stored ticks and their batches.

    A batch's watermark is the largest admissible time of the batches before it, less
    ``delay`` (null before the first one).  The ticks are pre-aggregated to one row a batch, those
    rows pass through one task, and the ticks are joined with them.  Rows whose
    batch is null met no watermark.
    """
    skew = skew_bound(delay, max_skew)
    at = parse_to_utc(F.col("fetched_at"))
    ahead: Column = too_early(ticks, skew)
    judged = ticks.withColumns({"_at": at, "_ahead": ahead})
    before = Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -1)
    marks = (judged.where(F.col(batch).isNotNull()).groupBy(batch).agg(F.max(F.when(~F.col("_ahead"), F.col("_at"))).alias("_top"))
             .select(batch, (F.max("_top").over(before) - F.expr(f"INTERVAL {delay}")).alias("watermark")))
    end = floor_time(F.col("_at"), width) + F.expr(f"INTERVAL {width}")
    verdict = (F.when(F.col("_at").isNull(), UNREADABLE).when(F.col("_ahead"), AHEAD)
               .when(end <= F.col("watermark"), LATE).otherwise(ADMITTED))
    return judged.join(marks, batch, "left").withColumn("verdict", verdict).drop("_at", "_ahead")
