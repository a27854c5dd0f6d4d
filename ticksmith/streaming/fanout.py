"""One-pass fan-out and bars that late ticks repair — operators K3, K4, R5.

``start_fan_out`` is one streaming query.  Each micro-batch is read and parsed
once and leaves three results under its batch id: bronze rows, rejected
messages, and parts of bars.  A batch is a folder ``batch_id=<n>`` that is
written whole (``mode('overwrite')``), so a replayed batch replaces itself, and
counts once its ``_SUCCESS`` file is there.

Bars are stored as mergeable parts (``operators.bars.bar_parts``): a tick that
comes after its window closed adds a part, and ``BarStore.read`` merges the
parts of a (ticker, window), so it changes the stored bar, once, whether or not
its batch was replayed and however late it is.  No state store, watermark or
read of bronze is needed.  ``BarStore.compact`` folds the batches so far into
month versions; the manifest that makes these current also names the last batch
they hold, so a part is never counted twice.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ticksmith.functions.timefn import month_key, parse_to_utc
from ticksmith.operators.bars import bar_parts, merge_parts
from ticksmith.operators.ingest import parse_messages, quarantined, sink_time, to_bronze
from ticksmith.plans.manifest import PART_COL, MonthTable
from ticksmith.schemas import LOG_BRONZE, STORED_BAR, conform
from ticksmith.streaming.jobs import DEFAULT_DELAY, REJECT_TOO_EARLY, too_early

BATCH_COL = "batch_id"
REJECTED = T.StructType([T.StructField("seq", T.LongType()), T.StructField("key", T.StringType()),
                         T.StructField("raw_value", T.StringType()), T.StructField("reason", T.StringType())])


def _month(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(PART_COL, month_key(F.col(column)))


def write_batch(rows: DataFrame, path: str, batch_id: int, schema: T.StructType, part_col: str | None = None) -> None:
    """The rows of one micro-batch, in place of whatever an earlier attempt left."""
    full = T.StructType([*schema.fields, *([T.StructField(part_col, T.IntegerType())] if part_col else [])])
    w = conform(rows, full).write.mode("overwrite")
    (w.partitionBy(part_col) if part_col else w).parquet(f"{path.rstrip('/')}/{BATCH_COL}={batch_id}")


def finished_batches(spark: SparkSession, path: str) -> list[int]:
    """Batches whose write is complete, ascending (a listing)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    found = []
    for s in fs.listStatus(hpath):
        name = s.getPath().getName()
        if name.startswith(f"{BATCH_COL}=") and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
            found.append(int(name.partition("=")[2]))
    return sorted(found)


def read_batches(spark: SparkSession, path: str, schema: T.StructType, part_col: str | None = None, after: int = -1) -> DataFrame:
    """Rows of the finished batches above ``after``, with their batch id; a month column prunes."""
    more = [T.StructField(BATCH_COL, T.LongType()), *([T.StructField(part_col, T.IntegerType())] if part_col else [])]
    full = T.StructType([*schema.fields, *more])
    paths = [f"{path.rstrip('/')}/{BATCH_COL}={n}" for n in finished_batches(spark, path) if n > after]
    if not paths:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(*paths)


class BarStore:
    """5-minute bars under ``path``: ``parts`` by batch, ``months`` compacted."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.parts = spark, f"{path.rstrip('/')}/parts"
        self.months = MonthTable(spark, f"{path.rstrip('/')}/months", STORED_BAR, ["ticker", "window_start"])

    def add(self, bronze: DataFrame, batch_id: int) -> None:
        """The parts of a batch of bronze rows; ticks without a readable time have no bar."""
        timed = bronze.withColumn("_time", parse_to_utc(F.col("fetched_at")))
        parts = bar_parts(timed, "_time").withColumn("inserted_at", sink_time())
        write_batch(_month(parts, "window_start"), self.parts, batch_id, STORED_BAR, PART_COL)

    def _fresh(self, state: dict) -> DataFrame:
        return read_batches(self.spark, self.parts, STORED_BAR, PART_COL, state["notes"].get("through", -1)).drop(BATCH_COL)

    def read(self) -> DataFrame:
        """All bars as they are now (``STORED_BAR`` columns)."""
        state = self.months.state()
        both = self.months.read(state=state).unionByName(self._fresh(state))
        return merge_parts(both).select(*STORED_BAR.fieldNames())

    def compact(self) -> None:
        """Fold the finished batches into month versions; only months that they touch are rewritten."""
        state = self.months.state()
        through = max(finished_batches(self.spark, self.parts), default=-1)
        if through <= state["notes"].get("through", -1):
            return
        fresh = self._fresh(state)
        touched = sorted(r[PART_COL] for r in fresh.select(PART_COL).distinct().toLocalIterator())
        merged = merge_parts(self.months.read(touched, state).unionByName(fresh))
        version, found = self.months.write(_month(merged, "window_start"))
        self.months.commit(state, {m: {"version": version, "taken": None} for m in found}, {**state["notes"], "through": through})


def ingest_batch(messages: DataFrame, batch_id: int, bronze_path: str, rejects_path: str, bars_path: str,
                 max_skew: str = DEFAULT_DELAY) -> None:
    """Parse a micro-batch once and write its bronze rows, rejects and bar parts.

    The parsed rows are kept on the executors' disks while the three are written;
    a lost executor's share is read and parsed again.
    """
    parsed = parse_messages(messages)
    if "inserted_at" not in parsed.columns:
        parsed = parsed.withColumn("inserted_at", sink_time())
    ahead = too_early(parsed, max_skew)
    parsed = parsed.withColumn("_ahead", ahead).persist(StorageLevel.DISK_ONLY)
    try:
        bronze = to_bronze(parsed.where("reject IS NULL"), F.col("inserted_at"))
        write_batch(_month(bronze, "inserted_at"), bronze_path, batch_id, LOG_BRONZE, PART_COL)
        reason = F.coalesce("reject", F.when(F.col("_ahead"), F.lit(REJECT_TOO_EARLY)))
        write_batch(quarantined(parsed.withColumn("reject", reason)), rejects_path, batch_id, REJECTED)
        kept = to_bronze(parsed.where("reject IS NULL AND NOT _ahead"), F.col("inserted_at"))
        BarStore(messages.sparkSession, bars_path).add(kept, batch_id)
    finally:
        parsed.unpersist()


def start_fan_out(messages: DataFrame, bronze_path: str, rejects_path: str, bars_path: str, checkpoint: str,
                  trigger: dict | None = None, max_skew: str = DEFAULT_DELAY, query_name: str | None = None) -> StreamingQuery:
    """K4: bronze, rejects and bars from one read and one parse of the topic.

    Ticks stamped more than ``max_skew`` ahead of their arrival stay out of the bars and are
    among the rejects, with the reason; bronze keeps them.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, batch_id, bronze_path, rejects_path, bars_path, max_skew)

    w = (messages.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(**(trigger or {"processingTime": "1 minute"})))
    return (w.queryName(query_name) if query_name else w).start()


__all__ = ["BarStore", "finished_batches", "ingest_batch", "read_batches", "start_fan_out", "write_batch"]
