"""Structured Streaming jobs — operators K2, K3, K4, R1-R8, X1-X5.

The reference runs one consumer that fans out to a raw-tick sink and a
keyed 5-minute window.  Here each sink is its own streaming query with its
own checkpoint (K4): the bronze query appends every parsed tick, the bar
query aggregates.  Both use Spark's exactly-once file sink and resume from
their checkpoint after a restart or a lost executor (R8) — the reference
has no checkpointing and starts at ``latest``.

Time (R2-R5): bars are built on **event time** by default — the parsed
``fetched_at`` instant — with a watermark (``delay``), and are emitted once
in append mode when the watermark passes the bar end (R4).  Late ticks
behind the watermark are dropped from the bar stream and counted by Spark
(``numRowsDroppedByWatermark``); bronze keeps every tick, so a batch
``ohlc_bars`` over bronze is the repair path (R5).  ``time_mode='arrival'``
is the reference's processing-time behaviour: the broker append time when
the source has one, else the micro-batch time.

Quiet streams (R4): Spark moves the watermark only when rows arrive, so in
arrival mode the last open bar would wait for the next tick, while the
reference closes it on the wall clock.  ``heartbeat`` unions the ticks with
Spark's ``rate`` source: its rows carry only the clock, advance the
watermark through the same ``withWatermark``, and fall out after the
aggregation (their group counts no ticks), so a bar is emitted about one
trigger after ``window end + delay`` whether or not ticks keep coming.  The
filter sits on an aggregate output on purpose: a filter on ``ticker`` would
be pushed below the watermark and hide the heartbeats from it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticksmith.functions.timefn import instant_to_utc, month_key, parse_instant, width_micros
from ticksmith.operators.bars import BAR_WIDTH, ohlc_bars
from ticksmith.operators.ingest import (observe_parsed, parse_messages, parsed_ticks, quarantined,
                                        sink_time, to_bronze)

# Fixed value: default allowed lateness for the bar stream.
DEFAULT_DELAY = "10 minutes"

# Fixed value: the reason given for a tick whose time is too far ahead of its arrival.
REJECT_TOO_EARLY = "time_ahead_of_arrival"


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state_store(spark: SparkSession) -> None:
    """Keep streaming state (one row per open ticker-bar) in RocksDB instead
    of executor heap, for key counts beyond what fits in memory.  Leaves an
    existing choice alone; call before the first query starts (the provider
    of a checkpoint cannot change afterwards)."""
    key = "spark.sql.streaming.stateStore.providerClass"
    current = spark.conf.get(key, None)
    if not current or current.endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set(key, ROCKSDB_PROVIDER)


# Fixed value: name of the per-micro-batch ingest counters of the bronze query.
INGEST_METRICS = "ingest"


def bronze_stream(messages: DataFrame, metrics: str | None = None) -> DataFrame:
    """Messages -> bronze rows (parse, drop rejects, stamp ``inserted_at``).

    With ``metrics`` the query reports ``parsed`` / ``quarantined`` per
    micro-batch under ``lastProgress['observedMetrics'][metrics]``.
    """
    parsed = parse_messages(messages)
    if metrics:
        parsed = observe_parsed(parsed, metrics)
    return to_bronze(parsed_ticks(parsed))


def skew_bound(delay: str, max_skew: str | None) -> str:
    """How far ahead of its arrival a tick may be stamped: ``delay`` unless less is asked for.

    The watermark is the largest time seen less ``delay``.  A tick ahead by more
    than that carries it past ticks that arrive on time, and they would be lost.
    """
    if max_skew is None:
        return delay
    if width_micros(max_skew) > width_micros(delay):
        raise ValueError(f"max_skew {max_skew!r} is above delay {delay!r}: a tick that far ahead would drop honest ones")
    return max_skew


def too_early(ticks: DataFrame, max_skew: str = DEFAULT_DELAY) -> Column:
    """True for ticks stamped more than ``max_skew`` after they arrived.

    Arrival is the broker's append time, else bronze's ``inserted_at``, else the
    micro-batch time.  One such tick would carry the watermark past all honest ones.
    """
    if "arrival_ts" in ticks.columns:
        arrived = instant_to_utc(F.col("arrival_ts"))
    elif "inserted_at" in ticks.columns:
        arrived = F.col("inserted_at")
    else:
        arrived = sink_time()
    late = instant_to_utc(parse_instant(F.col("fetched_at"))) > arrived + F.expr(f"INTERVAL {max_skew}")
    return F.coalesce(late, F.lit(False))


def quarantine_stream(messages: DataFrame, max_skew: str = DEFAULT_DELAY) -> DataFrame:
    """Messages that didn't parse, and those whose time the bars refuse
    (``too_early``; bronze keeps these), with the reason."""
    parsed = parse_messages(messages)
    reason = F.coalesce("reject", F.when(too_early(parsed, max_skew), F.lit(REJECT_TOO_EARLY)))
    return quarantined(parsed.withColumn("reject", reason))


def heartbeat_stream(spark: SparkSession, rows_per_second: int = 1) -> DataFrame:
    """Clock rows from Spark's ``rate`` source: ``(timestamp, value)``."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def bar_stream(ticks: DataFrame, time_mode: str = "event", delay: str = DEFAULT_DELAY,
               width: str = BAR_WIDTH, heartbeat: DataFrame | None = None,
               max_skew: str | None = None) -> DataFrame:
    """Ticks (with string ``fetched_at``) -> watermarked OHLC bar stream.

    In event mode ticks stamped more than ``max_skew`` after their arrival (default
    and at most ``delay``) are left out before the watermark sees them
    (``quarantine_stream`` with the same bound has them).

    ``heartbeat`` (arrival mode only; see ``heartbeat_stream``) closes bars
    on the clock when no ticks arrive.  With a broker ``arrival_ts`` the
    heartbeat carries the rate source's time (the Spark driver's clock), so
    skew between the broker's and the driver's clocks acts like extra delay
    (clock ahead) or an earlier close (clock behind); keep ``delay`` above
    the expected skew.
    """
    has_arrival = "arrival_ts" in ticks.columns
    if time_mode == "event":
        ticks = ticks.filter(~too_early(ticks, skew_bound(delay, max_skew)))
        t = parse_instant(F.col("fetched_at"))
    elif time_mode == "arrival":
        t = F.col("arrival_ts") if has_arrival else F.current_timestamp()
    else:
        raise ValueError(f"unknown time_mode {time_mode!r}")
    timed = ticks.withColumn("_event_ts", t).filter(F.col("_event_ts").isNotNull())
    if heartbeat is None:
        return ohlc_bars(timed.withWatermark("_event_ts", delay), "_event_ts", width=width)
    if time_mode != "arrival":
        raise ValueError("heartbeat needs time_mode='arrival' (it is a wall clock)")
    # Heartbeats group under their own key (_heartbeat = true) and never
    # carry a NULL key: when a micro-batch has no heartbeat rows Spark prunes
    # that union branch, and the key columns must keep their nullability
    # across batches, or restoring stored groups would break.
    cols = ["ticker", "price", "seq", *(["partition"] if "partition" in timed.columns else [])]
    ticks_part = timed.select(*cols, "_event_ts", F.lit(1).alias("_is_tick"),
                              F.lit(False).alias("_heartbeat"))
    beats = heartbeat.select(F.lit("").alias("ticker"),
                             F.lit(None).cast("double").alias("price"),
                             F.lit(None).cast("bigint").alias("seq"),
                             *([F.lit(None).cast("int").alias("partition")] if "partition" in timed.columns else []),
                             (F.col("timestamp") if has_arrival else F.current_timestamp()).alias("_event_ts"),
                             F.lit(None).cast("int").alias("_is_tick"),
                             F.lit(True).alias("_heartbeat"))
    both = ticks_part.unionByName(beats).withWatermark("_event_ts", delay)
    bars = ohlc_bars(both, "_event_ts", width=width, count_col="_is_tick", extra_keys=("_heartbeat",))
    return bars.filter(F.col("tick_count") > 0)


def _start(df: DataFrame, path: str, checkpoint: str, partition_col: str | None,
           trigger: dict, query_name: str | None) -> StreamingQuery:
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint)
         .trigger(**trigger))
    if partition_col:
        w = w.partitionBy(partition_col)
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def start_bronze(messages: DataFrame, path: str, checkpoint: str,
                 trigger: dict | None = None, query_name: str | None = None) -> StreamingQuery:
    """K2: append every parsed tick to the month-partitioned bronze table."""
    df = bronze_stream(messages, INGEST_METRICS).withColumn("ym", month_key(F.col("inserted_at")))
    return _start(df, path, checkpoint, "ym", trigger or {"processingTime": "1 minute"}, query_name)


def start_quarantine(messages: DataFrame, path: str, checkpoint: str,
                     trigger: dict | None = None, max_skew: str = DEFAULT_DELAY) -> StreamingQuery:
    """Reject sink: raw text + reason of every message that did not parse, or that bars of this delay refuse."""
    return _start(quarantine_stream(messages, max_skew), path, checkpoint, None,
                  trigger or {"processingTime": "1 minute"}, None)


def start_bars(messages: DataFrame, path: str, checkpoint: str, time_mode: str = "event",
               delay: str = DEFAULT_DELAY, trigger: dict | None = None,
               query_name: str | None = None, heartbeat: DataFrame | None = None) -> StreamingQuery:
    """K3: append finished 5-minute bars, month-partitioned by bar start."""
    ticks = parsed_ticks(parse_messages(messages))
    bars = (bar_stream(ticks, time_mode, delay, heartbeat=heartbeat)
            .withColumn("ym", month_key(F.col("window_start"))))
    return _start(bars, path, checkpoint, "ym", trigger or {"processingTime": "1 minute"}, query_name)


def bronze_file_stream(spark: SparkSession, bronze_path: str,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """The bronze table (written by ``start_bronze``) as a stream of ticks.

    Spark reads a file-sink output through the sink's own commit log, so only
    committed files are seen, each exactly once.  The folder is created when
    missing, so this query may start before the bronze query's first commit.
    """
    from ticksmith.plans.storage import table_schema
    from ticksmith.schemas import LOG_BRONZE
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(bronze_path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hpath)
    r = spark.readStream.schema(table_schema(LOG_BRONZE))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(bronze_path)


def start_bars_from_bronze(spark: SparkSession, bronze_path: str, path: str, checkpoint: str,
                           delay: str = DEFAULT_DELAY, trigger: dict | None = None,
                           query_name: str | None = None) -> StreamingQuery:
    """K3 fed by bronze instead of the broker: event-time bars over the
    committed bronze files (already parsed, so nothing is parsed twice)."""
    bars = (bar_stream(bronze_file_stream(spark, bronze_path), "event", delay)
            .withColumn("ym", month_key(F.col("window_start"))))
    return _start(bars, path, checkpoint, "ym", trigger or {"processingTime": "1 minute"}, query_name)


def start_ingest(messages_factory: Callable[[], DataFrame], bronze_path: str, bars_path: str,
                 checkpoint_root: str, time_mode: str = "event", delay: str = DEFAULT_DELAY,
                 trigger: dict | None = None, bars_source: str | None = None,
                 quarantine_path: str | None = None) -> list[StreamingQuery]:
    """K4 fan-out: bronze, bars and quarantine as independently checkpointed queries, in this order.

    ``bars_source='bronze'`` (default for event time): the bar query follows the
    bronze table as a file stream, so bars cost no broker read and no second
    parse.  ``'messages'`` (default for arrival time) has it read the source
    itself, like the reference's two consumers of one topic.  Rejected
    messages go to ``quarantine_path`` (default: ``<bronze_path>.rejects``).
    """
    root = checkpoint_root.rstrip("/")
    messages = messages_factory()
    bars_source = bars_source or ("bronze" if time_mode == "event" else "messages")
    bronze = start_bronze(messages, bronze_path, f"{root}/bronze", trigger)
    rejects = start_quarantine(messages_factory(), quarantine_path or f"{bronze_path.rstrip('/')}.rejects",
                               f"{root}/quarantine", trigger, delay)
    if bars_source == "messages":
        bars = start_bars(messages_factory(), bars_path, f"{root}/bars", time_mode, delay, trigger)
    elif bars_source == "bronze":
        if time_mode != "event":
            raise ValueError("bars from bronze use event time")
        bars = start_bars_from_bronze(messages.sparkSession, bronze_path, bars_path, f"{root}/bars",
                                      delay, trigger)
    else:
        raise ValueError(f"unknown bars_source {bars_source!r}")
    return [bronze, bars, rejects]


def file_stream(spark: SparkSession, directory: str, schema, glob: str | None = None,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet file stream over ``directory`` (optionally one file glob).

    Files are taken by their modification time, which says nothing of the times
    inside; a bar stream over files needs a ``delay`` that covers what one file may be behind another.
    """
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(directory)


def run_available_now(df: DataFrame, path: str, checkpoint: str,
                      partition_col: str | None = None, timeout_s: int | None = None) -> StreamingQuery:
    """Process everything available, then stop (backfills and tests);
    returns the finished query (its progress reports stay readable).  There is
    no time limit unless ``timeout_s`` is given."""
    q = _start(df, path, checkpoint, partition_col, {"availableNow": True}, None)
    q.awaitTermination(*([timeout_s] if timeout_s else []))
    if q.isActive:
        q.stop()
        raise TimeoutError(f"stream to {path} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise q.exception()
    return q
