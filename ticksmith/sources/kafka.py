"""Message-log sources and sinks: Kafka (S1, K1) and an offline file log.

A tick message is ``(key = ticker, value = JSON text)``.  Downstream
operators only need a DataFrame with a string ``value`` and a ``seq``
(arrival order), so the same parser serves Kafka, a file log and tests.

The Kafka connector jar is not on this image's classpath; the Kafka
functions are plain option builders around ``format('kafka')`` and are not
exercised by the tests.  The file log (Parquet ``key, value, seq``) is the
offline transport and is what the tests stream from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: topic name of the tick feed.
TICK_TOPIC = "nse.raw.ticks"

MESSAGE_LOG = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("seq", T.LongType()),
])


def read_kafka_ticks(spark: SparkSession, bootstrap: str, topic: str = TICK_TOPIC,
                     starting_offsets: str | None = None, stream: bool = True,
                     **options: str) -> DataFrame:
    """Kafka topic -> ``(key, value, seq, partition, arrival_ts)``.

    ``seq`` is the partition offset; ticks of one ticker share a partition
    (the key is the ticker), so ``(ts, seq)`` orders a ticker's ticks.
    A stream starts at the latest offsets by default, a batch read at the
    earliest (``latest`` is not valid there).
    ``arrival_ts`` is the broker append time, used by the processing-time
    parity mode of the bar stream.
    """
    reader = spark.readStream if stream else spark.read
    df = (reader.format("kafka")
          .option("kafka.bootstrap.servers", bootstrap)
          .option("subscribe", topic)
          .option("startingOffsets", starting_offsets or ("latest" if stream else "earliest"))
          .options(**options)
          .load())
    return df.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("offset").alias("seq"),
        F.col("partition"),
        F.col("timestamp").alias("arrival_ts"),
    )


def write_kafka(records: DataFrame, bootstrap: str, topic: str = TICK_TOPIC,
                checkpoint: str | None = None, **options: str):
    """Publish ``(key, value)`` records; acks=all like the producer.

    Batch DataFrames are written at once; streaming ones start a query with
    ``checkpoint`` as its checkpoint location.
    """
    out = records.select(F.col("key").cast("binary").alias("key"),
                         F.col("value").cast("binary").alias("value"))
    opts = {"kafka.bootstrap.servers": bootstrap, "topic": topic, "kafka.acks": "all", **options}
    if out.isStreaming:
        if checkpoint is None:
            raise ValueError("a streaming Kafka sink needs a checkpoint location")
        return (out.writeStream.format("kafka").options(**opts)
                .option("checkpointLocation", checkpoint).start())
    out.write.format("kafka").options(**opts).save()
    return None


def write_message_log(records: DataFrame, path: str, mode: str = "append") -> None:
    """Offline transport: append ``(key, value, seq)`` to a Parquet log."""
    records.select("key", "value", "seq").write.mode(mode).parquet(path)


def read_message_log(spark: SparkSession, path: str, stream: bool = False,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Read the Parquet message log, batch or as a file stream."""
    if not stream:
        return spark.read.schema(MESSAGE_LOG).parquet(path)
    r = spark.readStream.schema(MESSAGE_LOG)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def read_text_messages(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """One JSON message per line of text.

    Plain text carries no offsets, so ``seq`` is only a tie-breaker: in
    batch the row id of the scan; in a stream (where row ids are not
    allowed) a non-negative hash of (file, line), which is stable when a
    micro-batch is replayed.
    """
    df = (spark.readStream if stream else spark.read).format("text").load(path)
    if stream:
        seq = F.pmod(F.xxhash64(F.input_file_name(), F.col("value")), F.lit(2 ** 62))
    else:
        seq = F.monotonically_increasing_id()
    return df.select(F.lit(None).cast("string").alias("key"), F.col("value"), seq.alias("seq"))
