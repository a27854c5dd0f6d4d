"""Query catalogue: every registered query, as (spark, sf_dir) -> DataFrame.

Each query reads the driver's ``events`` table (whole, never sampled) and
runs one of the library's operator chains over it; the ticks view of
``events`` is described in ``sources.events``.  ``plans.oracle`` has the
DuckDB SQL for each key.

Non-deterministic columns (``updated_at``, ``inserted_at`` stamped by a
sink) are left out of registered outputs; ``as_of`` dates are either fixed
parameters or the latest day in the data, computed on the cluster as a
scalar subquery.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticksmith.functions.timefn import NAIROBI, in_session, local_date, month_key, parse_to_utc, wall_to_instant
from ticksmith.operators import bars as bars_op
from ticksmith.operators import ingest, marts, quality, reports, staging
from ticksmith.plans import batch, storage
from ticksmith.schemas import BAR, BAR_COLS, BRONZE, TICK_COLS
from ticksmith.plans.manifest import MonthTable
from ticksmith.sources.events import (EVENT_COLS, events_as_bronze, events_as_log_bronze, events_as_messages, events_as_replay,
                                      events_as_shifted_bronze,
                                      events_as_snapshots, events_as_universe_snapshots, read_events, spoiled_tables)
from ticksmith.sources.kafka import read_message_log, write_message_log
from ticksmith.sources.tables import read_partitioned
from ticksmith.streaming import fanout
from ticksmith.streaming import jobs as stream_jobs
from ticksmith.streaming import replay

# Parameters of the registered queries.
RETENTION_AS_OF = "2026-01-15"
STREAM_DELAY = "0 seconds"
REPLAY_DELAY = "10 minutes"
COMPACTED_MONTHS = (190001, 202401)
INCREMENT_DAY = "2024-01-16"
# Messages in one file of the fan-out's log, which one task parses.
LOG_FILE_ROWS = 1 << 17

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- views

def bronze_by_user(spark: SparkSession, sf: str) -> DataFrame:
    return events_as_bronze(read_events(spark, sf), "user")


def bronze_by_type(spark: SparkSession, sf: str) -> DataFrame:
    return events_as_bronze(read_events(spark, sf), "event_type")


def parsed_messages(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.parse_messages(events_as_messages(read_events(spark, sf), "user"))


def staged_by_user(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stage_ticks(bronze_by_user(spark, sf))


def daily_by_user(spark: SparkSession, sf: str) -> DataFrame:
    return marts.daily_summary_from_bronze(bronze_by_user(spark, sf))


def bars_by_type(spark: SparkSession, sf: str) -> DataFrame:
    b = bronze_by_type(spark, sf).withColumn("event_time", parse_to_utc(F.col("fetched_at")))
    return bars_op.ohlc_bars(b, "event_time")


# ---------------------------------------------------------------- queries

def q_normalise_snapshots(spark, sf):
    return ingest.normalise_snapshots(events_as_snapshots(read_events(spark, sf)))


def q_ingest_counts(spark, sf):
    return ingest.ingest_counts(events_as_snapshots(read_events(spark, sf)))


def q_publish_json(spark, sf):
    msgs = ingest.to_messages(bronze_by_user(spark, sf))
    back = ingest.parsed_ticks(ingest.parse_messages(msgs))
    return back.select("seq", *TICK_COLS)


def q_parse_ticks(spark, sf):
    return ingest.parsed_ticks(parsed_messages(spark, sf)).select("seq", *TICK_COLS)


def q_quarantine_ticks(spark, sf):
    return ingest.quarantined(parsed_messages(spark, sf))


def q_parse_fetched_at(spark, sf):
    b = bronze_by_user(spark, sf)
    ts = parse_to_utc(F.col("fetched_at"))
    return b.select("seq", F.col("fetched_at").alias("fetched_at_text"),
                    ts.alias("fetched_at"), local_date(ts, NAIROBI).alias("trade_date"))


def q_session_ticks(spark, sf):
    b = ingest.bind(bronze_by_user(spark, sf), "fetched_utc", parse_to_utc(F.col("fetched_at")))
    return (b.filter(in_session(F.col("fetched_utc"), NAIROBI))
            .select("seq", "ticker", "price", F.col("fetched_utc").alias("fetched_at")))


def q_stage_ticks(spark, sf):
    return staging.stage_ticks(bronze_by_type(spark, sf))


def q_stage_rejects(spark, sf):
    bronze = ingest.to_bronze(ingest.parsed_ticks(parsed_messages(spark, sf)),
                              inserted_at=F.lit(None).cast("timestamp_ntz"))
    return staging.stage_rejects(bronze).drop("inserted_at")


def q_bars_5min(spark, sf):
    return bars_by_type(spark, sf)


def q_stage_bars(spark, sf):
    return staging.stage_bars(bars_by_type(spark, sf))


def q_daily_summary(spark, sf):
    return daily_by_user(spark, sf).drop("updated_at")


def q_top_movers(spark, sf):
    return marts.top_movers(daily_by_user(spark, sf))


def q_top_movers_single_pass(spark, sf):
    return marts.top_movers_single_pass(daily_by_user(spark, sf))


def q_movers_report(spark, sf):
    # as in the scheduled run: the daily mart is stored once, movers are
    # ranked from the stored table (the report and its as-of subquery both
    # read it, so the tick scan runs once)
    movers = batch.build_marts(bronze_by_user(spark, sf), bars=bars_by_type(spark, sf)).top_movers
    as_of = movers.select(F.max("trade_date")).scalar()
    return reports.movers_report(movers, as_of)


def q_health_today(spark, sf):
    b = bronze_by_user(spark, sf)
    return reports.health_today(b, reports.latest_day(b, "inserted_at"))


def q_health_by_day(spark, sf):
    b = bronze_by_user(spark, sf)
    return reports.health_by_day(b, reports.latest_day(b, "inserted_at"))


def q_peek(spark, sf):
    return reports.peek(bronze_by_user(spark, sf), ordered=True)


def quality_marts(spark: SparkSession, sf: str) -> batch.Marts:
    """The six checked tables, built like a scheduled run: the daily mart
    is computed once and stored, movers and checks read it.  So are the bars:
    their two checks read other columns of them, and Spark would aggregate the ticks for each."""
    return batch.build_marts(bronze_by_user(spark, sf), bars=storage.materialize(bars_by_type(spark, sf), "bars"))


def q_quality_results(spark, sf):
    # counts only: the staging checks read the sort-free dedup relation
    return quality.run_checks(quality_marts(spark, sf).check_tables())


def q_quality_failing_rows(spark, sf):
    # whole failing rows: the staging view itself
    return quality.failing_rows(quality_marts(spark, sf).tables())


def q_quality_parsed_ticks(spark, sf):
    # the staging checks over the parsed feed, before the staging filter:
    # their failures are the ticks staging removes (NULL-price and empty
    # messages arrive as price 0 / ticker '')
    checks = quality.retarget(quality.REFERENCE_CHECKS, "stg_ticks", "parsed_ticks")
    feed = ingest.parsed_ticks(parsed_messages(spark, sf))
    return quality.run_checks({"parsed_ticks": feed}, checks)


def q_quality_parsed_failing_rows(spark, sf):
    # the rows behind those failures, as JSON (one per row and failed check)
    checks = quality.retarget(quality.REFERENCE_CHECKS, "stg_ticks", "parsed_ticks")
    feed = ingest.parsed_ticks(parsed_messages(spark, sf))
    return quality.failing_rows({"parsed_ticks": feed}, checks)


def q_retain_two_years(spark, sf):
    b = storage.with_month(bronze_by_user(spark, sf), "inserted_at")
    return storage.retain(b, RETENTION_AS_OF).select("seq", "ticker", "inserted_at", "ym")


def q_monthly_layout(spark, sf):
    path = storage.scratch_path(spark, "monthly_layout")
    storage.write_table(bronze_by_user(spark, sf), path, partition_source="inserted_at",
                        sort_cols=["ticker", "inserted_at"])
    back = read_partitioned(spark, path, storage.table_schema(BRONZE))
    return back.groupBy("ym").agg(F.count(F.lit(1)).alias("n_rows"),
                                  F.countDistinct("ticker").alias("n_tickers"),
                                  F.min("inserted_at").alias("first_inserted_at"),
                                  F.max("inserted_at").alias("last_inserted_at"))


def q_universe_snapshots(spark, sf):
    return ingest.normalise_snapshots(events_as_universe_snapshots(read_events(spark, sf), ingest.NSE_UNIVERSE),
                                      universe=ingest.NSE_UNIVERSE)


def q_message_keys(spark, sf):
    # K1: every record's key beside the ticker inside it
    parsed = ingest.parse_messages(ingest.to_messages(bronze_by_user(spark, sf)))
    return parsed.select("seq", "key", "ticker")


def q_published_daily(spark, sf):
    return storage.published(daily_by_user(spark, sf).drop("updated_at"), marts.daily_order())


def q_published_movers(spark, sf):
    return storage.published(marts.top_movers_single_pass(daily_by_user(spark, sf)), marts.movers_order())


def q_quality_spoiled_results(spark, sf):
    return quality.run_checks(spoiled_tables(quality_marts(spark, sf).tables()))


def q_quality_written(spark, sf):
    # counted by the write pass of the marts, not by a scan of them
    m = batch.build_marts(bronze_by_user(spark, sf), bars=bars_by_type(spark, sf), out_dir=storage.scratch_path(spark, "marts_watched"))
    return m.written_checks()


def q_stream_bars_arrival(spark, sf):
    # the reference's mode: bars by arrival; the ticks' own times are unreadable here
    ticks = (events_as_bronze(_event_stream(spark, sf), "event_type").withColumn("arrival_ts", wall_to_instant(F.col("inserted_at")))
             .withColumn("fetched_at", F.lit("junk")))
    out = storage.scratch_path(spark, "stream_bars_arrival")
    stream_jobs.run_available_now(stream_jobs.bar_stream(ticks, "arrival", STREAM_DELAY), out,
                                  storage.scratch_path(spark, "stream_bars_arrival_ckpt"))
    return spark.read.schema(BAR).parquet(out).select(*BAR_COLS)


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet").select(*EVENT_COLS).schema
    # the glob matches the table as one file and as a directory of parts
    return stream_jobs.file_stream(spark, f"{sf.rstrip('/')}/events.parque[t]", schema)


def q_stream_bars(spark, sf):
    ticks = events_as_bronze(_event_stream(spark, sf), "event_type")
    bars = stream_jobs.bar_stream(ticks, "event", STREAM_DELAY)
    out = storage.scratch_path(spark, "stream_bars")
    stream_jobs.run_available_now(bars, out, storage.scratch_path(spark, "stream_bars_ckpt"))
    return spark.read.schema(BAR).parquet(out).select(*BAR_COLS)


def q_stream_bronze(spark, sf):
    msgs = events_as_messages(_event_stream(spark, sf), "user")
    out = storage.scratch_path(spark, "stream_bronze")
    stream_jobs.run_available_now(stream_jobs.bronze_stream(msgs, stream_jobs.INGEST_METRICS), out,
                                  storage.scratch_path(spark, "stream_bronze_ckpt"))
    return spark.read.schema(BRONZE).parquet(out).select("seq", *TICK_COLS)


def q_compacted_bronze(spark, sf):
    # streamed bronze, its closed months compacted, both read as one relation
    ticks = events_as_bronze(_event_stream(spark, sf), "user").withColumn("ym", month_key(F.col("inserted_at")))
    out, table = storage.scratch_path(spark, "bronze_stream"), storage.scratch_path(spark, "bronze_compacted")
    stream_jobs.run_available_now(ticks, out, storage.scratch_path(spark, "bronze_stream_ckpt"), partition_col="ym")
    storage.compact_months(spark, out, table, BRONZE, *COMPACTED_MONTHS, ["ticker", "inserted_at"])
    return storage.read_compacted(spark, out, table, BRONZE).select("seq", "ticker", "inserted_at", "ym")


def q_incremental_marts(spark, sf):
    # marts of the feed as it stood at INCREMENT_DAY, then the rebuild of the months touched since
    bronze, out = bronze_by_user(spark, sf), storage.scratch_path(spark, "marts")
    batch.build_marts(bronze.filter(F.col("inserted_at") < INCREMENT_DAY), out_dir=out)
    m = batch.build_marts(bronze, out_dir=out, since=INCREMENT_DAY)
    return m.daily_summary.drop("updated_at")


def q_incremental_marts_shifted(spark, sf):
    # the same over two insertion months whose stamps run late and ahead of their arrival
    bronze, out = events_as_shifted_bronze(read_events(spark, sf)), storage.scratch_path(spark, "marts_shifted")
    batch.build_marts(bronze.filter(F.col("inserted_at") < INCREMENT_DAY), out_dir=out)
    return batch.build_marts(bronze, out_dir=out, since=INCREMENT_DAY).daily_summary.drop("updated_at")


def q_expired_bronze(spark, sf):
    # bronze as month versions; a rewrite that was never committed changes nothing; then the TTL, in one commit
    rows = storage.with_month(bronze_by_user(spark, sf), "inserted_at")
    table = MonthTable(spark, storage.scratch_path(spark, "bronze_months"), BRONZE, ["ticker", "inserted_at"])
    table.replace(rows)
    table.write(rows.withColumn("price", F.lit(0.0)))
    storage.enforce_retention(spark, table.path, BRONZE, RETENTION_AS_OF, sort_cols=table.sort_cols)
    return table.read().select("seq", "ticker", "inserted_at", "ym")


def fan_out(spark: SparkSession, sf: str) -> dict[str, str]:
    """The feed as a message log, a quarter of it a micro-batch, through ``start_fan_out``.

    A quarter is one file, or of a large feed as many as its tasks.  The files hold every time of the feed,
    so most ticks of a later batch are late for bars that an earlier one stored; the store is compacted
    between two runs, the second of which resumes from the checkpoint.
    """
    at = {name: storage.scratch_path(spark, f"fan_out_{name}") for name in ("log", "bronze", "rejects", "bars", "ckpt")}
    events = read_events(spark, sf)
    messages = events_as_messages(events, "event_type")
    files = max(1, -(-events.count() // (4 * LOG_FILE_ROWS)))
    for part in range(2):
        write_message_log(messages.filter(F.col("seq") % 2 == part).repartition(2 * files), at["log"])
        query = fanout.start_fan_out(read_message_log(spark, at["log"], stream=True, max_files_per_trigger=files), at["bronze"],
                                     at["rejects"], at["bars"], at["ckpt"], {"availableNow": True})
        query.awaitTermination()
        if part == 0:
            fanout.BarStore(spark, at["bars"]).compact()
    return at


def q_fan_out_bronze(spark, sf):
    return fanout.read_batches(spark, fan_out(spark, sf)["bronze"], BRONZE, "ym").select("seq", *TICK_COLS)


def q_fan_out_rejects(spark, sf):
    return fanout.read_batches(spark, fan_out(spark, sf)["rejects"], fanout.REJECTED).select(*fanout.REJECTED.fieldNames())


def q_fan_out_bars(spark, sf):
    return fanout.BarStore(spark, fan_out(spark, sf)["bars"]).read().select(*BAR_COLS)


def q_stream_bars_via_bronze(spark, sf):
    # the read-once fan-out: messages -> bronze stream; bars follow the
    # committed bronze files (event time), as start_ingest(bars_source='bronze')
    msgs = events_as_messages(_event_stream(spark, sf), "event_type")
    bronze_out = storage.scratch_path(spark, "bronze_for_bars")
    bronze = stream_jobs.bronze_stream(msgs).withColumn("ym", month_key(F.col("inserted_at")))
    stream_jobs.run_available_now(bronze, bronze_out, storage.scratch_path(spark, "bronze_for_bars_ckpt"),
                                  partition_col="ym")
    bars = stream_jobs.bar_stream(stream_jobs.bronze_file_stream(spark, bronze_out), "event", STREAM_DELAY)
    out = storage.scratch_path(spark, "bars_via_bronze")
    stream_jobs.run_available_now(bars, out, storage.scratch_path(spark, "bars_via_bronze_ckpt"))
    return spark.read.schema(BAR).parquet(out).select(*BAR_COLS)


def _replayed(spark: SparkSession, sf: str) -> DataFrame:
    # stored once: every batch reads its own folder of it
    at = storage.scratch_path(spark, "replay_ticks")
    ticks = events_as_replay(read_events(spark, sf))
    ticks.write.partitionBy("batch").parquet(at)
    return spark.read.schema(ticks.schema).parquet(at)


def q_replay_bars(spark, sf):
    # event-time bars of a feed that is stopped and resumed between its batches
    ticks = _replayed(spark, sf)
    run = replay.Replay(spark, storage.scratch_path(spark, "replay_bars"), {"ticks": ticks.drop("batch").schema},
                        lambda ticks: stream_jobs.bar_stream(ticks, "event", REPLAY_DELAY))
    return run.run(ticks, "batch", "ticks").read(BAR).select(*BAR_COLS)


def q_replay_ticks(spark, sf):
    # which ticks each batch's watermark admits, by the stream itself; every batch delivers the one before it again
    ticks = _replayed(spark, sf)
    run = replay.Replay(spark, storage.scratch_path(spark, "replay_ticks_out"), {"ticks": ticks.drop("batch").schema},
                        lambda ticks: replay.admitted_stream(ticks, REPLAY_DELAY))
    again = ticks.unionByName(ticks.withColumn("batch", F.col("batch") + 1))
    out = run.run(again, "batch", "ticks").read(replay.admitted_schema(ticks.drop("batch").schema))
    return out.select("seq", "ticker", "price", "window_start", "window_end")


def q_replay_admission(spark, sf):
    # the same from stored ticks, with the reason and the watermark
    told = replay.admission(_replayed(spark, sf), "batch", REPLAY_DELAY)
    return told.select("seq", "batch", "watermark", "verdict")


def q_replay_bars_arrival(spark, sf):
    # arrival-time bars in batches; a last batch without ticks, only the clock, closes the last bars
    ticks = _replayed(spark, sf)
    beats = ticks.agg(F.max("arrival_ts").alias("last")).select(
        (F.col("last") + F.expr(f"INTERVAL {bars_op.BAR_WIDTH}") + F.expr(f"INTERVAL {REPLAY_DELAY}")).alias("timestamp"))
    run = replay.Replay(spark, storage.scratch_path(spark, "replay_arrival"),
                        {"ticks": ticks.drop("batch").schema, "clock": beats.schema},
                        lambda ticks, clock: stream_jobs.bar_stream(ticks, "arrival", REPLAY_DELAY, heartbeat=clock))
    run.run(ticks, "batch", "ticks").step(clock=beats)
    return run.read(BAR).select(*BAR_COLS)


def log_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return events_as_log_bronze(read_events(spark, sf))


def q_log_bars(spark, sf):
    # opens and closes go by (time, partition, offset): offsets alone are not unique
    return bars_op.ohlc_bars(log_bronze(spark, sf).withColumn("event_time", parse_to_utc(F.col("fetched_at"))), "event_time")


def q_log_bar_parts(spark, sf):
    # the same bars, merged from parts of the log as BarStore keeps them
    ticks = log_bronze(spark, sf).withColumn("event_time", parse_to_utc(F.col("fetched_at")))
    parts = [bars_op.bar_parts(ticks.where(F.col("seq") % 3 == r), "event_time") for r in range(3)]
    stored = parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("inserted_at", F.lit(None).cast("timestamp_ntz"))
    return bars_op.merge_parts(stored).select(*BAR_COLS)


def q_log_stage_ticks(spark, sf):
    return staging.stage_ticks(log_bronze(spark, sf))


def q_log_daily_summary(spark, sf):
    return marts.daily_summary_from_bronze(log_bronze(spark, sf)).drop("updated_at")


QUERIES: dict[str, Query] = {
    "normalise_snapshots": q_normalise_snapshots,
    "ingest_counts": q_ingest_counts,
    "publish_json": q_publish_json,
    "parse_ticks": q_parse_ticks,
    "quarantine_ticks": q_quarantine_ticks,
    "parse_fetched_at": q_parse_fetched_at,
    "session_ticks": q_session_ticks,
    "stage_ticks": q_stage_ticks,
    "stage_rejects": q_stage_rejects,
    "bars_5min": q_bars_5min,
    "stage_bars": q_stage_bars,
    "daily_summary": q_daily_summary,
    "top_movers": q_top_movers,
    "top_movers_single_pass": q_top_movers_single_pass,
    "movers_report": q_movers_report,
    "health_today": q_health_today,
    "health_by_day": q_health_by_day,
    "peek": q_peek,
    "quality_results": q_quality_results,
    "quality_failing_rows": q_quality_failing_rows,
    "quality_parsed_ticks": q_quality_parsed_ticks,
    "quality_parsed_failing_rows": q_quality_parsed_failing_rows,
    "retain_two_years": q_retain_two_years,
    "monthly_layout": q_monthly_layout,
    "stream_bars": q_stream_bars,
    "stream_bronze": q_stream_bronze,
    "stream_bars_via_bronze": q_stream_bars_via_bronze,
    "compacted_bronze": q_compacted_bronze,
    "incremental_marts": q_incremental_marts,
    "incremental_marts_shifted": q_incremental_marts_shifted,
    "expired_bronze": q_expired_bronze,
    "universe_snapshots": q_universe_snapshots,
    "message_keys": q_message_keys,
    "published_daily": q_published_daily,
    "published_movers": q_published_movers,
    "quality_spoiled_results": q_quality_spoiled_results,
    "quality_written": q_quality_written,
    "stream_bars_arrival": q_stream_bars_arrival,
    "fan_out_bronze": q_fan_out_bronze,
    "fan_out_rejects": q_fan_out_rejects,
    "fan_out_bars": q_fan_out_bars,
    "replay_bars": q_replay_bars,
    "replay_ticks": q_replay_ticks,
    "replay_admission": q_replay_admission,
    "replay_bars_arrival": q_replay_bars_arrival,
    "log_bars": q_log_bars,
    "log_bar_parts": q_log_bar_parts,
    "log_stage_ticks": q_log_stage_ticks,
    "log_daily_summary": q_log_daily_summary,
}
