"""One-pass fan-out, late-tick repair, strict messages, bounded skew."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ticksmith.operators import ingest
from ticksmith.operators.bars import ohlc_bars
from ticksmith.schemas import BRONZE, LOG_BRONZE
from ticksmith.sources.kafka import MESSAGE_LOG
from ticksmith.streaming import fanout, jobs

from .conftest import rows


def messages(spark, ticks, first=0):
    return spark.createDataFrame([(t, '{"ticker":"%s","price":%s,"fetched_at":"%s"}' % (t, p, at), first + i)
                                  for i, (t, p, at) in enumerate(ticks)], MESSAGE_LOG)


def test_a_late_tick_changes_its_stored_bar_once(spark, tmp_dir):
    b, r, bars = (os.path.join(tmp_dir, n) for n in ("bronze", "rejects", "bars"))
    store = fanout.BarStore(spark, bars)

    def batch(n, *ticks):
        fanout.ingest_batch(messages(spark, ticks, 10 * n), n, b, r, bars)

    def seen():
        return rows(store.read(), "window_start", "open_price", "high_price", "close_price", "tick_count")

    at = dt.datetime(2026, 4, 21, 7, 0)
    batch(0, ("A", 5.0, "2026-04-21T10:01:00+03:00"), ("A", 6.0, "2026-04-21T10:02:00+03:00"))
    batch(1, ("A", 7.0, "2026-04-21T12:00:00+03:00"))
    noon = (dt.datetime(2026, 4, 21, 9, 0), 7.0, 7.0, 7.0, 1)
    assert seen() == [(at, 5.0, 6.0, 6.0, 2), noon]
    late = ("A", 9.0, "2026-04-21T10:00:30+03:00")
    batch(2, late)
    batch(2, late)                       # replayed
    assert seen() == [(at, 9.0, 9.0, 6.0, 3), noon]
    store.compact()
    store.compact()
    assert seen() == [(at, 9.0, 9.0, 6.0, 3), noon]
    batch(2, late)                       # replayed after its batch was folded in
    batch(3, ("A", 4.0, "2026-04-21T10:04:00+03:00"), ("A", 1.0, "junk"))
    assert seen() == [(at, 9.0, 9.0, 4.0, 4), noon]
    assert store.read().where("inserted_at IS NULL").count() == 0
    assert fanout.read_batches(spark, b, LOG_BRONZE, "ym").count() == 6
    assert os.listdir(os.path.join(bars, "months")) and fanout.finished_batches(spark, bars + "/parts") == [0, 1, 2, 3]


def test_a_batch_that_broke_off_is_not_read(spark, tmp_dir):
    path = os.path.join(tmp_dir, "b")
    df = spark.createDataFrame([("A", 1)], "ticker string, seq long")
    fanout.write_batch(df, path, 0, BRONZE)
    fanout.write_batch(df, path, 1, BRONZE)
    os.rename(os.path.join(path, "batch_id=1", "_SUCCESS"), os.path.join(tmp_dir, "gone"))
    assert rows(fanout.read_batches(spark, path, BRONZE), "ticker", "batch_id") == [("A", 0)]


def test_the_topic_is_read_once(spark, tmp_dir):
    from ticksmith.sources.kafka import read_message_log, write_message_log
    log, b, r, bars, ckpt = (os.path.join(tmp_dir, n) for n in ("log", "b", "r", "bars", "ckpt"))
    good = [("A", float(i), f"2026-04-21T10:{i:02d}:00+03:00") for i in range(20)]
    write_message_log(messages(spark, good).union(spark.createDataFrame([("A", "not json", 99)], MESSAGE_LOG)).coalesce(1), log)
    q = fanout.start_fan_out(read_message_log(spark, log, stream=True), b, r, bars, ckpt, {"availableNow": True})
    q.awaitTermination(120)
    assert sum(p["numInputRows"] for p in q.recentProgress) == 21
    assert fanout.read_batches(spark, b, LOG_BRONZE, "ym").count() == 20
    assert rows(fanout.read_batches(spark, r, fanout.REJECTED), "seq", "reason") == [(99, "malformed")]


def test_a_tick_ahead_of_its_arrival_is_rejected_and_kept_in_bronze(spark, tmp_dir):
    b, r, bars = (os.path.join(tmp_dir, n) for n in ("b", "r", "bars"))
    fanout.ingest_batch(messages(spark, [("A", 1.0, "2099-01-01T00:00:00+03:00"), ("A", 2.0, "2026-04-21T10:00:00+03:00")]), 0, b, r, bars)
    assert fanout.read_batches(spark, b, LOG_BRONZE, "ym").count() == 2
    assert rows(fanout.read_batches(spark, r, fanout.REJECTED), "reason") == [(jobs.REJECT_TOO_EARLY,)]
    assert fanout.BarStore(spark, bars).read().count() == 1


@pytest.mark.parametrize("value,reject", [
    ('{"ticker":"A","price":1}', None),
    (' \n{"ticker":"A","price":1}\t', None),
    ('{"ticker":"A","price":1}] trailing', "malformed"),
    ('{"ticker":"A","price":1}]{"ticker":"B","price":2}', "malformed"),
    ('{"ticker":"A","price":1}{"ticker":"B","price":2}', "malformed"),
    ('{"ticker":"A","price":1},{"ticker":"B","price":2}', "malformed"),
    ('{"ticker":"A","price":1},{"__end":"0"}] x', "malformed"),
    ('{"ticker":"A","price":1},', "malformed"),
    ('{"ticker":"A","price":NaN,"x":{"y":1}}', None),
    ('{"ticker":"A","name":"a}b{\\"","price":NaN}', None),
    ('{"ticker":"A","price":1,"__end":"z"}', None),
    ('{"ticker":"A","price":{"v":1}}', "bad_number"),
    ("null", "malformed"), ("[1]", "malformed"), ("1", "malformed"), ('"x"', "malformed"), ("", "malformed"), ("  ", "malformed"),
    (None, "malformed"), ("{", "malformed"), ('{"ticker":"A"', "malformed"), ("[{}]", "malformed"), ("{}", None),
])
def test_a_message_is_one_object(spark, value, reject):
    df = spark.createDataFrame([(value,)], "value string")
    assert [r["reject"] for r in ingest.parse_messages(df).select("reject").collect()] == [reject]


def test_messages_are_parsed_once(spark):
    df = ingest.parsed_ticks(ingest.parse_messages(spark.createDataFrame([("{}", 1)], "value string, seq long")))
    assert df.where("price > 0 AND ticker <> ''")._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_skew_is_bounded_by_the_delay(spark):
    ticks = spark.createDataFrame([("A", 1.0, "2024-01-01T00:00:00Z", 1)], "ticker string, price double, fetched_at string, seq long")
    with pytest.raises(ValueError, match="max_skew"):
        jobs.bar_stream(ticks, delay="10 minutes", max_skew="55 minutes")
    assert jobs.skew_bound("10 minutes", None) == "10 minutes" and jobs.skew_bound("1 hour", "5 minutes") == "5 minutes"


def test_a_tick_ahead_within_the_hour_removes_no_honest_tick(spark, tmp_dir):
    """One tick 55 minutes ahead of its arrival, then honest ticks: none of these may be late."""
    src = os.path.join(tmp_dir, "src")
    schema = "ticker string, price double, fetched_at string, seq long, arrival_ts timestamp"
    t = dt.datetime(2026, 4, 21, 7, 0)

    def run(ticks):
        spark.createDataFrame([("A", 1.0, (t + dt.timedelta(minutes=s)).isoformat() + "Z", s, t + dt.timedelta(minutes=a)) for s, a in ticks],
                              schema).coalesce(1).write.mode("append").parquet(src)
        bars = jobs.bar_stream(spark.readStream.schema(schema).parquet(src), "event", "10 minutes")
        jobs.run_available_now(bars, os.path.join(tmp_dir, "bars"), os.path.join(tmp_dir, "ckpt"))

    run([(0, 0), (55, 0)])
    run([(m, m) for m in (1, 2, 3, 6, 7)])
    run([(60, 60)])
    run([(80, 80)])
    from ticksmith.schemas import BAR
    got = rows(spark.read.schema(BAR).parquet(os.path.join(tmp_dir, "bars")), "window_start", "tick_count")
    assert got == [(t, 4), (t + dt.timedelta(minutes=5), 2), (t + dt.timedelta(minutes=60), 1)]


def test_equal_offsets_of_two_partitions_have_one_order(spark):
    at = dt.datetime(2026, 4, 21, 7, 1)
    ticks = [("A", 1.0, at, 5, 1), ("A", 2.0, at, 5, 0), ("A", 3.0, at, 4, 1), ("A", 4.0, at, 6, 0), ("A", 5.0, at, 7, None)]
    for order in (ticks, ticks[::-1]):
        df = spark.createDataFrame(order, "ticker string, price double, t timestamp_ntz, seq long, partition int").repartition(3)
        assert rows(ohlc_bars(df, "t"), "open_price", "close_price") == [(2.0, 1.0)]
    kept = ingest.to_bronze(spark.createDataFrame([("A",) * 8 + (1, 3)], ", ".join(f"{c} string" for c in BRONZE.fieldNames()[:8]) + ", seq long, partition int"))
    assert kept.select("seq", "partition").withColumn("x", F.lit(1)).first() == (1, 3, 1)


def test_a_micro_batch_of_a_large_log_is_parsed_by_many_tasks(spark, monkeypatch):
    from ticksmith.plans import catalog
    from ticksmith.sources.kafka import read_message_log
    sf = "/root/testdata/sf0.001"
    before = rows(catalog.q_fan_out_bars(spark, sf))
    monkeypatch.setattr(catalog, "LOG_FILE_ROWS", 50, raising=False)
    at = catalog.fan_out(spark, sf)
    log = read_message_log(spark, at["log"])
    assert log.count() == 1000 and len(log.inputFiles()) == 20          # five files a batch
    assert fanout.finished_batches(spark, at["bronze"]) == [0, 1, 2, 3]
    assert rows(fanout.BarStore(spark, at["bars"]).read().select(*fanout.STORED_BAR.fieldNames()[:8])) == before


def test_the_time_of_a_bar_is_parsed_once(spark, tmp_dir):
    """Three patterns and one cast of the text; a filter on the time's being there must not repeat them."""
    from ticksmith.functions.timefn import parse_to_utc
    from ticksmith.operators.bars import bar_parts
    from ticksmith.plans import batch
    ticks = spark.createDataFrame([("A", 1.0, "2026-04-21T10:00:00Z", 1), ("A", 2.0, "junk", 2), ("A", 3.0, None, 3)],
                                  "ticker string, price double, fetched_at string, seq long")
    timed = ticks.withColumn("t", parse_to_utc(F.col("fetched_at")))
    for bars in (ohlc_bars(timed, "t"), bar_parts(timed, "t"), batch.bars_from_bronze(ticks)):
        assert bars._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 3
        assert rows(bars, "ticker", "open_price", "tick_count") == [("A", 1.0, 1)]
