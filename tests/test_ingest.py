"""Snapshot normalisation, JSON publish/parse and quarantine (FIXTURES §1-§2)."""

from __future__ import annotations

import datetime as dt
import json
import math

from pyspark.sql import functions as F

from ticksmith.operators import ingest
from ticksmith.schemas import BRONZE_COLS, TICK_COLS

from .conftest import SF_SMALL

FETCH_UTC = dt.datetime(2026, 4, 21, 7, 15, 0, 123456)   # 10:15:00.123456 EAT


def _snapshots(spark, data):
    return spark.createDataFrame(
        data, "symbol string, last_price double, avg_volume_3m double, market_cap double, fetched_at timestamp_ntz")


def test_normalise_snapshot_fields(spark):
    df = _snapshots(spark, [("SCOM.NR", 17.854, 5200000.9, 715e9, FETCH_UTC),
                            ("KCB", 0.125, None, None, FETCH_UTC)])
    out = {r["ticker"]: r for r in ingest.normalise_snapshots(df).collect()}
    s = out["SCOM.NR"]
    assert (s["name"], s["price"], s["volume"], s["market_cap"]) == ("SCOM", 17.85, 5200000, 715e9)
    assert (s["currency"], s["exchange"]) == ("KES", "NSE")
    assert s["fetched_at"] == "2026-04-21T10:15:00.123456+03:00"
    k = out["KCB"]   # no suffix to strip; exact half cent rounds to even; NULLs -> 0
    assert (k["name"], k["price"], k["volume"], k["market_cap"]) == ("KCB", 0.12, 0, 0.0)


def test_normalise_skips_null_and_zero_prices(spark):
    df = _snapshots(spark, [("A.NR", None, 1.0, 1.0, FETCH_UTC), ("B.NR", 0.0, 1.0, 1.0, FETCH_UTC),
                            ("C.NR", -1.5, 1.0, 1.0, FETCH_UTC), ("D.NR", float("nan"), 1.0, 1.0, FETCH_UTC)])
    out = {r["ticker"]: r["price"] for r in ingest.normalise_snapshots(df).collect()}
    # the producer only skips None and 0; negative and NaN pass (and are cut in staging)
    assert set(out) == {"C.NR", "D.NR"}
    assert out["C.NR"] == -1.5 and math.isnan(out["D.NR"])
    counts = {r["status"]: r["n"] for r in ingest.ingest_counts(df).collect()}
    assert counts == {"published": 2, "skipped": 2}


def test_universe_filter(spark):
    df = _snapshots(spark, [("SCOM.NR", 1.0, 1.0, 1.0, FETCH_UTC), ("XYZ.NR", 1.0, 1.0, 1.0, FETCH_UTC)])
    out = [r["ticker"] for r in ingest.normalise_snapshots(df, universe=ingest.NSE_UNIVERSE).collect()]
    assert out == ["SCOM.NR"]
    assert len(ingest.NSE_UNIVERSE) == 20


def test_fetched_at_outside_session_and_weekend_still_formatted(spark):
    sat = dt.datetime(2026, 4, 25, 5, 59, 0)    # Saturday 08:59 EAT
    df = _snapshots(spark, [("A.NR", 1.0, 1.0, 1.0, sat)])
    assert ingest.normalise_snapshots(df).first()["fetched_at"] == "2026-04-25T08:59:00+03:00"


# FIXTURES §2: (text, expected) — expected None means quarantine
CASES = [
    ('{"ticker":"A","price":1.5}', dict(ticker="A", name="", price=1.5, volume=0, market_cap=0.0,
                                        currency="KES", fetched_at="", exchange="NSE")),
    ('{"ticker":"A","price":"12.5","volume":"7"}', dict(ticker="A", price=12.5, volume=7)),
    ('{"ticker":"A","price":1,"volume":1.9}', dict(price=1.0, volume=1)),
    ("{}", dict(ticker="", price=0.0, volume=0)),
    ("not json", "malformed"),
    ("[1]", "malformed"),
    ('[{"ticker":"B"}]', "malformed"),
    ('{"ticker":"A","price":"abc"}', "bad_number"),
    ('{"ticker":"A","price":1,"volume":"x"}', "bad_number"),
    ('{"ticker":"A","price":NaN}', dict(ticker="A", price=float("nan"))),
    ('{"ticker":"A","price":1,"x":2}', dict(ticker="A", price=1.0)),
    ('{"ticker":"A","price":1,"fetched_at":"junk"}', dict(fetched_at="junk")),
    ('{"ticker":"A","price":null,"name":null}', dict(price=0.0, name="")),
    ('{"ticker":"SCOM.NR","name":"SCOM","price":17.85,"volume":5200000,"market_cap":715000000000.0,'
     '"currency":"KES","fetched_at":"2026-04-21T10:15:00.123456+03:00","exchange":"NSE"}',
     dict(ticker="SCOM.NR", name="SCOM", price=17.85, volume=5200000, market_cap=715e9,
          fetched_at="2026-04-21T10:15:00.123456+03:00")),
]


def test_parse_cases(spark):
    msgs = spark.createDataFrame([(t, i) for i, (t, _) in enumerate(CASES)], "value string, seq long")
    parsed = ingest.parse_messages(msgs)
    good = {r["seq"]: r for r in ingest.parsed_ticks(parsed).collect()}
    bad = {r["seq"]: r for r in ingest.quarantined(parsed).collect()}
    for i, (text, want) in enumerate(CASES):
        if isinstance(want, str):
            assert i in bad and i not in good, text
            assert bad[i]["reason"] == want and bad[i]["raw_value"] == text
            continue
        assert i in good and i not in bad, text
        for k, v in want.items():
            got = good[i][k]
            if isinstance(v, float) and math.isnan(v):
                assert math.isnan(got), text
            else:
                assert got == v, (text, k, got)


def test_publish_then_parse_round_trip(spark):
    ticks = spark.createDataFrame(
        [("SCOM.NR", "SCOM", 17.85, 5200000, 715e9, "KES", "2026-04-21T10:15:00.123456+03:00", "NSE", 1),
         ("KCB.NR", "KCB", 0.1 + 0.2, 0, 1.234e-5, "KES", "2026-04-21T10:15:00+03:00", "NSE", 2)],
        ", ".join(f"{c} {t}" for c, t in zip(TICK_COLS + ["seq"],
                                             ["string", "string", "double", "bigint", "double",
                                              "string", "string", "string", "bigint"])))
    msgs = ingest.to_messages(ticks)
    first = msgs.filter("seq = 1").first()
    assert first["key"] == "SCOM.NR"
    assert json.loads(first["value"])["price"] == 17.85
    back = ingest.parsed_ticks(ingest.parse_messages(msgs))
    assert sorted(back.collect()) == sorted(ticks.select(*TICK_COLS, "seq").collect())


def test_json_parsed_once_per_row(spark):
    msgs = spark.createDataFrame([('{"ticker":"A","price":1}', 1)], "value string, seq long")
    plan = ingest.parsed_ticks(ingest.parse_messages(msgs))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_to_bronze_columns(spark):
    msgs = spark.createDataFrame([('{"ticker":"A","price":1}', 7)], "value string, seq long")
    b = ingest.to_bronze(ingest.parsed_ticks(ingest.parse_messages(msgs)))
    assert b.columns == BRONZE_COLS
    r = b.first()
    assert r["seq"] == 7 and r["inserted_at"] is not None and r["inserted_at"].microsecond == 0
    assert dict(b.dtypes)["inserted_at"] == "timestamp_ntz"
    assert b.filter(F.col("inserted_at") <= F.lit(dt.datetime(2000, 1, 1))).count() == 0


def test_observed_publish_counters_equal_the_counts_table(spark):
    from pyspark.sql import Observation

    from ticksmith.sources import events_as_snapshots, read_events
    snaps = events_as_snapshots(read_events(spark, SF_SMALL))
    obs = Observation("producer")
    published = ingest.normalise_snapshots(ingest.observe_published(snaps, obs))
    n = published.count()   # the counters come with this pass, no second job
    table = {r["status"]: r["n"] for r in ingest.ingest_counts(snaps).collect()}
    assert obs.get == {"published": table["published"], "skipped": table["skipped"]}
    assert n == table["published"]


def test_messages_that_are_not_one_json_object_go_to_quarantine(spark):
    from ticksmith.operators.ingest import parse_messages
    texts = ['{"ticker":"A","price":1} trailing', "{'ticker':'A','price':1}", '{"ticker":"A","price":1}{"ticker":"B","price":2}',
             '{"ticker":"A","price":"12.5d"}', '{"ticker":"A","price":"0x1p3"}', '{"ticker":"A","price":1,"volume":9223372036854775808}',
             '{"ticker":"A","price":"\\"5\\""}', '{"ticker":"A","price":NaN}', '{"ticker":"A","price":"12.5","volume":"7"}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "seq long, value string")
    got = {r["seq"]: r["reject"] for r in parse_messages(df).collect()}
    assert [got[i] is None for i in range(len(texts))] == [False] * 7 + [True] * 2


def test_timestamps_need_a_full_date_and_time(spark):
    from pyspark.sql import functions as F

    from ticksmith.functions.timefn import parse_to_utc
    df = spark.createDataFrame([("10:15:00",), ("2024",), ("2024-01",), ("2024-01-02",), ("2024-01-02T10:15:00Z",)], "s string")
    assert [r[0] is None for r in df.select(parse_to_utc(F.col("s"))).collect()] == [True] * 4 + [False]
