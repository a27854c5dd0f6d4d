"""Column expressions: rounding, NaN guards, zone-free time arithmetic."""

from __future__ import annotations

import datetime as dt
import math
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from ticksmith.functions import (epoch_order_key, floor_time, in_session, is_positive, iso_local,
                                 local_date, month_key, no_negative_zero, ntz_micros,
                                 parse_to_utc, round_half_even)


def test_round_half_even_two_places(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (1.005,), (-0.125,), (17.854,)], "x double")
    got = [r[0] for r in df.select(round_half_even(F.col("x"))).collect()]
    # ties to even after scaling (0.125 -> 0.12, 0.375 -> 0.38); 1.005 is
    # 1.00499... in binary
    assert got == [0.12, 0.38, 1.0, -0.12, 17.85]
    # Spark's own round is HALF_UP — the trap this function avoids
    assert df.select(F.round("x", 2)).first()[0] == 0.13


def test_negative_zero_normalised(spark):
    df = spark.createDataFrame([(-0.0,), (0.0,), (-1.5,)], "x double")
    got = [r[0] for r in df.select(no_negative_zero(F.col("x"))).collect()]
    assert [math.copysign(1, v) for v in got] == [1.0, 1.0, -1.0]


def test_is_positive_fails_nan_zero_negative_null(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-2.0,), (float("nan"),), (None,)], "x double")
    got = [r[0] for r in df.select(is_positive(F.col("x"))).collect()]
    assert got == [True, False, False, False, None]
    # the raw comparison lets NaN through in Spark
    assert df.filter(F.col("x") > 0).count() == 2


INSTANTS = [
    dt.datetime(2026, 4, 21, 7, 15, 0, 123456),
    dt.datetime(2026, 4, 21, 7, 15, 0),           # no fraction -> isoformat drops it
    dt.datetime(2026, 4, 20, 21, 30, 0, 1),       # 00:30 EAT next local day
    dt.datetime(2024, 3, 10, 7, 30, 15, 500000),  # New York spring-forward hour
    dt.datetime(2024, 11, 3, 5, 30, 0, 250),      # New York fall-back hour
]


@pytest.mark.parametrize("tz", ["Africa/Nairobi", "America/New_York", "Asia/Kolkata", "UTC"])
@pytest.mark.parametrize("session_tz", ["UTC", "America/New_York"])
def test_iso_local_matches_python_isoformat(spark, tz, session_tz):
    spark.conf.set("spark.sql.session.timeZone", session_tz)
    try:
        df = spark.createDataFrame([(t,) for t in INSTANTS], "utc timestamp_ntz")
        got = [r[0] for r in df.select(iso_local(F.col("utc"), tz)).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    want = [t.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(tz)).isoformat() for t in INSTANTS]
    assert got == want


@pytest.mark.parametrize("session_tz", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_parse_round_trip_and_trade_date(spark, session_tz):
    spark.conf.set("spark.sql.session.timeZone", session_tz)
    try:
        df = spark.createDataFrame([(t,) for t in INSTANTS], "utc timestamp_ntz")
        out = df.select("utc", parse_to_utc(iso_local(F.col("utc"), "Africa/Nairobi")).alias("back"),
                        local_date(F.col("utc"), "Africa/Nairobi").alias("d")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    for r in out:
        assert r["back"] == r["utc"]
        assert r["d"] == (r["utc"] + dt.timedelta(hours=3)).date()


def test_parse_junk_is_null(spark):
    df = spark.createDataFrame([("junk",), ("",), (None,), ("2026-04-21T10:15:00+03:00",)], "s string")
    got = [r[0] for r in df.select(parse_to_utc(F.col("s"))).collect()]
    assert got == [None, None, None, dt.datetime(2026, 4, 21, 7, 15)]


def test_ntz_micros_and_floor_are_zone_free(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        t = dt.datetime(2024, 3, 10, 2, 30, 15, 123456)  # does not exist in New York
        df = spark.createDataFrame([(t,)], "t timestamp_ntz")
        r = df.select(ntz_micros(F.col("t")).alias("us"),
                      floor_time(F.col("t"), "1 minute").alias("m"),
                      floor_time(F.col("t"), "5 minutes").alias("b"),
                      month_key(F.col("t")).alias("ym")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert r["us"] == int((t - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000 + 123456
    assert r["m"] == dt.datetime(2024, 3, 10, 2, 30)
    assert r["b"] == dt.datetime(2024, 3, 10, 2, 30)
    assert r["ym"] == 202403


def test_session_predicate_boundaries(spark):
    # local EAT times -> UTC by subtracting 3h; 2026-04-21 is a Tuesday, 04-25 a Saturday
    local = [
        (dt.datetime(2026, 4, 21, 8, 59, 59), False),
        (dt.datetime(2026, 4, 21, 9, 0, 0), True),
        (dt.datetime(2026, 4, 21, 15, 29, 59), True),
        (dt.datetime(2026, 4, 21, 15, 30, 0), False),
        (dt.datetime(2026, 4, 25, 10, 0, 0), False),
        (dt.datetime(2026, 4, 27, 9, 0, 0), True),    # Monday
        (dt.datetime(2026, 4, 24, 15, 29, 0), True),  # Friday
        (dt.datetime(2026, 4, 26, 12, 0, 0), False),  # Sunday
    ]
    df = spark.createDataFrame([(t - dt.timedelta(hours=3), ok) for t, ok in local], "utc timestamp_ntz, ok boolean")
    got = df.select(in_session(F.col("utc")).alias("g"), "ok").collect()
    assert [r["g"] for r in got] == [r["ok"] for r in got]


def test_epoch_order_key_orders_like_the_pair(spark):
    pairs = [(5, 0), (5, 10**18), (6, 0), (-3, 7), (-3, 8), (0, 9_999_999_999_999_999_999 // 10)]
    df = spark.createDataFrame([(a, b) for a, b in pairs], "us long, seq long")
    got = [(r["us"], r["seq"]) for r in df.orderBy(epoch_order_key(F.col("us"), F.col("seq"))).collect()]
    assert got == sorted(pairs)
