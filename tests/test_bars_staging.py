"""Bars (A1), staging (F3, F4, D1) and their edge cases (FIXTURES §3-§4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ticksmith.functions import iso_local
from ticksmith.operators import bars, staging
from ticksmith.schemas import LOG_BRONZE, STAGED_TICK_COLS
from ticksmith.sources.events import events_as_log_bronze, read_events

from .conftest import SF_SMALL, rows

T0 = dt.datetime(2026, 4, 21, 7, 0, 0)   # 10:00 EAT, a Tuesday


def _ticks(spark, data):
    """(ticker, price, utc_time, seq[, inserted_at]) -> tick rows with ts."""
    full = [d if len(d) == 5 else (*d, d[2]) for d in data]
    return spark.createDataFrame(full, "ticker string, price double, ts timestamp_ntz, seq long, inserted_at timestamp_ntz")


def _bronze(spark, data):
    df = _ticks(spark, data)
    return df.select("ticker", F.col("ticker").alias("name"), "price", F.lit(0).cast("bigint").alias("volume"),
                     F.lit(0.0).alias("market_cap"), F.lit("KES").alias("currency"),
                     iso_local(F.col("ts"), "Africa/Nairobi").alias("fetched_at"),
                     F.lit("NSE").alias("exchange"), "inserted_at", "seq")


def test_bars_open_close_by_time_then_seq(spark):
    m = dt.timedelta(minutes=1)
    df = _ticks(spark, [
        ("A", 10.0, T0 + m, 3), ("A", 12.0, T0 + 2 * m, 1), ("A", 9.0, T0 + 2 * m, 2),
        ("A", 11.0, T0 + 4 * m, 4),
        ("A", 20.0, T0 + 5 * m, 5),           # exactly on the mark -> next bar
        ("B", 7.0, T0 + 3 * m, 6),            # single-tick bar
    ])
    out = rows(bars.ohlc_bars(df, "ts"))
    assert out == [
        ("A", T0, T0 + 5 * m, 10.0, 12.0, 9.0, 11.0, 4),
        ("A", T0 + 5 * m, T0 + 10 * m, 20.0, 20.0, 20.0, 20.0, 1),
        ("B", T0, T0 + 5 * m, 7.0, 7.0, 7.0, 7.0, 1),
    ]


def test_bars_tie_on_time_uses_seq(spark):
    df = _ticks(spark, [("A", 1.0, T0, 2), ("A", 2.0, T0, 1), ("A", 3.0, T0, 3)])
    r = bars.ohlc_bars(df, "ts").first()
    assert (r["open_price"], r["close_price"]) == (2.0, 3.0)


def test_bar_properties_on_driver_data(spark):
    from ticksmith.plans.catalog import bars_by_type
    from .conftest import SF_SMALL
    b = bars_by_type(spark, SF_SMALL)
    bad = b.filter((F.col("low_price") > F.col("open_price")) | (F.col("low_price") > F.col("close_price"))
                   | (F.col("high_price") < F.col("open_price")) | (F.col("high_price") < F.col("close_price")))
    assert bad.count() == 0
    n = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert b.agg(F.sum("tick_count")).first()[0] == n


def test_bars_use_hash_aggregation(spark):
    df = _ticks(spark, [("A", 1.0, T0, 1)])
    plan = bars.ohlc_bars(df, "ts")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_stage_bars_filter(spark):
    df = spark.createDataFrame([
        ("A", T0, T0, 1.0, 1.0, 0.0, 1.0, 2),      # low 0 kept
        ("B", T0, T0, 0.0, 1.0, 0.0, 1.0, 2),      # open 0 cut
        ("C", T0, T0, 1.0, 1.0, 1.0, 0.0, 2),      # close 0 cut
        ("D", T0, T0, 1.0, 1.0, 1.0, 1.0, 0),      # empty window cut
        ("E", T0, T0, float("nan"), 1.0, 1.0, 1.0, 1),  # NaN open cut
    ], "ticker string, window_start timestamp_ntz, window_end timestamp_ntz, open_price double, "
       "high_price double, low_price double, close_price double, tick_count long")
    out = staging.stage_bars(df).collect()
    assert [r["ticker"] for r in out] == ["A"]
    assert out[0]["trade_date"] == dt.date(2026, 4, 21)


def test_stage_ticks_valid_filter_and_types(spark):
    b = _bronze(spark, [("A", 1.0, T0, 1), ("A", 0.0, T0 + dt.timedelta(minutes=1), 2),
                        ("A", -1.0, T0 + dt.timedelta(minutes=2), 3),
                        ("A", float("nan"), T0 + dt.timedelta(minutes=3), 4),
                        ("", 5.0, T0 + dt.timedelta(minutes=4), 5)])
    out = staging.stage_ticks(b)
    assert out.columns == STAGED_TICK_COLS
    assert rows(out, "seq") == [(1,)]
    r = out.first()
    assert r["fetched_at"] == T0 and r["trade_date"] == dt.date(2026, 4, 21)


def test_dedup_keeps_latest_per_ticker_minute(spark):
    ins = T0 + dt.timedelta(hours=1)
    b = _bronze(spark, [
        ("A", 1.0, T0 + dt.timedelta(seconds=5), 1, ins),
        ("A", 2.0, T0 + dt.timedelta(seconds=50), 2, ins + dt.timedelta(seconds=1)),   # latest insert wins
        ("A", 3.0, T0 + dt.timedelta(seconds=61), 3, ins),                               # next minute
        ("B", 4.0, T0 + dt.timedelta(seconds=5), 4, ins),                                # other ticker
        ("C", 5.0, T0 + dt.timedelta(seconds=1), 5, ins),                                # equal insert time:
        ("C", 6.0, T0 + dt.timedelta(seconds=2), 6, ins),                                # higher seq wins
    ])
    out = rows(staging.stage_ticks(b), "ticker", "price")
    assert out == [("A", 2.0), ("A", 3.0), ("B", 4.0), ("C", 6.0)]


def test_dedup_is_idempotent_on_driver_data(spark):
    from ticksmith.plans.catalog import bronze_by_type
    from .conftest import SF_SMALL
    b = bronze_by_type(spark, SF_SMALL)
    once = staging.stage_ticks(b)
    keep = once.select("seq")
    twice = staging.stage_ticks(b.join(keep, "seq", "left_semi"))
    assert rows(once, "seq") == rows(twice, "seq")
    # every (ticker, minute) appears once
    dup = once.groupBy("ticker", F.date_trunc("minute", "fetched_at")).count().filter("count > 1")
    assert dup.count() == 0


def test_late_evening_tick_gets_local_trade_date(spark):
    # 00:30 EAT on 22 April is 21:30 UTC on 21 April
    b = _bronze(spark, [("A", 1.0, dt.datetime(2026, 4, 21, 21, 30), 1)])
    assert staging.stage_ticks(b).first()["trade_date"] == dt.date(2026, 4, 22)


def test_unparsable_fetched_at_goes_to_rejects(spark):
    b = _bronze(spark, [("A", 1.0, T0, 1), ("A", 2.0, T0, 2)]).withColumn(
        "fetched_at", F.when(F.col("seq") == 2, F.lit("junk")).otherwise(F.col("fetched_at")))
    assert rows(staging.stage_ticks(b), "seq") == [(1,)]
    rej = staging.stage_rejects(b).collect()
    assert [(r["seq"], r["fetched_at_raw"]) for r in rej] == [(2, "junk")]


def test_latest_prices_equals_stage_ticks(spark):
    from ticksmith.plans.catalog import bronze_by_type
    from .conftest import SF_SMALL
    b = bronze_by_type(spark, SF_SMALL)
    fast = staging.latest_prices(b)
    slow = staging.stage_ticks(b).select("ticker", "price", "fetched_at", "trade_date")
    assert rows(fast) == rows(slow)
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Window" not in plan


def test_dedup_trims_hot_keys_before_the_shuffle(spark):
    from ticksmith.plans.catalog import bronze_by_type
    plan = staging.stage_ticks(bronze_by_type(spark, SF_SMALL))._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    partial = [i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln and "Partial" in ln]
    final = [i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln and "Final" in ln]
    shuffle = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning(ticker" in ln]
    # printed top-down: Final limit, then the shuffle on (ticker, minute), then
    # the Partial limit that runs in each map task before it
    assert partial and final and shuffle
    assert final[0] < shuffle[0] < partial[0]


def test_latest_tick_of_a_partitioned_log(spark):
    at = dt.datetime(2026, 4, 21, 7, 1)
    text = "2026-04-21T10:01:00+03:00"
    # (price, inserted_at, seq, partition): the insertion time, then the partition, then the offset decide
    ticks = [(1.0, at, 9, 0), (2.0, at, 3, 2), (3.0, at, 3, 1), (4.0, at, 4, None), (5.0, None, 99, 7), (6.0, at, None, 2)]
    for order in (ticks, ticks[::-1]):
        bronze = spark.createDataFrame([("A", "A", p, 0, 0.0, "KES", text, "NSE", t, s, q) for p, t, s, q in order], LOG_BRONZE).repartition(3)
        assert rows(staging.stage_ticks(bronze), "price", "seq") == [(2.0, 3)]
        assert rows(staging.latest_prices(bronze), "price") == [(2.0,)]
        only = bronze.where("price = 5.0 OR price = 4.0")    # a row without insertion time is the oldest
        assert rows(staging.stage_ticks(only), "price") == rows(staging.latest_prices(only), "price") == [(4.0,)]


def test_log_queries_depend_on_the_partition(spark):
    bronze = events_as_log_bronze(read_events(spark, SF_SMALL))
    assert bronze.groupBy("ticker", "inserted_at", "seq").count().where("count > 1").count() > 0
    assert bronze.where("partition IS NULL").count() > 0
    other = rows(staging.latest_prices(bronze.drop("partition")), "ticker", "price", "fetched_at")
    assert rows(staging.latest_prices(bronze), "ticker", "price", "fetched_at") != other
