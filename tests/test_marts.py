"""Daily summary and top movers (FIXTURES §5-§6)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ticksmith.operators import marts

from .conftest import SF_SMALL, rows

D = dt.date(2026, 4, 21)
T0 = dt.datetime(2026, 4, 21, 7, 0, 0)


def _staged(spark, data):
    """(ticker, [prices in time order]) -> staged ticks, one per minute."""
    out, seq = [], 0
    for ticker, prices in data:
        for i, p in enumerate(prices):
            seq += 1
            out.append((ticker, p, T0 + dt.timedelta(minutes=i), D, seq))
    return spark.createDataFrame(out, "ticker string, price double, fetched_at timestamp_ntz, trade_date date, seq long")


def test_daily_summary_values_and_rounding(spark):
    st = _staged(spark, [
        ("FLAT", [10.0, 11.0, 10.0]),          # open = close -> 0 change
        ("TINY", [1000.0, 1000.04]),           # |pct| < 0.005 -> 0
        ("HALF", [8.0, 8.01]),                 # pct 0.125 -> 0.12 (half to even)
        ("UP", [2.0, 1.0, 3.0]),
        ("ZERO", [0.0, 5.0]),                  # open 0 -> dropped
    ])
    d = {r["ticker"]: r for r in marts.daily_summary(st, updated_at="2026-04-21 12:35:00").collect()}
    assert set(d) == {"FLAT", "TINY", "HALF", "UP"}
    assert (d["FLAT"]["price_change"], d["FLAT"]["pct_change"], d["FLAT"]["total_ticks"]) == (0.0, 0.0, 3)
    assert d["TINY"]["pct_change"] == 0.0 and d["TINY"]["price_change"] == 0.04
    assert d["HALF"]["pct_change"] == 0.12
    u = d["UP"]
    assert (u["open_price"], u["high_price"], u["low_price"], u["close_price"]) == (2.0, 3.0, 1.0, 3.0)
    assert (u["price_change"], u["pct_change"], u["total_ticks"]) == (1.0, 50.0, 3)
    assert u["updated_at"] == dt.datetime(2026, 4, 21, 12, 35)


def _daily(spark, data):
    return spark.createDataFrame(
        [(D, t, 1.0, 1.0, 1.0, 1.0, 0.0, p, n, None) for t, p, n in data],
        "trade_date date, ticker string, open_price double, high_price double, low_price double, "
        "close_price double, price_change double, pct_change double, total_ticks long, updated_at timestamp_ntz")


def test_movers_top_five_each_side_with_ties(spark):
    data = [(f"G{i}", float(10 - i), 3) for i in range(7)]          # 7 gainers
    data += [("TIE_B", 9.0, 3), ("TIE_A", 9.0, 3)]                  # ties with G1
    data += [(f"L{i}", -float(i + 1), 3) for i in range(2)]         # 2 losers only
    data += [("FLAT", 0.0, 3), ("FEW", 50.0, 2)]                    # not eligible
    daily = _daily(spark, data)
    out = rows(marts.top_movers(daily), "direction", "rank", "ticker")
    assert out == [("gainer", 1, "G0"), ("gainer", 2, "G1"), ("gainer", 3, "TIE_A"),
                   ("gainer", 4, "TIE_B"), ("gainer", 5, "G2"),
                   ("loser", 1, "L1"), ("loser", 2, "L0")]
    assert rows(marts.top_movers_single_pass(daily)) == rows(marts.top_movers(daily))


def test_movers_no_losers_and_fewer_than_five(spark):
    daily = _daily(spark, [("A", 1.0, 3), ("B", 2.0, 5)])
    out = rows(marts.top_movers(daily), "direction", "rank", "ticker")
    assert out == [("gainer", 1, "B"), ("gainer", 2, "A")]


def test_movers_on_driver_data_forms_agree_and_ranks_are_contiguous(spark):
    from ticksmith.plans.catalog import bronze_by_user
    b = bronze_by_user(spark, SF_SMALL)
    daily = marts.daily_summary_from_bronze(b).drop("updated_at")
    two = marts.top_movers(daily)
    one = marts.top_movers_single_pass(daily)
    assert rows(two) == rows(one)
    gaps = (two.groupBy("trade_date", "direction")
            .agg(F.max("rank").alias("mx"), F.count("*").alias("n"))
            .filter("mx != n OR mx > 5"))
    assert gaps.count() == 0


def test_sort_free_daily_equals_composition(spark):
    from ticksmith.operators import staging
    from ticksmith.plans.catalog import bronze_by_user
    b = bronze_by_user(spark, SF_SMALL)
    fast = marts.daily_summary_from_bronze(b).drop("updated_at")
    slow = marts.daily_summary(staging.stage_ticks(b)).drop("updated_at")
    assert rows(fast) == rows(slow)


def test_movers_plans(spark):
    daily = _daily(spark, [("A", 1.0, 3)])
    # single pass: top-k per (day, side) trimmed inside each task before the shuffle
    plan = marts.top_movers_single_pass(daily)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    # two branches: each trims to the top k inside each task before its shuffle
    plan = marts.top_movers(daily)._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and plan.count("WindowGroupLimit") >= 4


def test_movers_branches_reuse_the_daily_computation(spark):
    from ticksmith.plans.catalog import daily_by_user
    df = marts.top_movers(daily_by_user(spark, SF_SMALL))
    df.collect()   # runs this query execution, so its adaptive plan is final
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the tick scan and the daily aggregation under both branches run once
    assert "ReusedExchange" in plan
    assert plan.count("FileScan parquet") == 1


def test_ordered_readers(spark):
    daily = _daily(spark, [("A", 1.0, 3), ("B", 2.0, 3)])
    assert [r["ticker"] for r in marts.ordered_daily(daily).collect()] == ["B", "A"]
    mv = marts.ordered_movers(marts.top_movers(daily)).collect()
    assert [r["rank"] for r in mv] == [1, 2]


def test_session_only_daily_drops_ticks_outside_hours(spark):
    from ticksmith.functions import iso_local
    # 08:59 EAT and 15:30 EAT are outside the session; 09:00 and 15:29 inside
    local = [dt.datetime(2026, 4, 21, 8, 59), dt.datetime(2026, 4, 21, 9, 0),
             dt.datetime(2026, 4, 21, 15, 29), dt.datetime(2026, 4, 21, 15, 30)]
    data = [("A", float(i + 1), t - dt.timedelta(hours=3), i) for i, t in enumerate(local)]
    df = spark.createDataFrame(data, "ticker string, price double, utc timestamp_ntz, seq long")
    bronze = df.select("ticker", F.col("ticker").alias("name"), "price", F.lit(0).cast("bigint").alias("volume"),
                       F.lit(0.0).alias("market_cap"), F.lit("KES").alias("currency"),
                       iso_local(F.col("utc"), "Africa/Nairobi").alias("fetched_at"),
                       F.lit("NSE").alias("exchange"), F.col("utc").alias("inserted_at"), "seq")
    all_day = marts.daily_summary_from_bronze(bronze).first()
    session = marts.daily_summary_from_bronze(bronze, session_only=True).first()
    assert (all_day["open_price"], all_day["close_price"], all_day["total_ticks"]) == (1.0, 4.0, 4)
    assert (session["open_price"], session["close_price"], session["total_ticks"]) == (2.0, 3.0, 2)
