"""Data-quality checks (§2.13, FIXTURES §7) and reports (§2.14)."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from ticksmith.operators import quality, reports
from ticksmith.operators.quality import ACCEPTED_RANGE, ACCEPTED_VALUES, NOT_NULL, Check

from .conftest import SF_SMALL, rows


def test_reference_check_inventory():
    kinds = [c.kind for c in quality.REFERENCE_CHECKS]
    assert (kinds.count(NOT_NULL), kinds.count(ACCEPTED_RANGE), kinds.count(ACCEPTED_VALUES)) == (17, 4, 1)


def test_each_kind_pass_fail_null_nan(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "gainer", 1), (2, None, "loser", 5), (3, 0.0, "flat", 6),
         (4, float("nan"), None, None), (5, -1.0, "gainer", 0)],
        "id int, price double, direction string, rank int")
    checks = [
        Check("t", "price", NOT_NULL),
        Check("t", "price", ACCEPTED_RANGE, min_value=0, inclusive=False),
        Check("t", "direction", ACCEPTED_VALUES, values=("gainer", "loser")),
        Check("t", "rank", ACCEPTED_RANGE, min_value=1, max_value=5),
        Check("t", "rank", NOT_NULL, severity="error"),
    ]
    res = {(r["column_name"], r["check_name"]): r["failures"]
           for r in quality.run_checks({"t": df}, checks).collect()}
    assert res == {
        ("price", "not_null"): 1,
        ("price", "accepted_range"): 3,        # 0, NaN, -1 fail; NULL passes
        ("direction", "accepted_values"): 1,   # 'flat'; NULL passes
        ("rank", "accepted_range"): 2,         # 6 and 0
        ("rank", "not_null"): 1,
    }
    blocking = quality.blocking_failures(quality.run_checks({"t": df}, checks)).collect()
    assert [(r["column_name"], r["failures"]) for r in blocking] == [("rank", 1)]
    fr = quality.failing_rows({"t": df}, checks)
    got = sorted((json.loads(r["row_json"])["id"], r["column_name"], r["check_name"]) for r in fr.collect())
    assert got == [(2, "price", "not_null"), (3, "direction", "accepted_values"), (3, "price", "accepted_range"),
                   (3, "rank", "accepted_range"), (4, "price", "accepted_range"), (4, "rank", "not_null"),
                   (5, "price", "accepted_range"), (5, "rank", "accepted_range")]


def test_checks_one_scan_per_table(spark):
    df = spark.createDataFrame([(1.0,)], "price double")
    checks = [Check("t", "price", NOT_NULL), Check("t", "price", ACCEPTED_RANGE, min_value=0)]
    plan = quality.run_checks({"t": df}, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") + plan.count("Scan") >= 1
    assert plan.count("HashAggregate") == 2   # partial + final of the single aggregation


INS = dt.datetime(2026, 4, 21, 8, 0)


def _bronze(spark):
    data = [("A", 10.0, INS), ("B", 12.0, INS), ("A", 11.0, INS + dt.timedelta(hours=1)),
            ("C", 3.0, INS - dt.timedelta(days=1)), ("C", 4.0, INS - dt.timedelta(days=2))]
    return spark.createDataFrame(
        [(t, p, "2026-04-21T11:00:00+03:00", i, k) for k, (t, p, i) in enumerate(data)],
        "ticker string, price double, fetched_at string, inserted_at timestamp_ntz, seq long")


def test_health_today_and_guard(spark):
    b = _bronze(spark)
    r = reports.health_today(b, "2026-04-21").first()
    assert (r["tick_count"], r["ticker_count"]) == (3, 2)
    assert r["line"] == f"Today's ticks so far: {3:,} rows across 2 tickers"
    assert reports.assert_ticks_today(reports.health_today(b, "2026-04-21")) == 3
    with pytest.raises(ValueError):
        reports.assert_ticks_today(reports.health_today(b, "2026-05-01"))
    latest = reports.health_today(b, reports.latest_day(b, "inserted_at")).first()
    assert latest["tick_count"] == 3


def test_health_by_day(spark):
    out = reports.health_by_day(_bronze(spark), "2026-04-21").collect()
    assert [(r["day"], r["total_ticks"], r["unique_tickers"], r["min_price"], r["max_price"]) for r in out] == [
        (dt.date(2026, 4, 21), 3, 2, 10.0, 12.0), (dt.date(2026, 4, 20), 1, 1, 3.0, 3.0)]


def test_movers_report_lines_match_python_format(spark):
    d = dt.date(2026, 4, 21)
    movers = spark.createDataFrame(
        [(d, "gainer", i + 1, f"G{i}", 1.0, 5.0 - i) for i in range(5)]
        + [(d, "loser", 1, "SCOM.NR", 1.0, -0.5), (d - dt.timedelta(days=1), "gainer", 1, "OLD", 1.0, 9.0)],
        "trade_date date, direction string, rank int, ticker string, close_price double, pct_change double")
    out = reports.movers_report(movers, d).collect()
    assert [(r["direction"], r["rank"]) for r in out] == [("gainer", 1), ("gainer", 2), ("gainer", 3), ("loser", 1)]
    for r in out:
        arrow = "↑" if r["direction"] == "gainer" else "↓"
        assert r["line"] == f"  {arrow} {r['ticker']:8s}  {r['pct_change']:+.2f}%  ({r['direction']})"


def test_peek_is_a_plain_limit_unless_ordered(spark):
    b = _bronze(spark)
    out = reports.peek(b, 2, ordered=True).collect()
    assert [(r["ticker"], r["price"]) for r in out] == [("A", 10.0), ("A", 11.0)]
    assert reports.peek(b).count() == 5 and reports.peek(b, 2).count() == 2
    assert "Sort" not in reports.peek(b)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" in reports.peek(b, ordered=True)._jdf.queryExecution().executedPlan().toString()


def test_health_reads_only_the_months_of_its_days(spark, tmp_dir):
    import os

    from ticksmith.plans import storage
    from ticksmith.plans.catalog import bronze_by_user
    from ticksmith.schemas import BRONZE
    b = bronze_by_user(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "bronze")
    storage.write_table(b, path, partition_source="inserted_at", sort_cols=["ticker", "inserted_at"])
    stored = spark.read.schema(storage.table_schema(BRONZE)).parquet(path)
    day = reports.latest_day(stored, "inserted_at")
    for report in (reports.health_today, reports.health_by_day):
        assert rows(report(stored, day)) == rows(report(b, reports.latest_day(b, "inserted_at")))
        plan = report(stored, "2024-01-30")._jdf.queryExecution().executedPlan().toString()
        assert "ym" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_health_distinct_counts_combine_map_side(spark):
    from ticksmith.plans.catalog import bronze_by_user
    b = bronze_by_user(spark, SF_SMALL)
    plan = reports.health_by_day(b, "2024-01-30")._jdf.queryExecution().executedPlan().toString()
    lines = [ln for ln in plan.splitlines() if "Aggregate" in ln or "Exchange hashpartitioning" in ln]
    # bottom-up: partial aggregation on (day, ticker) in each task, then the
    # first shuffle on (day, ticker): a hot ticker ships one row per task
    first_shuffle = max(i for i, ln in enumerate(lines) if "Exchange hashpartitioning(_groupingexpression" in ln
                        and "ticker" in ln)
    below = lines[first_shuffle + 1]
    assert "HashAggregate" in below and "ticker" in below and "partial_count(1)" in below
    assert "SortAggregate" not in plan


def test_the_bars_are_aggregated_once_for_all_checks(spark):
    from ticksmith.operators import quality
    from ticksmith.plans import catalog
    checks = quality.run_checks(catalog.quality_marts(spark, "/root/testdata/sf0.001").check_tables())
    assert checks._jdf.queryExecution().optimizedPlan().toString().count("precisetimestampconversion") == 0
    assert checks.count() == 22
