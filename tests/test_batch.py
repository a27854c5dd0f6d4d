"""The composed scheduled run: marts stored once, checks and report over them."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ticksmith.operators import marts
from ticksmith.plans import batch
from ticksmith.plans.catalog import bronze_by_user

from .conftest import SF_SMALL, rows


def test_build_marts_stores_partitioned_tables(spark, tmp_dir):
    bronze = bronze_by_user(spark, SF_SMALL)
    m = batch.build_marts(bronze, out_dir=tmp_dir, updated_at="2024-02-01 00:00:00")
    assert any(d.startswith("ym=") for d in os.listdir(os.path.join(tmp_dir, "daily_summary")))
    assert any(d.startswith("ym=") for d in os.listdir(os.path.join(tmp_dir, "top_movers")))
    want_daily = marts.daily_summary_from_bronze(bronze, "2024-02-01 00:00:00")
    assert rows(m.daily_summary) == rows(want_daily)
    assert rows(m.top_movers) == rows(marts.top_movers(want_daily))
    # the stored marts are what the movers read: no tick scan under them
    plan = m.top_movers._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in plan


def test_run_day_checks_report_health(spark):
    bronze = bronze_by_user(spark, SF_SMALL)
    m = batch.build_marts(bronze)
    day = m.daily_summary.agg(F.max("trade_date")).first()[0]
    res = batch.run_day(m, day)
    checks = res.checks.collect()
    assert len(checks) == 22 and all(r["failures"] == 0 for r in checks)
    rep = res.report.collect()
    assert rep and all(r["rank"] <= 3 and r["trade_date"] == day for r in rep)
    assert res.health.first()["tick_count"] >= 0


def test_register_views_for_ad_hoc_sql(spark):
    from ticksmith.operators.reports import peek
    m = batch.build_marts(bronze_by_user(spark, SF_SMALL))
    names = m.register_views(prefix="t_")
    assert names == ["t_raw_ticks", "t_ohlcv_5min", "t_stg_ticks", "t_stg_bars",
                     "t_daily_summary", "t_top_movers"]
    # the peek query of the reference, as SQL over the view
    got = spark.sql("SELECT ticker, price, fetched_at FROM t_raw_ticks "
                    "ORDER BY ticker, inserted_at, seq LIMIT 10").collect()
    assert got == peek(m.raw_ticks, ordered=True).collect()
    assert spark.sql("SELECT count(*) FROM t_top_movers").first()[0] == m.top_movers.count()


def test_check_counts_need_no_sort_of_the_ticks(spark):
    from ticksmith.operators import quality
    m = batch.build_marts(bronze_by_user(spark, SF_SMALL))
    fast = quality.run_checks(m.check_tables())
    assert rows(fast) == rows(quality.run_checks(m.tables()))
    staging_only = [c for c in quality.REFERENCE_CHECKS if c.table == "stg_ticks"]
    plan = quality.run_checks(m.check_tables(), staging_only)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort " not in plan and "SortAggregate" not in plan


def test_incremental_rebuild_replaces_only_recent_months(spark, tmp_dir):
    import datetime as dt

    from ticksmith.functions.timefn import NAIROBI, iso_local, parse_to_utc
    stamp = "2024-02-01 00:00:00"
    jan = bronze_by_user(spark, SF_SMALL)
    # the same feed 40 days earlier gives a second trading month
    shift = F.expr("INTERVAL 40 DAYS")
    dec = (jan.withColumn("fetched_at", iso_local(parse_to_utc(F.col("fetched_at")) - shift, NAIROBI))
           .withColumn("inserted_at", F.col("inserted_at") - shift)
           .withColumn("seq", F.col("seq") + F.lit(10 ** 9)))
    bronze = jan.unionByName(dec)
    since = dt.date(2024, 1, 1)
    batch.build_marts(bronze, out_dir=tmp_dir, updated_at=stamp)
    # the feed changes everywhere; only January is rebuilt
    changed = bronze.withColumn("price", F.col("price") + F.lit(1.0))
    m = batch.build_marts(changed, out_dir=tmp_dir, updated_at=stamp, since=since)
    old = marts.daily_summary_from_bronze(bronze, stamp)
    new = marts.daily_summary_from_bronze(changed, stamp)
    before, after = F.col("trade_date") < F.lit(since), F.col("trade_date") >= F.lit(since)
    want = old.filter(before).unionByName(new.filter(after))
    assert m.daily_summary.filter(before).count() > 0 and m.daily_summary.filter(after).count() > 0
    assert rows(m.daily_summary) == rows(want)
    assert rows(m.top_movers) == rows(marts.top_movers(want))


def test_incremental_rebuild_takes_late_ticks_and_empties_months(spark, tmp_dir):
    import datetime as dt

    from ticksmith.schemas import BRONZE

    def bronze(ticks):
        return spark.createDataFrame([(t, t, p, 0, 0.0, "KES", f"{at.isoformat()}+00:00", "NSE", ins, i)
                                      for i, (t, p, at, ins) in enumerate(ticks)], BRONZE)

    at, stamp = dt.datetime, "2026-06-01 00:00:00"
    april = [("A", 10.0, at(2026, 4, 21, 8), at(2026, 4, 21, 8)), ("A", 13.0, at(2026, 4, 21, 9), at(2026, 4, 21, 9))]
    may = [("B", 10.0, at(2026, 5, 5, 8), at(2026, 5, 5, 8)), ("B", 13.0, at(2026, 5, 5, 9), at(2026, 5, 5, 9))]
    batch.build_marts(bronze(april + may), out_dir=tmp_dir, updated_at=stamp)
    # May's gain is gone, and a tick of April arrives in May
    changed = bronze(april + [may[0], ("B", 10.0, at(2026, 5, 5, 9), at(2026, 5, 5, 9)),
                              ("A", 99.0, at(2026, 4, 21, 10), at(2026, 5, 6, 8))])
    m = batch.build_marts(changed, out_dir=tmp_dir, updated_at=stamp, since="2026-05-01")
    want = marts.daily_summary_from_bronze(changed, stamp)
    assert rows(m.daily_summary) == rows(want)
    assert rows(m.top_movers) == rows(marts.top_movers(want))


def test_recent_bronze_prunes_month_directories(spark, tmp_dir):
    import datetime as dt
    from ticksmith.plans import storage
    from ticksmith.schemas import BRONZE
    path = os.path.join(tmp_dir, "bronze")
    storage.write_table(bronze_by_user(spark, SF_SMALL), path, partition_source="inserted_at",
                        sort_cols=["ticker", "inserted_at"])
    stored = spark.read.schema(storage.table_schema(BRONZE)).parquet(path)
    last = stored.agg(F.max("ym")).first()[0]
    recent = batch.recent_bronze(stored, dt.date(last // 100, last % 100, 1))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ym" in plan and "(ym#" in plan
