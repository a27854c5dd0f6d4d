"""Declared tables, checks counted by the write pass, published order, explicit zones, sized layout."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from ticksmith.functions.timefn import parse_to_utc
from ticksmith.operators import marts, quality
from ticksmith.plans import batch, manifest, storage
from ticksmith.plans.catalog import bars_by_type, bronze_by_user, quality_marts
from ticksmith.plans.manifest import MonthTable
from ticksmith.schemas import BAR, BRONZE, STORED_BAR, conform, create_table
from ticksmith.sources.events import spoiled_tables

from .conftest import SF_SMALL, rows


def test_a_row_without_currency_reads_back_the_default(spark, tmp_dir):
    spark.sql("DROP TABLE IF EXISTS declared_ticks")
    create_table(spark, "declared_ticks", BRONZE, os.path.join(tmp_dir, "t"), part_col="ym")
    create_table(spark, "declared_ticks", BRONZE, os.path.join(tmp_dir, "t"), part_col="ym")   # declared once
    spark.sql("INSERT INTO declared_ticks (ticker, price, ym) VALUES ('A', 1.5, 202401)")
    assert spark.sql("SELECT ticker, price, currency, exchange, name, ym FROM declared_ticks").first() == ("A", 1.5, "KES", "NSE", None, 202401)
    described = spark.sql("DESCRIBE TABLE declared_ticks").collect()     # columns first, then the defaults
    found = {r["col_name"]: (r["data_type"], r["comment"]) for r in reversed(described)}
    for f in BRONZE.fields:
        assert found[f.name] == (f.dataType.simpleString(), f.metadata.get("comment"))
    spark.sql("DROP TABLE declared_ticks")


def test_sinks_fill_declared_defaults(spark, tmp_dir):
    table = MonthTable(spark, os.path.join(tmp_dir, "t"), BRONZE)
    table.replace(spark.createDataFrame([("A", 2.0, 202401)], "ticker string, price double, ym int"))
    assert table.read().select("currency", "exchange", "volume").first() == ("KES", "NSE", None)
    assert conform(spark.createDataFrame([("A",)], "ticker string"), BRONZE, defaults={}).select("currency").first()[0] is None
    assert set(BAR.fieldNames()) < set(STORED_BAR.fieldNames()) and "inserted_at" in STORED_BAR.fieldNames()


def test_every_declared_check_can_fail(spark):
    spoiled = spoiled_tables(quality_marts(spark, SF_SMALL).tables())
    got = rows(quality.run_checks(spoiled), "table_name", "column_name", "check_name", "failures")
    assert len(got) == 22
    failing = quality.failing_rows(spoiled).groupBy("table_name", "column_name", "check_name").count()
    assert rows(failing, "table_name", "column_name", "check_name", "count") == [r for r in got if r[3]]
    empty = {"stg_bars", "ohlcv_5min", "top_movers"}       # of small groups some days or minutes may be missing
    assert all(n > 0 for t, _, _, n in got if t not in empty)


def test_written_checks_equal_run_checks_without_a_scan(spark, tmp_dir):
    bronze = bronze_by_user(spark, SF_SMALL)
    m = batch.build_marts(bronze, bars=bars_by_type(spark, SF_SMALL), out_dir=tmp_dir)
    both = [c for c in quality.REFERENCE_CHECKS if c.table in ("daily_summary", "top_movers")]
    assert rows(m.written_checks()) == rows(quality.run_checks(m.tables(), both))
    assert "Scan parquet" not in m.written_checks()._jdf.queryExecution().executedPlan().toString()
    table = MonthTable(spark, os.path.join(tmp_dir, "spoiled"), m.daily_summary.schema, ["trade_date", "ticker"])
    bad = spoiled_tables({**m.tables()})["daily_summary"]
    watch = quality.Observation("w")
    table.replace(bad.withColumn("ym", F.lit(202401)), observe=(watch, quality.counters("daily_summary")))
    got = quality.observed_checks(spark, {"daily_summary": watch})
    assert rows(got) == rows(quality.run_checks({"daily_summary": bad}, [c for c in both if c.table == "daily_summary"]))
    assert sum(r["failures"] for r in got.collect()) > 0


def test_published_order_without_one_global_task(spark):
    daily = marts.daily_summary_from_bronze(bronze_by_user(spark, SF_SMALL))
    got = storage.published(daily, marts.daily_order())
    want = [(r["trade_date"], r["ticker"]) for r in marts.ordered_daily(daily).collect()]
    assert [(r["trade_date"], r["ticker"]) for r in got.orderBy("position").collect()] == want
    assert [r[0] for r in got.select("position").orderBy("position").collect()] == list(range(1, len(want) + 1))
    assert storage.published(daily.limit(0), marts.daily_order()).count() == 0


def test_text_without_an_offset_is_read_in_the_stated_zone(spark):
    df = spark.createDataFrame([("2026-04-21T10:00:00",), ("2026-04-21 10:00",), ("2026-04-21T10:00:00.5+03:00",), ("2026-04-21T10:00:00Z",)], "s string")
    before = spark.conf.get("spark.sql.session.timeZone")
    at = dt.datetime(2026, 4, 21, 10)
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r[0] for r in df.select(parse_to_utc(F.col("s"))).collect()]
            assert got == [at, at, dt.datetime(2026, 4, 21, 7, 0, 0, 500000), at]
            local = [r[0] for r in df.select(parse_to_utc(F.col("s"), "Africa/Nairobi")).collect()]
            assert local[:2] == [dt.datetime(2026, 4, 21, 7)] * 2 and local[2:] == got[2:]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_rewrite_is_ranged_by_its_input_size(spark, tmp_dir, monkeypatch):
    table = MonthTable(spark, os.path.join(tmp_dir, "t"), BRONZE, ["ticker", "inserted_at"])
    table.replace(storage.with_month(bronze_by_user(spark, "/root/testdata/sf0.01"), "inserted_at"), ranges=1)
    month = sorted(table.state()["months"])[-1]
    files = table.read([month]).inputFiles()
    size = sum(os.path.getsize(f.removeprefix("file://")) for f in files)
    assert len(files) == 1
    monkeypatch.setattr(manifest, "RANGE_BYTES", size // 4)
    table.expire("2024-01-02", "0 days", "inserted_at")
    after = [os.path.getsize(f.removeprefix("file://")) for f in table.read([202401]).inputFiles()]
    assert 3 <= len(after) <= 6 and max(after) < 2.5 * size / 4
