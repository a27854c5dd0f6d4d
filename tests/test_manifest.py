"""Month versions: every interruption leaves reads exact; the ledger finds all ticks of a trade month."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ticksmith.operators import marts
from ticksmith.plans import batch, manifest, storage
from ticksmith.plans.manifest import CommitConflict, MonthTable
from ticksmith.schemas import BRONZE
from ticksmith.sources import events_as_bronze, read_events
from ticksmith.streaming import jobs

from .conftest import rows

AT = dt.datetime


def bronze(spark, ticks):
    """Bronze of (ticker, price, fetched, inserted)."""
    return spark.createDataFrame([(t, t, p, 0, 0.0, "KES", f"{at.isoformat()}+00:00", "NSE", ins, i)
                                  for i, (t, p, at, ins) in enumerate(ticks)], BRONZE)


def table_of(spark, tmp_dir, times):
    table = MonthTable(spark, os.path.join(tmp_dir, "bronze"), BRONZE, ["ticker", "inserted_at"])
    df = bronze(spark, [("T", 1.0, t, t) for t in times])
    table.replace(storage.with_month(df, "inserted_at"))
    return table, df


TIMES = [AT(2023, 12, 5), AT(2024, 1, 10), AT(2024, 1, 20), AT(2024, 3, 1)]


class Broken(Exception):
    pass


@pytest.mark.parametrize("step", ["write", "commit", "half a commit"])
def test_a_rewrite_that_breaks_off_changes_nothing(spark, tmp_dir, monkeypatch, step):
    table, df = table_of(spark, tmp_dir, TIMES)
    before = rows(table.read(), "seq", "price", "ym")
    more = storage.with_month(df.withColumn("price", F.lit(2.0)), "inserted_at")

    def broken(*a, **k):
        raise Broken

    with monkeypatch.context() as m, pytest.raises(Broken):
        if step == "write":
            m.setattr(MonthTable, "write", broken)
        else:
            m.setattr(MonthTable, "commit", broken)
        table.replace(more)
    if step == "half a commit":
        with open(os.path.join(table.path, "_manifest", "2"), "w") as fh:
            fh.write('{"months": {"2024')
    assert rows(table.read(), "seq", "price", "ym") == before
    table.replace(more)      # the repeated run is a new version
    assert rows(table.read(), "seq", "price") == [(i, 2.0) for i in range(4)]


def test_of_two_writers_from_one_state_the_second_fails(spark, tmp_dir):
    table, df = table_of(spark, tmp_dir, TIMES)
    state = table.state()
    version, months = table.write(storage.with_month(df, "inserted_at"))
    table.commit(state, {m: {"version": version, "taken": None} for m in months})
    with pytest.raises(CommitConflict):
        table.commit(state, {202403: None})
    assert table.read().count() == 4


def test_retention_is_one_commit_and_stays_sorted(spark, tmp_dir):
    table, _ = table_of(spark, tmp_dir, TIMES + [AT(2024, 1, 30), AT(2024, 1, 16)])
    storage.enforce_retention(spark, table.path, BRONZE, "2026-01-15", sort_cols=table.sort_cols)
    assert rows(table.read(), "seq") == [(2,), (3,), (4,), (5,)]
    assert sorted(table.state()["months"]) == [202401, 202403]
    for f in table.read([202401]).inputFiles():
        got = [r["inserted_at"] for r in spark.read.parquet(f).select("inserted_at").collect()]
        assert got == sorted(got)
    assert table.vacuum() == 0       # the last two manifests still name everything
    storage.enforce_retention(spark, table.path, BRONZE, "2026-02-15", sort_cols=table.sort_cols)
    assert table.vacuum() == 2 and rows(table.read(), "seq") == [(3,)]
    assert table.read([202401]).count() == 0


def test_columns_that_are_missing_or_extra_conform(spark, tmp_dir):
    table = MonthTable(spark, os.path.join(tmp_dir, "t"), BRONZE)
    table.replace(spark.createDataFrame([("A", 1, "x", 202401)], "ticker string, price int, extra string, ym int"))
    assert table.read().columns == [*BRONZE.fieldNames(), "ym"]
    assert table.read().select("ticker", "price", "volume").first() == ("A", 1.0, None)
    table.replace(table.read().limit(0))
    assert table.read().count() == 0 and table.state()["months"] == {}


@pytest.mark.parametrize("step", ["replace", "commit"])
def test_a_compaction_that_breaks_off_changes_nothing(spark, tmp_dir, monkeypatch, step):
    src, out, ckpt, path = (os.path.join(tmp_dir, n) for n in ("src", "stream", "ckpt", "bronze"))

    def more(times, first):
        df = bronze(spark, [("T", 1.0, t, t) for t in times]).withColumn("seq", F.col("seq") + first)
        storage.with_month(df, "inserted_at").write.mode("append").parquet(src)
        jobs.run_available_now(spark.readStream.schema(storage.table_schema(BRONZE)).parquet(src), out, ckpt, partition_col="ym")

    def seen():
        return [r[0] for r in rows(storage.read_compacted(spark, out, path, BRONZE), "seq")]

    def broken(*a, **k):
        raise Broken

    more([AT(2023, 12, 3), AT(2024, 1, 10), AT(2024, 2, 1)], 0)
    for month, late in ((202312, AT(2023, 12, 9)), (202401, AT(2024, 1, 9))):
        with monkeypatch.context() as m, pytest.raises(Broken):
            m.setattr(MonthTable, step, broken)
            storage.compact_months(spark, out, path, BRONZE, month, month, ["ticker"])
        assert len(seen()) == len(set(seen()))
        n = len(seen())
        storage.compact_months(spark, out, path, BRONZE, month, month, ["ticker"])
        assert len(seen()) == n
        more([late], 100 * month)
        assert len(seen()) == n + 1 == len(set(seen()))


def both(spark, tmp_dir, first, changed, since):
    stamp = "2026-06-01 00:00:00"
    batch.build_marts(bronze(spark, first), out_dir=tmp_dir, updated_at=stamp)
    m = batch.build_marts(bronze(spark, changed), out_dir=tmp_dir, updated_at=stamp, since=since)
    want = marts.daily_summary_from_bronze(bronze(spark, changed), stamp)
    assert rows(m.daily_summary) == rows(want)
    assert rows(m.top_movers) == rows(marts.top_movers(want))
    return m


APRIL = [("A", 10.0, AT(2026, 4, 21, 8), AT(2026, 4, 21, 8)), ("A", 13.0, AT(2026, 4, 21, 9), AT(2026, 4, 21, 9))]
MAY = [("B", 10.0, AT(2026, 5, 10, 8), AT(2026, 5, 10, 8)), ("B", 11.0, AT(2026, 5, 10, 9), AT(2026, 5, 10, 9))]
AHEAD = [("B", 99.0, AT(2026, 5, 10, 12), AT(2026, 4, 20, 8))]      # inserted in April, stamped 10 May
LATE = [("A", 98.0, AT(2026, 4, 21, 10), AT(2026, 5, 6, 8))]
FAR = [("C", 5.0, AT(2025, 2, 3, 8), AT(2026, 5, 11, 8)), ("C", 6.0, AT(2027, 2, 3, 8), AT(2026, 4, 2, 8))]


@pytest.mark.parametrize("old,new", [(AHEAD, []), ([], LATE), (AHEAD, LATE), (FAR[1:], FAR[:1])])
def test_since_equals_a_full_rebuild(spark, tmp_dir, old, new):
    m = both(spark, tmp_dir, APRIL + old + MAY[:1], APRIL + old + MAY + new, "2026-05-01")
    if AHEAD == old:
        assert (99.0, 3 if len(MAY) == 2 else 0) in rows(m.daily_summary, "close_price", "total_ticks")


def test_since_takes_back_what_was_deleted(spark, tmp_dir):
    both(spark, tmp_dir, APRIL + MAY + LATE + FAR, APRIL + FAR[1:], "2026-05-01")


def test_since_reads_only_the_months_that_hold_the_ticks(spark, tmp_dir):
    stored = MonthTable(spark, os.path.join(tmp_dir, "bronze"), BRONZE, ["ticker"])
    old = [("O", 1.0, AT(2026, m, 3, 8), AT(2026, m, 3, 8)) for m in (1, 2, 3)]
    stored.replace(storage.with_month(bronze(spark, old + APRIL + AHEAD + MAY), "inserted_at"))
    batch.build_marts(stored.read(), out_dir=tmp_dir, updated_at="2026-06-01")
    table = MonthTable(spark, os.path.join(tmp_dir, "daily_summary"), manifest.T.StructType([]))
    assert [tuple(p) for p in table.state()["notes"]["ledger"]] == [
        (202601, 202601), (202602, 202602), (202603, 202603), (202604, 202604), (202604, 202605), (202605, 202605)]
    months, inserted, _ = batch._plan_rebuild(stored.read(), dt.date(2026, 5, 1), table, "Africa/Nairobi")
    assert months == [202605] and inserted == [202604, 202605]


@pytest.mark.parametrize("sf,size", [("0.01", 48 << 10), ("0.1", 192 << 10)])
@pytest.mark.parametrize("sort_cols", [["ticker"], ["ticker", "inserted_at"]])
def test_a_rewrite_makes_files_of_the_stated_size(spark, tmp_dir, monkeypatch, sf, size, sort_cols):
    monkeypatch.setattr(manifest, "RANGE_BYTES", size)
    hot = F.when(F.col("seq") % 3 == 0, F.lit("HOT")).otherwise(F.col("ticker"))
    df = events_as_bronze(read_events(spark, f"/root/testdata/sf{sf}"), "event_type").withColumn("ticker", hot)
    table = MonthTable(spark, os.path.join(tmp_dir, "bronze"), BRONZE, sort_cols)
    table.replace(storage.with_month(df, "inserted_at"), ranges=1)
    month = max(table.state()["months"], key=lambda m: table.read([m]).count())
    before = rows(table.read([month]))
    table.replace(table.read([month]), [month], ranges=table._ranges([month], table.state()))
    assert rows(table.read([month])) == before
    sizes = [os.path.getsize(f.partition(":")[2].replace("///", "/")) for f in table.read([month]).inputFiles()]
    assert len(sizes) >= 4 and size / 3 <= min(sizes) and max(sizes) <= 2 * size
    # files are narrow ranges of the first sort key, sorted inside
    bounds = []
    for f in table.read([month]).inputFiles():
        got = [tuple(r) for r in spark.read.parquet(f).select(*sort_cols).collect()]
        assert got == sorted(got)
        bounds.append((got[0], got[-1]))
    bounds.sort()
    assert all(a[1] <= b[0] for a, b in zip(bounds, bounds[1:], strict=False))


def test_a_compaction_is_ranged_by_rows(spark, tmp_dir, monkeypatch):
    """Stored bytes say little of the memory a sort takes: all these rows are one file of a few pages."""
    monkeypatch.setattr(manifest, "RANGE_ROWS", 500, raising=False)
    src, out, ckpt, table = (os.path.join(tmp_dir, n) for n in ("src", "out", "ckpt", "table"))
    bronze(spark, [(f"T{i % 7}", 1.0, AT(2024, 1, 10), AT(2024, 1, 10)) for i in range(4000)]).coalesce(1).write.parquet(src)
    ticks = spark.readStream.schema(BRONZE).parquet(src)
    jobs.run_available_now(storage.with_month(ticks, "inserted_at"), out, ckpt, partition_col="ym")
    storage.compact_months(spark, out, table, BRONZE, 202401, 202401, ["ticker", "inserted_at"])
    files = MonthTable(spark, table, BRONZE).read().inputFiles()
    counts = [spark.read.parquet(f).count() for f in files]
    assert sum(counts) == 4000 and 6 <= len(counts) <= 8 and max(counts) <= 1000
    assert rows(storage.read_compacted(spark, out, table, BRONZE), "seq") == [(i,) for i in range(4000)]


def test_the_boundary_month_of_a_retention_is_ranged_by_rows(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(manifest, "RANGE_ROWS", 500, raising=False)
    df = bronze(spark, [(f"T{i % 7}", 1.0, AT(2024, 1, 1 + i % 20), AT(2024, 1, 1 + i % 20)) for i in range(4000)])
    table = MonthTable(spark, os.path.join(tmp_dir, "bronze"), BRONZE, ["ticker", "inserted_at"])
    table.replace(storage.with_month(df, "inserted_at"), ranges=1)
    storage.enforce_retention(spark, table.path, BRONZE, "2026-01-03", sort_cols=table.sort_cols)
    counts = [spark.read.parquet(f).count() for f in table.read().inputFiles()]
    assert rows(table.read(), "seq") == [(i,) for i in range(4000) if i % 20 > 2]
    assert len(counts) >= 6 and max(counts) <= 1000
