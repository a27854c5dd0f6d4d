"""Composed batch jobs: the staging views, the marts, checks and the report.

``build_marts`` is what the reference's scheduled model run does
(staging views -> daily table -> movers table), as DataFrame functions:

* staging stays lazy (views);
* the daily mart is computed once with the sort-free plan and stored; the
  movers mart and the checks read the stored table, so the tick scan and
  its shuffles run once however many readers follow;
* with an ``out_dir`` the marts are written month-partitioned and sorted by
  their keys (K6, K8, K9); otherwise they go to the shared work folder.

``run_day`` adds the checks (Q1-Q5) and the movers report (Z1) for ``as_of``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ticksmith.functions.timefn import NAIROBI, local_date, month_key, parse_to_utc
from ticksmith.operators import bars as bars_op
from ticksmith.operators import marts, quality, reports, staging
from ticksmith.plans import storage
from ticksmith.plans.manifest import MonthTable
from ticksmith.schemas import DAILY, MOVERS


@dataclass
class Marts:
    raw_ticks: DataFrame
    ohlcv_5min: DataFrame
    stg_ticks: DataFrame
    stg_bars: DataFrame
    daily_summary: DataFrame
    top_movers: DataFrame
    stg_ticks_latest: DataFrame | None = None
    observed: dict[str, Observation] = field(default_factory=dict)

    def written_checks(self) -> DataFrame:
        """The checks of the marts that this run wrote (with ``out_dir``), counted while they were written;
        after ``since`` over the rewritten months."""
        return quality.observed_checks(self.raw_ticks.sparkSession, self.observed)

    def check_tables(self) -> dict[str, DataFrame]:
        """``tables()`` for failure *counts*: ``stg_ticks`` is replaced by the
        sort-free ``latest_prices`` relation (the same rows, projected to
        ``ticker, price, fetched_at, trade_date`` — all its checks read), so
        counting the staging checks needs no sort of the ticks."""
        t = self.tables()
        if self.stg_ticks_latest is not None:
            t["stg_ticks"] = self.stg_ticks_latest
        return t

    def tables(self) -> dict[str, DataFrame]:
        return {
            "raw_ticks": self.raw_ticks,
            "ohlcv_5min": self.ohlcv_5min,
            "stg_ticks": self.stg_ticks,
            "stg_bars": self.stg_bars,
            "daily_summary": self.daily_summary,
            "top_movers": self.top_movers,
        }

    def register_views(self, prefix: str = "") -> list[str]:
        """Name every relation as a session temp view, so ad-hoc
        SQL (``spark.sql("SELECT ... FROM top_movers")``) reads the same lazy
        plans and stored marts.  Returns the view names."""
        names = []
        for name, df in self.tables().items():
            df.createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names


def bars_from_bronze(bronze: DataFrame) -> DataFrame:
    """Batch A1 over bronze (also the repair path for late ticks, R5)."""
    # rows without a time have no window
    return bars_op.ohlc_bars(bronze.withColumn("_event_time", parse_to_utc(F.col("fetched_at"))), "_event_time")


def month_start(day: date | datetime | str) -> date:
    return date.fromisoformat(str(day)[:10]).replace(day=1)


def recent_bronze(bronze: DataFrame, first_day: date) -> DataFrame:
    """Bronze rows that can carry a trade date on or after ``first_day``.

    A tick is inserted after it is fetched, and the venue day starts at most
    a day before the UTC day, so ``inserted_at >= first_day - 1 day`` keeps
    every such tick; on a month-partitioned bronze the ``ym`` bound prunes
    older month directories without reading them."""
    lo = F.lit(first_day - timedelta(days=1)).cast("timestamp_ntz")
    out = bronze.filter(F.col("inserted_at") >= lo)
    if storage.PART_COL in bronze.columns:
        out = out.filter(F.col(storage.PART_COL) >= month_key(lo))
    return out


LEDGER = "ledger"


def month_ledger(bronze: DataFrame, tz: str = NAIROBI) -> list[tuple[int, int]]:
    """(month of insertion, month of the trade date) pairs that some tick of ``bronze`` has.

    One row a pair leaves each task; two columns are read.
    """
    ins = F.col(storage.PART_COL) if storage.PART_COL in bronze.columns else month_key(F.col("inserted_at"))
    pairs = bronze.select(ins.alias("ins"), month_key(local_date(parse_to_utc(F.col("fetched_at")), tz)).alias("trade")).distinct()
    return sorted((r["ins"], r["trade"]) for r in pairs.where("ins IS NOT NULL AND trade IS NOT NULL").toLocalIterator())


def inserted_in(bronze: DataFrame, months: list[int]) -> DataFrame:
    """Bronze rows inserted in these months; month directories of a stored bronze are pruned."""
    own = month_key(F.col("inserted_at")).isin(months)
    return bronze.filter(own & F.col(storage.PART_COL).isin(months) if storage.PART_COL in bronze.columns else own)


def _plan_rebuild(bronze: DataFrame, first_day: date, table: MonthTable, tz: str) -> tuple[list[int], list[int], list[tuple[int, int]]]:
    """(trade months to rebuild, insertion months that hold their ticks, the ledger now)."""
    first = first_day.year * 100 + first_day.month
    state = table.state()
    known = [tuple(p) for p in state["notes"].get(LEDGER, [])]
    if LEDGER in state["notes"]:
        new = bronze.filter(F.col("inserted_at") >= F.lit(first_day).cast("timestamp_ntz"))
        if storage.PART_COL in bronze.columns:
            new = new.filter(F.col(storage.PART_COL) >= first)
        ledger = sorted({p for p in known if p[0] < first} | set(month_ledger(new, tz)))
    else:      # marts of an earlier layout: one pass over all ticks
        ledger = month_ledger(bronze, tz)
    # pairs of the months from first on that were there before and are gone also change their trade months
    months = sorted({t for i, t in {*ledger, *known} if i >= first or t >= first} | {m for m in state["months"] if m >= first})
    return months, sorted({i for i, t in ledger if t in set(months)}), ledger


def build_marts(bronze: DataFrame, bars: DataFrame | None = None, out_dir: str | None = None,
                updated_at: datetime | str | None = None, tz: str = NAIROBI,
                session_only: bool = False, since: date | str | None = None) -> Marts:
    """Staging views, then the daily table (stored once), then movers.

    ``since`` (needs ``out_dir`` with marts from an earlier run that saw
    every row inserted before ``since``'s month) rebuilds the trade months from
    ``since``'s month on and each older one that a row inserted since then
    belongs to (a late tick).  A ledger of (month of insertion, trade month)
    pairs, kept in the daily table's manifest, names the insertion months that hold
    ticks of these trade months, however late or far ahead they were stamped;
    bronze is read there only.  Each mart is written once as new month versions
    and swapped in by one commit (``plans.manifest``); months that have no result
    any more are gone; others are neither read nor rewritten.  The outcome
    equals a full rebuild, which the reference does each run.
    """
    spark = bronze.sparkSession
    bars = bars if bars is not None else bars_from_bronze(bronze)
    source, months, ledger = bronze, None, None
    if out_dir:
        days = MonthTable(spark, f"{out_dir.rstrip('/')}/daily_summary", DAILY, ["trade_date", "ticker"])
        moves = MonthTable(spark, f"{out_dir.rstrip('/')}/top_movers", MOVERS, ["trade_date", "direction", "rank"])
    if since is not None:
        if not out_dir:
            raise ValueError("since= rebuilds stored marts: pass out_dir")
        months, inserted, ledger = _plan_rebuild(bronze, month_start(since), days, tz)
        source = inserted_in(bronze, inserted)
    elif out_dir:
        ledger = month_ledger(bronze, tz)
    daily = marts.daily_summary_from_bronze(source, updated_at, tz, session_only)
    if months is not None:
        daily = daily.filter(month_key(F.col("trade_date")).isin(months))
    watch: dict[str, Observation] = {}

    def watched(table: str):
        watch[table] = Observation(f"checks_{table}")
        return watch[table], quality.counters(table)

    if out_dir:
        days.replace(storage.with_month(daily, "trade_date"), months, notes={LEDGER: ledger}, observe=watched("daily_summary"))
        daily, ranked_days = (days.read(which).select(*DAILY.fieldNames()) for which in (None, months))
    else:
        daily = ranked_days = storage.materialize(daily, "daily_summary")
    # single-pass ranking trims to the top k per (day, side) inside each task
    # before the shuffle, so a day with very many tickers is not one task's work
    movers = marts.top_movers_single_pass(ranked_days)
    if out_dir:
        moves.replace(storage.with_month(movers, "trade_date"), months, observe=watched("top_movers"))
        movers = moves.read().select(*MOVERS.fieldNames())
    return Marts(
        raw_ticks=bronze,
        ohlcv_5min=bars,
        stg_ticks=staging.stage_ticks(bronze, tz),
        stg_bars=staging.stage_bars(bars, tz),
        daily_summary=daily,
        top_movers=movers,
        stg_ticks_latest=staging.latest_prices(bronze, tz),
        observed=watch,
    )


@dataclass
class DayResult:
    checks: DataFrame
    report: DataFrame
    health: DataFrame


def run_day(m: Marts, as_of: date | str) -> DayResult:
    """Checks (non-blocking, Q5), today's movers report and ingest health.
    Nothing is collected here; callers ``show`` or write the results."""
    return DayResult(
        checks=quality.run_checks(m.check_tables()),
        report=reports.movers_report(m.top_movers, as_of),
        health=reports.health_today(m.raw_ticks, as_of),
    )
