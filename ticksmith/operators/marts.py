"""Marts — daily summary and top movers.

Operators A2, F6, P7, O1 (daily) and F7, W1, W2, W3, F8, P8, U1, O2, O5
(movers).

Ordering: the marts are tables, so their ``ORDER BY`` is a layout concern
(``plans.storage.write_table`` sorts within partitions); readers that need
the published order call ``ordered_daily`` / ``ordered_movers``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticksmith.functions.numeric import (is_nonzero, is_positive, no_negative_zero,
                                         round_half_even)
from ticksmith.functions.text import GAINER, LOSER
from ticksmith.functions.timefn import NAIROBI
from ticksmith.operators.ingest import sink_time
from ticksmith.operators.staging import latest_prices
from ticksmith.schemas import DAILY_COLS

# Movers per side and the minimum polls for a reliable signal.
TOP_N = 5
MIN_TICKS = 3


def _stamp(as_of: datetime | str | None) -> Column:
    if as_of is None:
        return sink_time()
    return F.lit(str(as_of)).cast("timestamp_ntz")


def daily_summary(staged: DataFrame, updated_at: datetime | str | None = None) -> DataFrame:
    """A2 + F6 + P7: one row per (trade_date, ticker).

    ``staged`` is the output of ``stage_ticks``: after the per-minute dedup
    each ticker-day has distinct ``fetched_at`` values, so open/close by
    ``fetched_at`` is deterministic and ``min_by``/``max_by`` over a
    TIMESTAMP stay on the hash-aggregate path (partial aggregation before
    the shuffle, so a hot ticker-day ships one row per map task).
    """
    p, t = F.col("price"), F.col("fetched_at")
    agg = (staged.groupBy("trade_date", "ticker")
           .agg(F.min_by(p, t).alias("open_price"),
                F.max(p).alias("high_price"),
                F.min(p).alias("low_price"),
                F.max_by(p, t).alias("close_price"),
                F.count(F.lit(1)).alias("total_ticks")))
    o, c = F.col("open_price"), F.col("close_price")
    change = c - o
    pct = F.try_divide(change, o) * F.lit(100.0)
    return (agg.filter(is_positive(o))
            .withColumn("price_change", no_negative_zero(round_half_even(change)))
            .withColumn("pct_change", no_negative_zero(round_half_even(pct)))
            .withColumn("updated_at", _stamp(updated_at))
            .select(*DAILY_COLS))


def daily_summary_from_bronze(bronze: DataFrame, updated_at: datetime | str | None = None,
                              tz: str = NAIROBI, session_only: bool = False) -> DataFrame:
    """A2 over D1 without a sort: ``daily_summary(stage_ticks(bronze))``
    computed as two hash aggregations (``latest_prices`` then the daily
    one).  The plan to use when the mart is rebuilt from all of bronze.

    ``session_only`` keeps only ticks fetched inside the trading session
    (F5), so "close" is really the last price before 15:30; off by default,
    as the reference relies on the producer's gate instead.
    """
    return daily_summary(latest_prices(bronze, tz, session_only=session_only), updated_at)


def eligible_movers(daily: DataFrame, min_ticks: int = MIN_TICKS) -> DataFrame:
    """moved (rounded pct != 0) and at least ``min_ticks`` polls."""
    return daily.filter(is_nonzero(F.col("pct_change")) & (F.col("total_ticks") >= min_ticks))


def top_movers(daily: DataFrame, k: int = TOP_N, min_ticks: int = MIN_TICKS) -> DataFrame:
    """W1 + W2 + F8 + P8 + U1: gainer and loser ranks per day, two branches
    joined by UNION ALL.

    Each branch keeps only its own side before ranking: gainers
    (``pct_change > 0``) sort ahead of every other row in the gainer order,
    losers ahead of every other row in the loser order, so their ranks equal
    the reference's ranks over all eligible rows.  With the rank filter
    right above its window, each branch runs as partial + final
    ``WindowGroupLimit``: at most ``k`` rows per day leave a task, however
    many tickers a day has.  The branches share everything below the
    ranking; Spark reuses that exchange (``ReusedExchange``), so the daily
    computation under it runs once.  ``ticker`` is the tie-break the
    reference lacks.
    """
    pct = F.col("pct_change")
    eligible = eligible_movers(daily, min_ticks).select("trade_date", "ticker", "close_price", "pct_change")

    def branch(direction: str, side: Column, order: Column) -> DataFrame:
        w = Window.partitionBy("trade_date").orderBy(order, F.col("ticker"))
        return (eligible.filter(side)
                .withColumn("rank", F.row_number().over(w))
                .filter(F.col("rank") <= k)
                .select("trade_date", F.lit(direction).alias("direction"),
                        F.col("rank").cast("int").alias("rank"), "ticker", "close_price", "pct_change"))

    return branch(GAINER, pct > 0, pct.desc()).unionByName(branch(LOSER, pct < 0, pct.asc()))


def top_movers_single_pass(daily: DataFrame, k: int = TOP_N, min_ticks: int = MIN_TICKS) -> DataFrame:
    """One window partitioned by (trade_date, direction), ordered by
    ``|pct_change|`` descending then ticker — one scan, one shuffle, no
    union.  Equal to ``top_movers`` row for row."""
    pct = F.col("pct_change")
    direction = F.when(pct > 0, F.lit(GAINER)).otherwise(F.lit(LOSER))
    w = Window.partitionBy("trade_date", "direction").orderBy(F.abs(pct).desc(), F.col("ticker"))
    return (eligible_movers(daily, min_ticks)
            .select("trade_date", direction.alias("direction"), "ticker", "close_price", "pct_change")
            .withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") <= k)
            .select("trade_date", "direction", F.col("rank").cast("int").alias("rank"),
                    "ticker", "close_price", "pct_change"))


def daily_order() -> list[Column]:
    """O1: ``trade_date DESC, pct_change DESC`` (ticker breaks ties)."""
    return [F.col("trade_date").desc(), F.col("pct_change").desc(), F.col("ticker").asc()]


def movers_order() -> list[Column]:
    """O2: ``trade_date DESC, direction, rank``."""
    return [F.col("trade_date").desc(), F.col("direction").asc(), F.col("rank").asc()]


def ordered_daily(daily: DataFrame) -> DataFrame:
    """The daily table in its published order."""
    return daily.orderBy(*daily_order())


def ordered_movers(movers: DataFrame) -> DataFrame:
    """The movers table in its published order."""
    return movers.orderBy(*movers_order())
