"""Staging layer — operators S2, S3, P5, P6, F3, F4, D1, F11.

``stage_ticks``: valid ticks (price > 0 with NaN failing, ticker != ''),
``fetched_at`` parsed to a UTC instant, ``trade_date`` in the venue zone,
then keep-latest per (ticker, minute of ``fetched_at``).  The reference
orders the dedup by ``inserted_at`` only (1 s precision, so ties are
arbitrary); here ties go to the later arrival, ``inserted_at DESC, seq
DESC``, which is total because ``seq`` is unique.

The dedup is ``row_number() = 1`` over a window (QUALIFY).  Catalyst turns
it into a partial ``WindowGroupLimit`` before the shuffle and a final one
after, so a hot (ticker, minute) ships at most one row per map task.

Rows whose ``fetched_at`` does not parse are not silently dropped: they are
returned by ``stage_rejects`` (the reference's parser would fail the run).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticksmith.functions.numeric import is_positive
from ticksmith.functions.timefn import (NAIROBI, epoch_order_key, floor_time, in_session,
                                        local_date, ntz_micros, parse_to_utc)
from ticksmith.operators.ingest import bind
from ticksmith.schemas import STAGED_TICK_COLS

# Fixed value: dedup grain (the reference's comment says second, its code minute).
DEDUP_GRAIN = "1 minute"


def valid_tick(price: Column, ticker: Column) -> Column:
    """``price > 0 AND ticker != ''`` (NaN fails)."""
    return is_positive(price) & (ticker != "")


def valid_bar() -> Column:
    """``tick_count > 0 AND open_price > 0 AND close_price > 0``."""
    return ((F.col("tick_count") > 0) & is_positive(F.col("open_price"))
            & is_positive(F.col("close_price")))


def keep_latest(df: DataFrame, partition_by: list[Column], order_by: list[Column]) -> DataFrame:
    """Keep the first row per partition under ``order_by``."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def _parsed(bronze: DataFrame, tz: str) -> DataFrame:
    # F3 stays a plain filter on stored columns (pushed into the Parquet
    # scan); the parsed instant is bound once per row, so the later
    # "parsed?" filter, the trade date and the dedup key all read an
    # attribute instead of re-parsing the text.
    seq = F.col("seq") if "seq" in bronze.columns else F.lit(None).cast("bigint")
    place = ["partition"] if "partition" in bronze.columns else []
    valid = bronze.filter(valid_tick(F.col("price"), F.col("ticker")))
    timed = bind(valid, "_fetched_utc", parse_to_utc(F.col("fetched_at")))
    return timed.select("ticker", "name", "price", "volume", "market_cap", "currency", "exchange",
                        F.col("fetched_at").alias("fetched_at_raw"),
                        F.col("_fetched_utc").alias("fetched_at"),
                        local_date(F.col("_fetched_utc"), tz).alias("trade_date"),
                        "inserted_at", seq.alias("seq"), *place)


def stage_ticks(bronze: DataFrame, tz: str = NAIROBI, grain: str = DEDUP_GRAIN) -> DataFrame:
    """P5 + F3 + D1: bronze raw ticks -> clean, typed, deduplicated ticks.

    The latest row goes by (inserted_at, seq), or (inserted_at, partition, seq) where
    there is a ``partition`` column; a null partition counts as 0.
    """
    ok = _parsed(bronze, tz).filter(F.col("fetched_at").isNotNull())
    place = [F.coalesce("partition", F.lit(0)).desc()] if "partition" in ok.columns else []
    order = [F.col("inserted_at").desc(), *place, F.col("seq").desc()]
    return keep_latest(ok, [F.col("ticker"), floor_time(F.col("fetched_at"), grain)], order) \
        .select(*STAGED_TICK_COLS)


def latest_order_key(inserted_at: Column, seq: Column, partition: Column | None = None) -> Column:
    """The D1 order (``inserted_at DESC[, partition DESC], seq DESC``, NULL times and offsets
    lowest) packed into one DECIMAL so ``max_by`` keeps the hash-aggregate path."""
    # with a partition the key has fewer digits for the time: any instant before the year 1 is lowest
    us = F.coalesce(ntz_micros(inserted_at), F.lit(-(2 ** 62) if partition is None else -(2 ** 59)))
    return epoch_order_key(us, F.coalesce(seq, F.lit(-1)), partition)


def latest_prices(bronze: DataFrame, tz: str = NAIROBI, grain: str = DEDUP_GRAIN,
                  session_only: bool = False) -> DataFrame:
    """D1 for the marts, sort-free: per (ticker, minute) the price and
    ``fetched_at`` of the latest row, as a hash aggregation.

    ``stage_ticks`` keeps whole rows and so needs a window (a sort of every
    tick); the daily mart only needs price and time, and ``max_by`` over a
    packed order key is a mergeable aggregate — partial aggregation before
    the shuffle, no sort, and a hot (ticker, minute) ships one row per map
    task.  Same rows as ``stage_ticks`` projected to these columns.
    """
    ok = _parsed(bronze, tz).filter(F.col("fetched_at").isNotNull())
    if session_only:
        ok = ok.filter(in_session(F.col("fetched_at"), tz))
    key = latest_order_key(F.col("inserted_at"), F.col("seq"), F.col("partition") if "partition" in ok.columns else None)
    latest = (ok.groupBy("ticker", floor_time(F.col("fetched_at"), grain).alias("minute"))
              .agg(F.max_by("price", key).alias("price"),
                   F.max_by("fetched_at", key).alias("fetched_at")))
    return latest.select("ticker", "price", "fetched_at",
                         local_date(F.col("fetched_at"), tz).alias("trade_date"))


def stage_rejects(bronze: DataFrame, tz: str = NAIROBI) -> DataFrame:
    """Valid-looking ticks whose ``fetched_at`` text does not parse."""
    return (_parsed(bronze, tz).filter(F.col("fetched_at").isNull())
            .select("seq", "ticker", "price", "fetched_at_raw", "inserted_at"))


def stage_bars(bars: DataFrame, tz: str = NAIROBI) -> DataFrame:
    """P6 + F4: bars that carry at least one tick and positive open/close,
    plus ``trade_date`` in the venue zone.  ``low_price`` is not checked
    (as in the reference)."""
    cols = ["ticker", "window_start", "window_end", "open_price", "high_price",
            "low_price", "close_price", "tick_count"]
    extra = [F.col("inserted_at")] if "inserted_at" in bars.columns else []
    return (bars.filter(valid_bar())
            .select(*cols, local_date(F.col("window_start"), tz).alias("trade_date"), *extra))
