"""5-minute OHLC bars per ticker — operators A1, P4 (R1, R6, R7 in streams).

One ``groupBy(window, ticker)`` with mergeable aggregates replaces the
reference's buffered window list: Spark computes partial aggregates before
the shuffle (map-side combine) and keeps O(1) state per (ticker, window) in a
stream.  Open and close are ``min_by`` / ``max_by`` over a packed
(time, seq) key, never ``first`` / ``last``, so the result does not depend on
arrival order or partitioning; the packed key keeps the aggregation on the
HashAggregate path (see ``functions.timefn.epoch_order_key``).

Empty windows produce no bar.  A tick exactly on a 5-minute mark belongs to
the bar that starts there ([start, end)).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticksmith.functions.timefn import epoch_order_key, instant_to_utc, ntz_micros
from ticksmith.operators.ingest import bind

# Fixed value: bar width.
BAR_WIDTH = "5 minutes"


def ohlc_bars(ticks: DataFrame, time_col: str, key: str = "ticker",
              price: str = "price", seq: str | None = "seq",
              width: str = BAR_WIDTH, count_col: str | None = None,
              extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Tumbling OHLC bars: ``ticker, window_start, window_end, open_price,
    high_price, low_price, close_price, tick_count``.

    ``time_col`` may be TIMESTAMP_NTZ (UTC wall clock, batch) or TIMESTAMP
    (streams, where the watermark needs it); bounds come out as NTZ UTC.
    ``tick_count`` counts rows, or the non-NULL values of ``count_col``;
    ``extra_keys`` are further grouping columns, not part of the output.
    Ticks go by (time, ``seq``), or (time, partition, ``seq``) where there is a
    ``partition`` column.
    """
    if not ticks.isStreaming:     # a stream's window needs the column that its watermark marks
        ticks, time_col = bind(ticks, "_bar_time", F.col(time_col)), "_bar_time"
    tcol = F.col(time_col)
    is_instant = isinstance(ticks.schema[time_col].dataType, T.TimestampType)
    micros = F.unix_micros(tcol) if is_instant else ntz_micros(tcol)
    tie = F.coalesce(F.col(seq), F.lit(-1)) if seq else F.lit(0)
    order = epoch_order_key(micros, tie, F.col("partition") if "partition" in ticks.columns else None)
    p = F.col(price)
    bars = (ticks
            .groupBy(F.window(tcol, width).alias("w"), F.col(key).alias("ticker"),
                     *[F.col(c) for c in extra_keys])
            .agg(F.min_by(p, order).alias("open_price"),
                 F.max(p).alias("high_price"),
                 F.min(p).alias("low_price"),
                 F.max_by(p, order).alias("close_price"),
                 F.count(F.col(count_col) if count_col else F.lit(1)).alias("tick_count")))
    start, end = F.col("w.start"), F.col("w.end")
    if is_instant:
        start, end = instant_to_utc(start), instant_to_utc(end)
    return bars.select("ticker", start.alias("window_start"), end.alias("window_end"),
                       "open_price", "high_price", "low_price", "close_price", "tick_count")


#: Columns that open and close are decided by, so that bars of parts of the ticks can be merged.
ORDER_KEYS = ("open_key", "close_key")


def bar_parts(ticks: DataFrame, time_col: str, width: str = BAR_WIDTH) -> DataFrame:
    """Bars of some of the ticks, with the order keys of open and close: parts that ``merge_parts`` joins."""
    ticks = bind(ticks, "_bar_time", F.col(time_col))
    order = epoch_order_key(ntz_micros(F.col("_bar_time")), F.coalesce(F.col("seq"), F.lit(-1)),
                            F.col("partition") if "partition" in ticks.columns else F.lit(0))
    keyed = ticks.select(F.window(F.col("_bar_time"), width).alias("w"), "ticker", "price", order.alias("_key"))
    bars = keyed.groupBy("w", "ticker").agg(
        F.min_by("price", "_key").alias("open_price"), F.max("price").alias("high_price"), F.min("price").alias("low_price"),
        F.max_by("price", "_key").alias("close_price"), F.count(F.lit(1)).alias("tick_count"),
        F.min("_key").alias("open_key"), F.max("_key").alias("close_key"))
    return bars.select("ticker", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "open_price",
                       "high_price", "low_price", "close_price", "tick_count", *ORDER_KEYS)


def merge_parts(parts: DataFrame) -> DataFrame:
    """One bar a (ticker, window) from parts of it: the same as a bar of all their ticks."""
    return parts.groupBy("ticker", "window_start", "window_end").agg(
        F.min_by("open_price", "open_key").alias("open_price"), F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"), F.max_by("close_price", "close_key").alias("close_price"),
        F.sum("tick_count").alias("tick_count"), F.min("open_key").alias("open_key"), F.max("close_key").alias("close_key"),
        F.max("inserted_at").alias("inserted_at"))
