"""Reports — operators Z1-Z4, A3, A4, F9, F10, O3, O4, P10, P11, L1, Q4.

``as_of`` (the reference's ``today()``) is injected: a ``date``/ISO string,
or a Column — typically a scalar subquery such as the latest day in the
data (``df.select(max(...)).scalar()``), which Spark evaluates once on the
cluster; nothing but the final report rows reaches the driver.

Day filters are half-open ranges on the raw timestamp (``>= day`` and
``< day + 1``) rather than ``to_date(ts) = day``, so they stay pushable
to Parquet row-group statistics.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticksmith.functions.text import mover_line, thousands
from ticksmith.functions.timefn import month_key

# Movers shown in the text report, and rows in a peek.
REPORT_TOP_N = 3
PEEK_ROWS = 10


def as_date(as_of: date | str | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def latest_day(df: DataFrame, ts_col: str, part_col: str = "ym") -> Column:
    """Scalar subquery: the latest calendar day present in ``ts_col``.

    On a table partitioned by the month of ``ts_col`` only the last month is
    read for it; which one that is comes from the partition values.
    """
    if part_col in df.columns:
        df = df.filter(F.col(part_col) == df.select(F.max(part_col)).scalar())
    return df.select(F.max(F.to_date(F.col(ts_col)))).scalar()


def day_range(ts: Column, first_day: Column, last_day: Column) -> Column:
    """``first_day <= to_date(ts) <= last_day`` as a half-open range."""
    return (ts >= first_day.cast("timestamp_ntz")) & (ts < F.date_add(last_day, 1).cast("timestamp_ntz"))


def _days(df: DataFrame, ts_col: str, first_day: Column, last_day: Column, part_col: str = "ym") -> DataFrame:
    """Rows of a day range; on a month-partitioned table other months' directories are skipped."""
    out = df.filter(day_range(F.col(ts_col), first_day, last_day))
    if part_col in df.columns:
        out = out.filter(F.col(part_col).between(month_key(first_day), month_key(last_day)))
    return out


def health_today(bronze: DataFrame, as_of: date | str | Column | None = None) -> DataFrame:
    """Z2 + A3: ticks and distinct tickers inserted on ``as_of``, with the
    printable status line (thousands separators, like ``{:,}``)."""
    d = as_date(as_of)
    counts = (_days(bronze, "inserted_at", d, d)
              .agg(F.count(F.lit(1)).alias("tick_count"),
                   F.countDistinct("ticker").alias("ticker_count")))
    # Fixed value: the status line that readers of the report match.
    line = F.format_string("Today's ticks so far: %s rows across %d tickers",
                           thousands(F.col("tick_count")), F.col("ticker_count"))
    return counts.withColumn("line", line)


def assert_ticks_today(health: DataFrame) -> int:
    """Q4: raise when no tick arrived today; returns the count.  Collects the
    single aggregate row only."""
    row = health.select("tick_count").first()
    n = int(row[0]) if row and row[0] is not None else 0
    if n == 0:
        raise ValueError("the ingest day is empty: bronze holds no row inserted on it")
    return n


def health_by_day(bronze: DataFrame, as_of: date | str | Column | None = None,
                  days: int = 2) -> DataFrame:
    """Z3 + A4 + O4: per insert day over the last ``days`` days up to
    ``as_of``: ticks, distinct tickers, min and max price; newest first."""
    d = as_date(as_of)
    day = F.to_date(F.col("inserted_at"))
    return (_days(bronze, "inserted_at", F.date_sub(d, days - 1), d)
            .groupBy(day.alias("day"))
            .agg(F.count(F.lit(1)).alias("total_ticks"),
                 F.countDistinct("ticker").alias("unique_tickers"),
                 F.min("price").alias("min_price"),
                 F.max("price").alias("max_price"))
            .orderBy(F.col("day").desc()))


def movers_report(movers: DataFrame, as_of: date | str | Column | None = None,
                  k: int = REPORT_TOP_N) -> DataFrame:
    """Z1 + F10 + O3 + P10: the day's top ``k`` movers per side with the
    printable line, ordered by direction then rank."""
    d = as_date(as_of)
    return (movers.filter((F.col("trade_date") == d) & (F.col("rank") <= k))
            .select("trade_date", "direction", "rank", "ticker", "pct_change",
                    mover_line(F.col("direction"), F.col("ticker"), F.col("pct_change")).alias("line"))
            .orderBy("direction", "rank"))


def peek(bronze: DataFrame, n: int = PEEK_ROWS, ordered: bool = False) -> DataFrame:
    """Z4 + P11 + L1: ``ticker, price, fetched_at`` of any ``n`` rows, read from
    as few files as hold them; ``ordered`` takes the first by the table's sort
    key instead, which reads the whole table."""
    rows = bronze.orderBy("ticker", "inserted_at", "seq") if ordered else bronze
    return rows.select("ticker", "price", "fetched_at").limit(n)


def show(df: DataFrame, n: int = 20) -> None:
    """Console table (``PrettyCompact``)."""
    df.show(n, truncate=False)
