"""Table schemas (fixed DDL) and ``conform`` — operator K7.

Every table has a fixed schema; nothing is inferred.  Column comments go into
``StructField`` metadata.  Timestamps are TIMESTAMP_NTZ holding UTC wall
clock (see ``functions.timefn``).

``seq`` is one column the reference tables do not have: the arrival order of
a tick (Kafka offset, or the source row id for file-fed data).  It is the
last tie-breaker wherever the reference orders by a time with ties, so every
open/close and every dedup is deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _f(name: str, dtype: T.DataType, comment: str | None = None,
       nullable: bool = True) -> T.StructField:
    meta = {"comment": comment} if comment else {}
    return T.StructField(name, dtype, nullable, meta)


# Tick message fields, in message order.
TICK = T.StructType([
    _f("ticker", T.StringType(), "Listed symbol, e.g. SCOM.NR"),
    _f("name", T.StringType(), "Short name, e.g. SCOM"),
    _f("price", T.DoubleType(), "Last traded price"),
    _f("volume", T.LongType(), "Average daily volume of three months, in place of the day's own"),
    _f("market_cap", T.DoubleType(), "Market capitalisation"),
    _f("currency", T.StringType()),
    _f("fetched_at", T.StringType(), "ISO-8601 fetch time with offset"),
    _f("exchange", T.StringType()),
])
TICK_COLS = [f.name for f in TICK.fields]

# Per-field defaults of a tick message (missing or null key).
TICK_DEFAULTS = {
    "ticker": "",
    "name": "",
    "price": 0.0,
    "volume": 0,
    "market_cap": 0.0,
    "currency": "KES",
    "fetched_at": "",
    "exchange": "NSE",
}

# Bronze raw ticks: message fields + arrival metadata.
BRONZE = T.StructType(TICK.fields + [
    _f("inserted_at", T.TimestampNTZType(), "When the sink received the row (UTC)"),
    _f("seq", T.LongType(), "Arrival order: source offset / row id"),
])
BRONZE_COLS = [f.name for f in BRONZE.fields]

# Silver 5-minute bars (the "V" of OHLCV is tick_count).
BAR = T.StructType([
    _f("ticker", T.StringType()),
    _f("window_start", T.TimestampNTZType(), "UTC, inclusive"),
    _f("window_end", T.TimestampNTZType(), "UTC, exclusive"),
    _f("open_price", T.DoubleType()),
    _f("high_price", T.DoubleType()),
    _f("low_price", T.DoubleType()),
    _f("close_price", T.DoubleType()),
    _f("tick_count", T.LongType(), "Ticks of the window"),
])
BAR_COLS = [f.name for f in BAR.fields]

# Stored bars: when the sink last changed the bar, and what decides open and close.
STORED_BAR = T.StructType(BAR.fields + [
    _f("inserted_at", T.TimestampNTZType(), "When the sink last changed the bar (UTC)"),
    _f("open_key", T.DecimalType(38, 0), "Order of the opening tick: time, partition, offset"),
    _f("close_key", T.DecimalType(38, 0), "Order of the closing tick"),
])

# Bronze of a partitioned log.
LOG_BRONZE = T.StructType(BRONZE.fields + [_f("partition", T.IntegerType(), "Log partition of the offset in seq")])

STAGED_TICK = T.StructType([
    _f("ticker", T.StringType()),
    _f("name", T.StringType()),
    _f("price", T.DoubleType()),
    _f("volume", T.LongType()),
    _f("market_cap", T.DoubleType()),
    _f("currency", T.StringType()),
    _f("exchange", T.StringType()),
    _f("fetched_at", T.TimestampNTZType(), "Parsed fetch time, UTC"),
    _f("trade_date", T.DateType(), "Trading day in the venue zone"),
    _f("inserted_at", T.TimestampNTZType()),
    _f("seq", T.LongType()),
])
STAGED_TICK_COLS = [f.name for f in STAGED_TICK.fields]

DAILY = T.StructType([
    _f("trade_date", T.DateType()),
    _f("ticker", T.StringType()),
    _f("open_price", T.DoubleType()),
    _f("high_price", T.DoubleType()),
    _f("low_price", T.DoubleType()),
    _f("close_price", T.DoubleType()),
    _f("price_change", T.DoubleType(), "close - open"),
    _f("pct_change", T.DoubleType(), "(close - open) / open * 100"),
    _f("total_ticks", T.LongType()),
    _f("updated_at", T.TimestampNTZType()),
])
DAILY_COLS = [f.name for f in DAILY.fields]

MOVERS = T.StructType([
    _f("trade_date", T.DateType()),
    _f("direction", T.StringType(), "gainer or loser"),
    _f("rank", T.IntegerType()),
    _f("ticker", T.StringType()),
    _f("close_price", T.DoubleType()),
    _f("pct_change", T.DoubleType()),
])
MOVERS_COLS = [f.name for f in MOVERS.fields]

# Landed quote snapshots (input of normalisation).
SNAPSHOT = T.StructType([
    _f("symbol", T.StringType()),
    _f("last_price", T.DoubleType()),
    _f("avg_volume_3m", T.DoubleType()),
    _f("market_cap", T.DoubleType()),
    _f("fetched_at", T.TimestampNTZType(), "UTC"),
])


def conform(df: DataFrame, schema: T.StructType,
            defaults: dict[str, object] | None = None,
            keep_extra: bool = False) -> DataFrame:
    """Project ``df`` onto ``schema``: add missing columns (their declared default, else NULL),
    cast to the declared types, order as declared, attach comments.

    Extra columns are dropped unless ``keep_extra``.
    """
    defaults = COLUMN_DEFAULTS if defaults is None else defaults
    present = set(df.columns)
    cols: list[Column] = []
    for field in schema.fields:
        if field.name in present:
            c = F.col(field.name)
        elif field.name in defaults:
            c = F.lit(defaults[field.name])
        else:
            c = F.lit(None)
        cols.append(c.cast(field.dataType).alias(field.name, metadata=field.metadata))
    if keep_extra:
        cols += [F.col(c) for c in df.columns if c not in schema.fieldNames()]
    return df.select(*cols)


#: Declared defaults of stored columns, by name.
COLUMN_DEFAULTS = {"currency": TICK_DEFAULTS["currency"], "exchange": TICK_DEFAULTS["exchange"]}


def _literal(value: object) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def create_table(spark, name: str, schema: T.StructType, path: str | None = None, part_col: str | None = None,
                 defaults: dict[str, object] | None = None) -> None:
    """K7: declare ``name`` in the session's catalog, with column comments and defaults, unless it is there.

    An INSERT that leaves out a column with a default stores the default.  ``path``
    makes the table external; ``part_col`` adds an INT partition column.
    """
    defaults = COLUMN_DEFAULTS if defaults is None else defaults
    cols = []
    for f in schema.fields:
        comment = f.metadata.get("comment")
        cols.append(f"`{f.name}` {f.dataType.simpleString()}"
                    + (f" DEFAULT {_literal(defaults[f.name])}" if f.name in defaults else "")
                    + (f" COMMENT {_literal(comment)}" if comment else ""))
    if part_col:
        cols.append(f"`{part_col}` int COMMENT {_literal('Month, year * 100 + month')}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(cols)}) USING parquet"
              + (f" PARTITIONED BY (`{part_col}`)" if part_col else "") + (f" LOCATION {_literal(path)}" if path else ""))
