"""Driver test data as ticks (the ``events`` table seen as a tick feed).

``events(event_id, ts, user_id, event_type, value, props)`` maps to ticks as:

* ``ticker`` — ``'T' || zero-padded user_id`` (many tickers, for daily marts
  and movers) or ``event_type`` (five hot tickers, for bars and dedup);
* ``price`` = ``value``; ``seq`` = ``event_id``;
* ``ts`` is the venue's local wall clock (Africa/Nairobi), the way the
  producer stamps ``fetched_at``; the UTC instant is ``ts - 3 hours``;
* ``volume`` = ``props.k``, ``market_cap`` = ``value * 1e6``.

``events`` is clean, so the bad-input paths (zero / NULL price, junk JSON,
bad numbers, missing fields, bad timestamps) are produced by fixed rules on
``event_id`` below, applied the same way in the DuckDB oracles.  They spoil
values; they never drop or sample rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticksmith.functions.timefn import NAIROBI, floor_time, iso_text, local_to_utc, wall_to_instant
from ticksmith.sources.tables import read_table

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]

# Message spoil rules, keyed by event_id % MESSAGE_SPOIL_MOD.
MESSAGE_SPOIL_MOD = 50
NOT_JSON = 0          # text 'not json'                      -> quarantine
NOT_OBJECT = 1        # text '[1]'                           -> quarantine
BAD_NUMBER = 2        # "price":"abc"                        -> quarantine
MISSING_FIELDS = 3    # only ticker and price                -> defaults
NUMERIC_STRINGS = 4   # price and volume as JSON strings     -> cast
FRACTIONAL_VOLUME = 5 # volume k + 0.9                       -> truncated
EXTRA_FIELD = 7       # one unknown key                      -> ignored
EMPTY_OBJECT = 8      # '{}'                                 -> ticker '', price 0
BAD_TIMESTAMP = 9     # fetched_at 'junk'                    -> bronze, staging reject
NULL_PRICE = 10       # "price":null                         -> price 0
TRAILING_TEXT = 11    # an object, then '] trailing'         -> quarantine
SECOND_OBJECT = 12    # an object, ']' and another object    -> quarantine
BRACES_INSIDE = 13    # braces in a text, a nested object    -> parsed
SUFFIXED_NUMBER = 14  # "price":"12.5d"                      -> quarantine
PARTIAL_TIME = 15     # fetched_at '2024-01'                 -> bronze, staging reject

# Replay rules, event_id % REPLAY_MOD -> minutes that the stamp is off the arrival.
REPLAY_MOD = 10
REPLAY_SHIFTS = {1: -55, 2: -5, 3: 5, 4: 55, 5: -4320}
REPLAY_BATCH_DAYS = 5
REPLAY_JUNK_MOD = 50            # remainder 9: the stamp is 'junk'

# The partitioned log, whose times are cut to LOG_HOURS.
LOG_PARTITIONS = 4
LOG_HOURS = 6

# Snapshot spoil rules (event_id modulus -> effect).
SNAPSHOT_ZERO_PRICE_MOD = 17    # last_price 0      -> skipped
SNAPSHOT_NULL_PRICE_MOD = 19    # last_price NULL   -> skipped
SNAPSHOT_NULL_VOLUME_MOD = 13   # avg volume NULL   -> 0
SNAPSHOT_NULL_CAP_MOD = 11      # market cap NULL   -> 0.0


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events", EVENT_COLS)


def user_ticker(user_id: Column) -> Column:
    """'T' + user id zero-padded to 6 digits (never truncated)."""
    return F.format_string("T%06d", user_id)


def _ticker(events_ticker: str) -> Column:
    if events_ticker == "user":
        return user_ticker(F.col("user_id"))
    if events_ticker == "event_type":
        return F.col("event_type")
    raise ValueError(f"unknown ticker mapping {events_ticker!r}")


def _volume() -> Column:
    return F.coalesce(F.get_json_object("props", "$.k").try_cast("bigint"), F.lit(0).cast("bigint"))


def events_as_bronze(events: DataFrame, ticker: str = "user", tz: str = NAIROBI) -> DataFrame:
    """Bronze raw ticks (schema ``BRONZE``) from ``events``."""
    t = _ticker(ticker)
    utc = local_to_utc(F.col("ts"), tz)
    # ts is the local wall clock already, so the text needs no second zone shift
    return events.select(
        t.alias("ticker"),
        t.alias("name"),
        F.col("value").alias("price"),
        _volume().alias("volume"),
        (F.col("value") * F.lit(1_000_000.0)).alias("market_cap"),
        F.lit("KES").alias("currency"),
        iso_text(F.col("ts"), utc).alias("fetched_at"),
        F.lit("NSE").alias("exchange"),
        utc.alias("inserted_at"),
        F.col("event_id").alias("seq"),
    )


def events_as_snapshots(events: DataFrame, tz: str = NAIROBI) -> DataFrame:
    """Landed quote snapshots (schema ``SNAPSHOT``) from ``events``.

    ``last_price = value * 1.001`` so the 2-decimal rounding of the
    normaliser really rounds; spoil rules give zero / NULL prices and NULL
    volume / market cap.
    """
    eid = F.col("event_id")
    price = (F.when(eid % SNAPSHOT_ZERO_PRICE_MOD == 0, F.lit(0.0))
             .when(eid % SNAPSHOT_NULL_PRICE_MOD == 0, F.lit(None).cast("double"))
             .otherwise(F.col("value") * F.lit(1.001)))
    vol = (F.when(eid % SNAPSHOT_NULL_VOLUME_MOD == 0, F.lit(None).cast("double"))
           .otherwise(_volume().cast("double") + F.lit(0.5)))
    cap = (F.when(eid % SNAPSHOT_NULL_CAP_MOD == 0, F.lit(None).cast("double"))
           .otherwise(F.col("value") * F.lit(1_000_000.0)))
    return events.select(
        F.concat(user_ticker(F.col("user_id")), F.lit(".NR")).alias("symbol"),
        price.alias("last_price"),
        vol.alias("avg_volume_3m"),
        cap.alias("market_cap"),
        local_to_utc(F.col("ts"), tz).alias("fetched_at"),
        eid.alias("seq"),
    )


def _q(s: Column) -> Column:
    """JSON string literal of a plain (quote-free) string column."""
    return F.concat(F.lit('"'), s, F.lit('"'))


def events_as_messages(events: DataFrame, ticker: str = "user", tz: str = NAIROBI) -> DataFrame:
    """Keyed JSON tick messages ``(key, value, seq)`` from ``events``,
    spoiled by the fixed ``event_id % 50`` rules above."""
    b = events_as_bronze(events, ticker, tz)
    good = F.to_json(F.struct(*[F.col(c) for c in
                                ["ticker", "name", "price", "volume", "market_cap",
                                 "currency", "fetched_at", "exchange"]]))
    r = F.col("seq") % MESSAGE_SPOIL_MOD
    tk = _q(F.col("ticker"))
    price_txt = F.col("price").cast("string")
    value = (
        F.when(r == NOT_JSON, F.lit("not json"))
        .when(r == NOT_OBJECT, F.lit("[1]"))
        .when(r == BAD_NUMBER, F.concat(F.lit('{"ticker":'), tk, F.lit(',"price":"abc"}')))
        .when(r == MISSING_FIELDS, F.concat(F.lit('{"ticker":'), tk, F.lit(',"price":'), price_txt, F.lit("}")))
        .when(r == NUMERIC_STRINGS, F.concat(F.lit('{"ticker":'), tk, F.lit(',"price":'), _q(price_txt),
                                             F.lit(',"volume":'), _q(F.col("volume").cast("string")), F.lit("}")))
        .when(r == FRACTIONAL_VOLUME, F.concat(F.lit('{"ticker":'), tk, F.lit(',"price":'), price_txt,
                                               F.lit(',"volume":'), F.col("volume").cast("string"), F.lit(".9}")))
        .when(r == EXTRA_FIELD, F.concat(F.lit('{"ticker":'), tk, F.lit(',"price":'), price_txt, F.lit(',"x":2}')))
        .when(r == EMPTY_OBJECT, F.lit("{}"))
        .when(r == BAD_TIMESTAMP, F.concat(F.lit('{"ticker":'), tk, F.lit(',"price":'), price_txt,
                                           F.lit(',"fetched_at":"junk"}')))
        .when(r == NULL_PRICE, F.concat(F.lit('{"ticker":'), tk, F.lit(',"price":null}')))
        .when(r == TRAILING_TEXT, F.concat(F.lit('{"ticker":'), tk, F.lit(',"price":1}] trailing')))
        .when(r == SECOND_OBJECT, F.concat(F.lit('{"ticker":'), tk, F.lit(',"price":1}]{"ticker":'), tk, F.lit(',"price":2}')))
        .when(r == BRACES_INSIDE, F.concat(F.lit('{"ticker":'), tk, F.lit(',"name":"a}b{","price":'), price_txt,
                                           F.lit(',"x":{"y":[1]}}')))
        .when(r == SUFFIXED_NUMBER, F.concat(F.lit('{"ticker":'), tk, F.lit(',"price":"12.5d"}')))
        .when(r == PARTIAL_TIME, F.concat(F.lit('{"ticker":'), tk, F.lit(',"price":'), price_txt,
                                          F.lit(',"fetched_at":"2024-01"}')))
        .otherwise(good)
    )
    return b.select(F.col("ticker").alias("key"), value.alias("value"), F.col("seq"))


def events_as_log_bronze(events: DataFrame, tz: str = NAIROBI) -> DataFrame:
    """Bronze of a partitioned log (schema ``LOG_BRONZE``) full of ties.

    Four partitions with offsets of their own, so that up to four ticks share an offset;
    times are cut to 6 hours, so that only (partition, offset) orders most ticks.
    Every 16th row of partition 0 has no partition number, which counts as 0.
    """
    eid = F.col("event_id")
    cut = floor_time(F.col("ts"), f"{LOG_HOURS} hours")
    utc = local_to_utc(cut, tz)
    place = F.when(eid % (16 * LOG_PARTITIONS) != 0, eid % LOG_PARTITIONS).cast("int")
    return events.select(
        F.col("event_type").alias("ticker"), F.col("event_type").alias("name"), F.col("value").alias("price"),
        _volume().alias("volume"), (F.col("value") * F.lit(1_000_000.0)).alias("market_cap"), F.lit("KES").alias("currency"),
        iso_text(cut, utc).alias("fetched_at"), F.lit("NSE").alias("exchange"), utc.alias("inserted_at"),
        F.floor(eid / LOG_PARTITIONS).alias("seq"), place.alias("partition"))


def events_as_shifted_bronze(events: DataFrame, tz: str = NAIROBI) -> DataFrame:
    """Bronze ticks of two insertion months whose stamps run late and ahead.

    Even event ids arrive 31 days earlier; of every ten ids, two are stamped 20
    days ahead of their arrival and two 20 days behind it.
    """
    eid = F.col("event_id")
    arrived = F.when(eid % 2 == 0, F.col("ts") - F.expr("INTERVAL 31 DAYS")).otherwise(F.col("ts"))
    stamped = (F.when((eid % 10).isin(1, 2), arrived + F.expr("INTERVAL 20 DAYS"))
               .when((eid % 10).isin(3, 4), arrived - F.expr("INTERVAL 20 DAYS")).otherwise(arrived))
    utc = local_to_utc(stamped, tz)
    return events.select(
        user_ticker(F.col("user_id")).alias("ticker"), user_ticker(F.col("user_id")).alias("name"), F.col("value").alias("price"),
        _volume().alias("volume"), (F.col("value") * F.lit(1_000_000.0)).alias("market_cap"), F.lit("KES").alias("currency"),
        iso_text(stamped, utc).alias("fetched_at"), F.lit("NSE").alias("exchange"),
        local_to_utc(arrived, tz).alias("inserted_at"), eid.alias("seq"))


def events_as_replay(events: DataFrame, tz: str = NAIROBI) -> DataFrame:
    """Ticks in arrival batches of five days, some of each stamped late, ahead or unreadably."""
    eid = F.col("event_id")
    shift = F.coalesce(*[F.when(eid % REPLAY_MOD == r, F.lit(m)) for r, m in REPLAY_SHIFTS.items()], F.lit(0))
    stamped = F.timestamp_add("MINUTE", shift, F.col("ts"))
    text = F.when(eid % REPLAY_JUNK_MOD == BAD_TIMESTAMP, F.lit("junk")).otherwise(iso_text(stamped, local_to_utc(stamped, tz)))
    return events.select(
        F.col("event_type").alias("ticker"), F.col("value").alias("price"), eid.alias("seq"), text.alias("fetched_at"),
        wall_to_instant(F.col("ts"), tz).alias("arrival_ts"),
        F.floor(F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) / REPLAY_BATCH_DAYS).cast("int").alias("batch"))


def events_as_universe_snapshots(events: DataFrame, universe: Sequence[str], tz: str = NAIROBI) -> DataFrame:
    """Snapshots of listed symbols and as many others: symbol number ``user_id % (2 * listed)``."""
    listed = F.array(*[F.lit(s) for s in universe])
    number = (F.col("_user") % F.lit(2 * len(universe))).cast("int")
    symbol = F.coalesce(F.get(listed, number), F.format_string("X%02d.NR", number))
    return (events_as_snapshots(events, tz).withColumn("_user", F.regexp_extract("symbol", "[0-9]+", 0).cast("bigint"))
            .withColumn("symbol", symbol).drop("_user"))


# What ``spoiled_tables`` does to the six checked tables, by numbers that rows have anyway.
def spoiled_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The checked tables with faults for every declared check; no row is dropped."""
    def null_if(cond: Column, c: str) -> Column:
        return F.when(~cond, F.col(c))

    seq, minute, day = F.col("seq"), F.minute("_start"), F.dayofmonth("_date") % 7
    raw, bars, ticks = tables["raw_ticks"], tables["ohlcv_5min"], tables["stg_ticks"]
    staged, days, moves = tables["stg_bars"], tables["daily_summary"], tables["top_movers"]
    return {
        "raw_ticks": raw.withColumns({"ticker": null_if(seq % 7 == 0, "ticker"), "price": null_if(seq % 11 == 0, "price"),
                                      "fetched_at": null_if(seq % 13 == 0, "fetched_at")}),
        "ohlcv_5min": bars.withColumn("_start", F.col("window_start")).withColumns({
            "ticker": null_if(minute == 5, "ticker"), "window_start": null_if(minute == 10, "window_start"),
            "close_price": null_if(minute == 15, "close_price")}).drop("_start"),
        "stg_ticks": ticks.withColumns({"ticker": null_if(seq % 7 == 0, "ticker"),
                                        "price": F.when(seq % 11 == 0, None).when(seq % 13 == 0, -F.col("price"))
                                        .when(seq % 17 == 0, F.lit(0.0)).otherwise(F.col("price"))}),
        "stg_bars": staged.withColumn("_start", F.col("window_start")).withColumns({
            "ticker": null_if(minute == 20, "ticker"),
            "tick_count": F.when(minute == 25, F.lit(0)).otherwise(F.col("tick_count"))}).drop("_start"),
        "daily_summary": days.withColumn("_date", F.col("trade_date")).withColumns({
            "trade_date": null_if(day == 0, "trade_date"), "ticker": null_if(day == 1, "ticker"),
            "open_price": F.when(day == 2, None).when(day == 3, F.lit(0.0)).otherwise(F.col("open_price")),
            "close_price": null_if(day == 4, "close_price"), "pct_change": null_if(day == 5, "pct_change")}).drop("_date"),
        "top_movers": moves.withColumn("_date", F.col("trade_date")).withColumns({
            "trade_date": null_if(day == 0, "trade_date"),
            "direction": F.when(day == 1, None).when(day == 2, F.lit("flat")).otherwise(F.col("direction")),
            "rank": F.when(day == 3, None).when(day == 4, F.col("rank") + 5).otherwise(F.col("rank"))}).drop("_date"),
    }
