"""DuckDB SQL for every catalogue query — the independent oracle.

Written directly against the driver's ``events`` view, not generated from
the Spark code.  Parity notes: ``round_even(x * 100, 0) / 100`` is Spark's
``rint(x * 100) / 100``; every ``> 0`` on a price adds ``NOT isnan``;
``-0.0`` is mapped to ``0.0``; DuckDB casts DOUBLE to BIGINT by rounding,
so truncation is written as ``trunc``.  ``events.ts`` is Nairobi wall
clock, so the UTC instant is ``ts - INTERVAL 3 HOUR``.
"""

from __future__ import annotations

# The declared checks as (table, column, kind, condition of failure); written here, not imported.
RANGE, VALUES, NULL = "accepted_range", "accepted_values", "not_null"
CHECKS = (
    [("raw_ticks", c, NULL, f"{c} IS NULL") for c in ("ticker", "price", "fetched_at")]
    + [("ohlcv_5min", c, NULL, f"{c} IS NULL") for c in ("ticker", "window_start", "close_price")]
    + [("stg_ticks", c, NULL, f"{c} IS NULL") for c in ("ticker", "price")]
    + [("stg_ticks", "price", RANGE, "NOT price > 0 OR isnan(price)")]
    + [("stg_bars", "ticker", NULL, "ticker IS NULL"), ("stg_bars", "tick_count", RANGE, "NOT tick_count >= 1")]
    + [("daily_summary", c, NULL, f"{c} IS NULL") for c in ("trade_date", "ticker", "open_price", "close_price", "pct_change")]
    + [("daily_summary", "open_price", RANGE, "NOT open_price > 0 OR isnan(open_price)")]
    + [("top_movers", c, NULL, f"{c} IS NULL") for c in ("trade_date", "direction", "rank")]
    + [("top_movers", "direction", VALUES, "direction NOT IN ('gainer', 'loser')")]
    + [("top_movers", "rank", RANGE, "NOT rank BETWEEN 1 AND 5")]
)
# Fields of a parsed tick, in message order.
PARSED_FIELDS = ["ticker", "name", "price", "volume", "market_cap", "currency", "fetched_at", "exchange", "seq"]
# The listed symbols.
LISTED = ("SCOM EQTY KCB EABL BAT COOP ABSA NCBA SBIC DTB SCBK IMM KEGN KPLC SASN BAMB CTUM CABL NMG TCL").split()

VOLUME = "COALESCE(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT), 0)"
ISO = ("strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' "
       "ELSE printf('.%06d', microsecond(ts) % 1000000) END || '+03:00'")
UTC = "(ts - INTERVAL 3 HOUR)"
USER_TICKER = "printf('T%06d', user_id)"


def bronze(ticker: str) -> str:
    return f"""SELECT {ticker} AS ticker, {ticker} AS name, value AS price, {VOLUME} AS volume,
        value * CAST(1000000.0 AS DOUBLE) AS market_cap, 'KES' AS currency, {ISO} AS fetched_at,
        'NSE' AS exchange, {UTC} AS inserted_at, event_id AS seq, ts AS local_ts
      FROM events"""


def staged(ticker: str) -> str:
    return f"""SELECT ticker, name, price, volume, market_cap, currency, exchange,
          {UTC} AS fetched_at, CAST(ts AS DATE) AS trade_date, {UTC} AS inserted_at, event_id AS seq
        FROM (SELECT *, {ticker} AS ticker, {ticker} AS name, value AS price, {VOLUME} AS volume,
                value * CAST(1000000.0 AS DOUBLE) AS market_cap, 'KES' AS currency, 'NSE' AS exchange
              FROM events) e
        WHERE price > 0 AND NOT isnan(price) AND ticker <> ''
        QUALIFY row_number() OVER (PARTITION BY ticker, date_trunc('minute', {UTC})
                                   ORDER BY {UTC} DESC, event_id DESC) = 1"""


def r2(x: str) -> str:
    return f"(CASE WHEN round_even(({x}) * 100, 0) / 100 = 0 THEN 0.0 ELSE round_even(({x}) * 100, 0) / 100 END)"


DAILY = f"""
  WITH s AS ({staged(USER_TICKER)}),
  a AS (SELECT trade_date, ticker, arg_min(price, fetched_at) AS open_price, max(price) AS high_price,
               min(price) AS low_price, arg_max(price, fetched_at) AS close_price, count(*) AS total_ticks
        FROM s GROUP BY trade_date, ticker)
  SELECT trade_date, ticker, open_price, high_price, low_price, close_price,
         {r2('close_price - open_price')} AS price_change,
         {r2('(close_price - open_price) / open_price * 100')} AS pct_change,
         total_ticks
  FROM a WHERE open_price > 0 AND NOT isnan(open_price)"""

# One window per day and sign: the largest moves of either sign come first.
MOVERS = f"""
  SELECT trade_date, CASE WHEN pct_change > 0 THEN 'gainer' ELSE 'loser' END AS direction,
         CAST(row_number() OVER (PARTITION BY trade_date, sign(pct_change)
                                 ORDER BY abs(pct_change) DESC, ticker) AS INTEGER) AS rank,
         ticker, close_price, pct_change
  FROM ({DAILY}) AS days
  WHERE total_ticks >= 3 AND pct_change <> 0
  QUALIFY rank <= 5"""

BARS = f"""
  SELECT event_type AS ticker,
         time_bucket(INTERVAL 5 MINUTE, {UTC}) AS window_start,
         time_bucket(INTERVAL 5 MINUTE, {UTC}) + INTERVAL 5 MINUTE AS window_end,
         arg_min(value, (ts, event_id)) AS open_price, max(value) AS high_price,
         min(value) AS low_price, arg_max(value, (ts, event_id)) AS close_price,
         count(*) AS tick_count
  FROM events GROUP BY 1, 2, 3"""

STAGE_BARS = f"""
  SELECT *, CAST(window_start + INTERVAL 3 HOUR AS DATE) AS trade_date FROM ({BARS}) b
  WHERE tick_count > 0 AND open_price > 0 AND NOT isnan(open_price)
    AND close_price > 0 AND NOT isnan(close_price)"""

SNAPSHOTS = f"""
  SELECT {USER_TICKER} || '.NR' AS symbol,
         CASE WHEN event_id % 17 = 0 THEN 0.0 WHEN event_id % 19 = 0 THEN NULL
              ELSE value * CAST(1.001 AS DOUBLE) END AS last_price,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST({VOLUME} AS DOUBLE) + 0.5 END AS avg_volume_3m,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE value * CAST(1000000.0 AS DOUBLE) END AS market_cap,
         ts, event_id AS seq
  FROM events"""

# Message spoil classes by event_id % 50 (see sources.events).
MESSAGES = f"SELECT *, seq % 50 AS r FROM ({bronze(USER_TICKER)}) b"

PARSED = f"""
  SELECT seq,
         CASE WHEN r = 8 THEN '' ELSE ticker END AS ticker,
         CASE WHEN r = 13 THEN 'a}}b{{' WHEN r IN (3, 4, 5, 7, 8, 9, 10, 15) THEN '' ELSE name END AS name,
         CASE WHEN r IN (8, 10) THEN 0.0 ELSE price END AS price,
         CASE WHEN r IN (3, 7, 8, 9, 10, 13, 15) THEN 0 ELSE volume END AS volume,
         CASE WHEN r IN (3, 4, 5, 7, 8, 9, 10, 13, 15) THEN 0.0 ELSE market_cap END AS market_cap,
         'KES' AS currency,
         CASE WHEN r = 9 THEN 'junk' WHEN r = 15 THEN '2024-01' WHEN r IN (3, 4, 5, 7, 8, 10, 13) THEN '' ELSE fetched_at END AS fetched_at,
         'NSE' AS exchange
  FROM ({MESSAGES}) m WHERE r NOT IN (0, 1, 2, 11, 12, 14)"""


def rejects(ticker: str) -> str:
    return f"""
      SELECT seq, ticker AS key,
             CASE r WHEN 0 THEN 'not json' WHEN 1 THEN '[1]'
                    WHEN 11 THEN '{{"ticker":"' || ticker || '","price":1}}] trailing'
                    WHEN 12 THEN '{{"ticker":"' || ticker || '","price":1}}]{{"ticker":"' || ticker || '","price":2}}'
                    WHEN 14 THEN '{{"ticker":"' || ticker || '","price":"12.5d"}}'
                    ELSE '{{"ticker":"' || ticker || '","price":"abc"}}' END AS raw_value,
             CASE WHEN r IN (2, 14) THEN 'bad_number' ELSE 'malformed' END AS reason
      FROM (SELECT *, seq % 50 AS r FROM ({bronze(ticker)}) b) m WHERE r IN (0, 1, 2, 11, 12, 14)"""


# Ticks with a readable message and time: the spoil rules leave these.
TIMED = "SELECT * FROM events WHERE event_id % 50 NOT IN (0, 1, 2, 3, 4, 5, 7, 8, 9, 10, 11, 12, 13, 14, 15)"

# Two insertion months, stamps late and ahead (see sources.events).
SHIFTED_DAILY = f"""
  WITH t AS (SELECT *, arrived + CASE WHEN event_id % 10 IN (1, 2) THEN INTERVAL 20 DAY WHEN event_id % 10 IN (3, 4) THEN INTERVAL (-20) DAY
                       ELSE INTERVAL 0 DAY END AS stamped
             FROM (SELECT *, CASE WHEN event_id % 2 = 0 THEN ts - INTERVAL 31 DAY ELSE ts END AS arrived FROM events)),
  s AS (SELECT {USER_TICKER} AS ticker, value AS price, stamped, CAST(stamped AS DATE) AS trade_date FROM t
        WHERE value > 0 AND NOT isnan(value)
        QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('minute', stamped) ORDER BY arrived DESC, event_id DESC) = 1),
  a AS (SELECT trade_date, ticker, arg_min(price, stamped) AS open_price, max(price) AS high_price, min(price) AS low_price,
               arg_max(price, stamped) AS close_price, count(*) AS total_ticks FROM s GROUP BY trade_date, ticker)
  SELECT trade_date, ticker, open_price, high_price, low_price, close_price, {r2('close_price - open_price')} AS price_change,
         {r2('(close_price - open_price) / open_price * 100')} AS pct_change, total_ticks
  FROM a WHERE open_price > 0 AND NOT isnan(open_price)"""


# A log of four partitions with offsets of their own; times cut to six hours.
LOG = f"""SELECT event_type AS ticker, value AS price, {VOLUME} AS volume, value * CAST(1000000.0 AS DOUBLE) AS market_cap,
      time_bucket(INTERVAL 6 HOUR, ts) AS wall, event_id // 4 AS seq, event_id % 4 AS part
    FROM events"""

LOG_BARS = f"""
  SELECT ticker, wall - INTERVAL 3 HOUR AS window_start, wall - INTERVAL 3 HOUR + INTERVAL 5 MINUTE AS window_end,
         arg_min(price, part * 1000000000000 + seq) AS open_price, max(price) AS high_price, min(price) AS low_price,
         arg_max(price, part * 1000000000000 + seq) AS close_price, count(*) AS tick_count
  FROM ({LOG}) AS log GROUP BY ticker, wall"""

LOG_STAGED = f"""
  SELECT ticker, ticker AS name, price, volume, market_cap, 'KES' AS currency, 'NSE' AS exchange, wall - INTERVAL 3 HOUR AS fetched_at,
         CAST(wall AS DATE) AS trade_date, wall - INTERVAL 3 HOUR AS inserted_at, seq
  FROM ({LOG}) AS log WHERE price > 0 AND NOT isnan(price)
  QUALIFY row_number() OVER (PARTITION BY ticker, wall ORDER BY part DESC, seq DESC) = 1"""

LOG_DAILY = f"""
  WITH a AS (SELECT trade_date, ticker, arg_min(price, fetched_at) AS open_price, max(price) AS high_price, min(price) AS low_price,
                    arg_max(price, fetched_at) AS close_price, count(*) AS total_ticks FROM ({LOG_STAGED}) AS s GROUP BY trade_date, ticker)
  SELECT trade_date, ticker, open_price, high_price, low_price, close_price, {r2('close_price - open_price')} AS price_change,
         {r2('(close_price - open_price) / open_price * 100')} AS pct_change, total_ticks
  FROM a WHERE open_price > 0 AND NOT isnan(open_price)"""


# Arrival batches of five days, stamps late, ahead and unreadable; every batch meets the watermark of those before it.
REPLAYED = f"""
  WITH t AS (SELECT event_id, event_type, value, ts, CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 5.0) AS INTEGER) AS batch,
               CASE WHEN event_id % 50 <> 9 THEN {UTC} + to_minutes(CASE event_id % 10 WHEN 1 THEN -55 WHEN 2 THEN -5 WHEN 3 THEN 5
                    WHEN 4 THEN 55 WHEN 5 THEN -4320 ELSE 0 END) END AS stamp FROM events),
  u AS (SELECT *, stamp > {UTC} + INTERVAL 10 MINUTE AS ahead, time_bucket(INTERVAL 5 MINUTE, stamp) AS window_start FROM t),
  w AS (SELECT *, window_start + INTERVAL 5 MINUTE AS window_end,
          max(CASE WHEN NOT ahead THEN stamp END) OVER (ORDER BY batch RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
            - INTERVAL 10 MINUTE AS watermark FROM u)
  SELECT *, CASE WHEN stamp IS NULL THEN 'unreadable' WHEN ahead THEN 'ahead' WHEN window_end <= watermark THEN 'late'
                 ELSE 'admitted' END AS verdict FROM w"""


def _quality_tables() -> dict[str, str]:
    return {
        "raw_ticks": bronze(USER_TICKER),
        "ohlcv_5min": BARS,
        "stg_ticks": staged(USER_TICKER),
        "stg_bars": STAGE_BARS,
        "daily_summary": DAILY,
        "top_movers": MOVERS,
    }


def checks_of(table: str, as_table: str | None = None) -> list[tuple[str, str, str, str]]:
    return [(as_table or t, c, kind, cond) for t, c, kind, cond in CHECKS if t == table]


def _quality_results(tables: dict[str, str] | None = None, checks=CHECKS) -> str:
    tables = tables or _quality_tables()
    return "\nUNION ALL\n".join(
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, '{kind}' AS check_name,
            CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS failures, 'warn' AS severity FROM ({tables[t]}) t"""
        for t, c, kind, cond in checks)


def _quality_failing_rows(tables: dict[str, str] | None = None, checks=CHECKS, json_cols: list[str] | None = None) -> str:
    """``json_cols`` fixes the field order of ``row_json`` (the Spark
    relation's column order) when the SQL lists its columns differently."""
    tables = tables or _quality_tables()
    row = f"struct_pack({', '.join(json_cols)})" if json_cols else "t"
    return "\nUNION ALL\n".join(
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, '{kind}' AS check_name,
            CAST(to_json({row}) AS VARCHAR) AS row_json FROM ({tables[t]}) t WHERE {cond}""" for t, c, kind, cond in checks)


def _spoiled_tables() -> dict[str, str]:
    t = _quality_tables()
    return {
        "raw_ticks": f"""SELECT * REPLACE (CASE WHEN seq % 7 <> 0 THEN ticker END AS ticker, CASE WHEN seq % 11 <> 0 THEN price END AS price,
            CASE WHEN seq % 13 <> 0 THEN fetched_at END AS fetched_at) FROM ({t['raw_ticks']})""",
        "ohlcv_5min": f"""SELECT * REPLACE (CASE WHEN minute(window_start) <> 5 THEN ticker END AS ticker,
            CASE WHEN minute(window_start) <> 10 THEN window_start END AS window_start,
            CASE WHEN minute(window_start) <> 15 THEN close_price END AS close_price) FROM ({t['ohlcv_5min']})""",
        "stg_ticks": f"""SELECT * REPLACE (CASE WHEN seq % 7 <> 0 THEN ticker END AS ticker, CASE WHEN seq % 11 = 0 THEN NULL
            WHEN seq % 13 = 0 THEN -price WHEN seq % 17 = 0 THEN 0 ELSE price END AS price) FROM ({t['stg_ticks']})""",
        "stg_bars": f"""SELECT * REPLACE (CASE WHEN minute(window_start) <> 20 THEN ticker END AS ticker,
            CASE WHEN minute(window_start) = 25 THEN 0 ELSE tick_count END AS tick_count) FROM ({t['stg_bars']})""",
        "daily_summary": f"""SELECT * REPLACE (CASE WHEN day(trade_date) % 7 <> 0 THEN trade_date END AS trade_date,
            CASE WHEN day(trade_date) % 7 <> 1 THEN ticker END AS ticker,
            CASE day(trade_date) % 7 WHEN 2 THEN NULL WHEN 3 THEN 0 ELSE open_price END AS open_price,
            CASE WHEN day(trade_date) % 7 <> 4 THEN close_price END AS close_price,
            CASE WHEN day(trade_date) % 7 <> 5 THEN pct_change END AS pct_change) FROM ({t['daily_summary']})""",
        "top_movers": f"""SELECT * REPLACE (CASE WHEN day(trade_date) % 7 <> 0 THEN trade_date END AS trade_date,
            CASE day(trade_date) % 7 WHEN 1 THEN NULL WHEN 2 THEN 'flat' ELSE direction END AS direction,
            CASE day(trade_date) % 7 WHEN 3 THEN NULL WHEN 4 THEN rank + 5 ELSE rank END AS rank) FROM ({t['top_movers']})""",
    }


ORACLE: dict[str, str] = {
    "normalise_snapshots": f"""
      SELECT symbol AS ticker, replace(symbol, '.NR', '') AS name,
             round_even(last_price * 100, 0) / 100 AS price,
             COALESCE(CAST(trunc(avg_volume_3m) AS BIGINT), 0) AS volume,
             COALESCE(market_cap, 0.0) AS market_cap, 'KES' AS currency, {ISO} AS fetched_at,
             'NSE' AS exchange, seq
      FROM ({SNAPSHOTS}) s WHERE last_price IS NOT NULL AND last_price <> 0""",
    "ingest_counts": f"""
      SELECT CASE WHEN last_price IS NOT NULL AND last_price <> 0 THEN 'published' ELSE 'skipped' END AS status,
             count(*) AS n
      FROM ({SNAPSHOTS}) s GROUP BY 1""",
    "publish_json": f"""
      SELECT seq, ticker, name, price, volume, market_cap, currency, fetched_at, exchange
      FROM ({bronze(USER_TICKER)}) b""",
    "parse_ticks": PARSED,
    "quarantine_ticks": rejects(USER_TICKER),
    "fan_out_rejects": rejects("event_type"),
    "parse_fetched_at": f"""
      SELECT event_id AS seq, {ISO} AS fetched_at_text, {UTC} AS fetched_at, CAST(ts AS DATE) AS trade_date
      FROM events""",
    "session_ticks": f"""
      SELECT event_id AS seq, {USER_TICKER} AS ticker, value AS price, {UTC} AS fetched_at
      FROM events
      WHERE isodow(ts) <= 5 AND hour(ts) * 60 + minute(ts) >= 540 AND hour(ts) * 60 + minute(ts) < 930""",
    "stage_ticks": staged("event_type"),
    "stage_rejects": f"""
      SELECT seq, ticker, price, fetched_at AS fetched_at_raw
      FROM ({PARSED}) p
      WHERE price > 0 AND NOT isnan(price) AND ticker <> '' AND TRY_CAST(fetched_at AS TIMESTAMPTZ) IS NULL""",
    "bars_5min": BARS,
    "stage_bars": STAGE_BARS,
    "log_bars": LOG_BARS,
    "log_bar_parts": LOG_BARS,
    "log_stage_ticks": LOG_STAGED,
    "log_daily_summary": LOG_DAILY,
    "daily_summary": DAILY,
    "incremental_marts": DAILY,      # equal to a full rebuild
    "incremental_marts_shifted": SHIFTED_DAILY,
    "top_movers": MOVERS,
    "top_movers_single_pass": MOVERS,
    "movers_report": f"""
      WITH m AS ({MOVERS})
      SELECT trade_date, direction, rank, ticker, pct_change,
             printf('  %s %-8s  %+.2f%%  (%s)', CASE WHEN direction = 'gainer' THEN '↑' ELSE '↓' END,
                    ticker, pct_change, direction) AS line
      FROM m WHERE trade_date = (SELECT max(trade_date) FROM m) AND rank <= 3""",
    "health_today": f"""
      SELECT tick_count, ticker_count,
             'Today''s ticks so far: ' || format('{{:,}}', tick_count) || ' rows across '
               || ticker_count || ' tickers' AS line
      FROM (SELECT count(*) AS tick_count, count(DISTINCT {USER_TICKER}) AS ticker_count
            FROM events WHERE CAST({UTC} AS DATE) = (SELECT max(CAST({UTC} AS DATE)) FROM events)) h""",
    "health_by_day": f"""
      SELECT CAST({UTC} AS DATE) AS day, count(*) AS total_ticks,
             count(DISTINCT {USER_TICKER}) AS unique_tickers, min(value) AS min_price, max(value) AS max_price
      FROM events WHERE CAST({UTC} AS DATE) >= (SELECT max(CAST({UTC} AS DATE)) FROM events) - 1
      GROUP BY 1""",
    "peek": f"""
      SELECT ticker, price, fetched_at FROM ({bronze(USER_TICKER)}) b
      ORDER BY ticker, inserted_at, seq LIMIT 10""",
    "quality_results": _quality_results(),
    "quality_failing_rows": _quality_failing_rows(),
    "quality_parsed_ticks": _quality_results({"parsed_ticks": PARSED}, checks_of("stg_ticks", "parsed_ticks")),
    "quality_parsed_failing_rows": _quality_failing_rows(
        {"parsed_ticks": PARSED}, checks_of("stg_ticks", "parsed_ticks"), json_cols=PARSED_FIELDS),
    "quality_spoiled_results": _quality_results(_spoiled_tables()),
    "quality_written": _quality_results(checks=checks_of("daily_summary") + checks_of("top_movers")),
    "universe_snapshots": f"""
      SELECT symbol AS ticker, replace(symbol, '.NR', '') AS name, round_even(last_price * 100, 0) / 100 AS price,
             COALESCE(CAST(trunc(avg_volume_3m) AS BIGINT), 0) AS volume, COALESCE(market_cap, 0.0) AS market_cap, 'KES' AS currency,
             {ISO} AS fetched_at, 'NSE' AS exchange, seq
      FROM (SELECT * REPLACE ({LISTED}[CAST(substr(symbol, 2, length(symbol) - 4) AS INTEGER) % 40 + 1] || '.NR' AS symbol) FROM ({SNAPSHOTS})) s
      WHERE symbol IS NOT NULL AND last_price IS NOT NULL AND last_price <> 0""",
    "message_keys": f"SELECT event_id AS seq, {USER_TICKER} AS key, {USER_TICKER} AS ticker FROM events",
    "published_daily": f"""SELECT *, row_number() OVER (ORDER BY trade_date DESC, pct_change DESC, ticker) AS position FROM ({DAILY}) d""",
    "published_movers": f"""SELECT *, row_number() OVER (ORDER BY trade_date DESC, direction, rank) AS position FROM ({MOVERS}) m""",
    "stream_bars_arrival": f"SELECT * FROM ({BARS}) b WHERE window_end <= (SELECT max({UTC}) FROM events)",
    "retain_two_years": f"""
      SELECT event_id AS seq, {USER_TICKER} AS ticker, {UTC} AS inserted_at,
             CAST(year({UTC}) * 100 + month({UTC}) AS INTEGER) AS ym
      FROM events WHERE {UTC} + INTERVAL 2 YEAR > TIMESTAMP '2026-01-15 00:00:00'""",
    "expired_bronze": f"""
      SELECT event_id AS seq, {USER_TICKER} AS ticker, {UTC} AS inserted_at,
             CAST(year({UTC}) * 100 + month({UTC}) AS INTEGER) AS ym
      FROM events WHERE {UTC} + INTERVAL 2 YEAR > TIMESTAMP '2026-01-15 00:00:00'""",
    "compacted_bronze": f"""
      SELECT event_id AS seq, {USER_TICKER} AS ticker, {UTC} AS inserted_at,
             CAST(year({UTC}) * 100 + month({UTC}) AS INTEGER) AS ym
      FROM events""",
    "monthly_layout": f"""
      SELECT CAST(year({UTC}) * 100 + month({UTC}) AS INTEGER) AS ym, count(*) AS n_rows,
             count(DISTINCT {USER_TICKER}) AS n_tickers,
             min({UTC}) AS first_inserted_at, max({UTC}) AS last_inserted_at
      FROM events GROUP BY 1""",
    "stream_bars": f"""
      SELECT * FROM ({BARS}) b
      WHERE window_end <= (SELECT max({UTC}) FROM events)""",
    "stream_bronze": PARSED,
    # bars need a parsed message with a parseable fetched_at
    "stream_bars_via_bronze": f"""
      WITH ev AS ({TIMED})
      SELECT * FROM ({BARS.replace("FROM events", "FROM ev")}) b
      WHERE window_end <= (SELECT max({UTC}) FROM ev)""",
    # late ticks repair their bars, so every readable tick counts
    "fan_out_bars": f"""
      WITH ev AS ({TIMED})
      SELECT * FROM ({BARS.replace("FROM events", "FROM ev")}) b""",
    "fan_out_bronze": PARSED.replace(MESSAGES, f"SELECT *, seq % 50 AS r FROM ({bronze('event_type')}) b"),
    # bars are given once they end by the last watermark
    "replay_bars": f"""
      WITH r AS ({REPLAYED})
      SELECT event_type AS ticker, window_start, window_end, arg_min(value, (stamp, event_id)) AS open_price, max(value) AS high_price,
             min(value) AS low_price, arg_max(value, (stamp, event_id)) AS close_price, count(*) AS tick_count
      FROM r WHERE verdict = 'admitted' AND window_end <= (SELECT max(stamp) - INTERVAL 10 MINUTE FROM r WHERE NOT ahead)
      GROUP BY 1, 2, 3""",
    "replay_ticks": f"""
      SELECT event_id AS seq, event_type AS ticker, value AS price, window_start, window_end
      FROM ({REPLAYED}) r WHERE verdict = 'admitted'""",
    "replay_admission": f"SELECT event_id AS seq, batch, watermark, verdict FROM ({REPLAYED}) r",
    "replay_bars_arrival": BARS,     # the clock closes the last ones
}
