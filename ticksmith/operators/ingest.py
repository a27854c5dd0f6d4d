"""Ingest: normalise snapshots, publish JSON, parse JSON, quarantine.

Operators S6, P1, F1, F12, A5 (snapshot side) and K1, P2, P3, F2 (message
side).  All are column expressions — no Python UDF — so they run unchanged
on a batch DataFrame or a streaming one.

Parsing rules (lenient like the reference consumer, but never failing):

* missing key or explicit ``null`` -> the field default (``TICK_DEFAULTS``);
* numbers may arrive as JSON strings (``"12.5"``); volume may be fractional
  and is truncated toward zero;
* text that is not a JSON object, or a numeric field that is not a number,
  goes to quarantine with the raw text and a reason instead of failing;
* a bare ``NaN`` price is a number (kept in bronze, cut in staging).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticksmith.functions.numeric import round_half_even
from ticksmith.functions.timefn import NAIROBI, instant_to_utc, iso_local
from ticksmith.schemas import BRONZE_COLS, TICK_COLS, TICK_DEFAULTS

# The 20 listed symbols of the reference universe.
NSE_UNIVERSE = (
    "SCOM.NR", "EQTY.NR", "KCB.NR", "EABL.NR", "BAT.NR",
    "COOP.NR", "ABSA.NR", "NCBA.NR", "SBIC.NR", "DTB.NR",
    "SCBK.NR", "IMM.NR", "KEGN.NR", "KPLC.NR", "SASN.NR",
    "BAMB.NR", "CTUM.NR", "CABL.NR", "NMG.NR", "TCL.NR",
)

# Fixed value: suffix the data vendor appends to venue symbols.
SYMBOL_SUFFIX = ".NR"

REJECT_MALFORMED = "malformed"
REJECT_BAD_NUMBER = "bad_number"


# --------------------------------------------------------------------------
# Snapshot side (producer)
# --------------------------------------------------------------------------

def snapshot_is_valid(last_price: Column) -> Column:
    """a snapshot is skipped when its price is NULL or 0."""
    return last_price.isNotNull() & (last_price != 0)


def normalise_snapshots(snapshots: DataFrame, tz: str = NAIROBI,
                        universe: Iterable[str] | None = None) -> DataFrame:
    """S6 + P1 + F1 + F12: landed quote snapshots -> tick rows (``TICK``).

    ``snapshots`` has ``symbol, last_price, avg_volume_3m, market_cap,
    fetched_at`` (NTZ UTC) and optionally ``seq``.  ``universe`` restricts to
    listed symbols (pass ``NSE_UNIVERSE`` for the reference's list).
    """
    df = snapshots.filter(snapshot_is_valid(F.col("last_price")))
    if universe is not None:
        df = df.filter(F.col("symbol").isin(list(universe)))
    vol = F.coalesce(F.col("avg_volume_3m").try_cast("bigint"), F.lit(0).cast("bigint"))
    cols = [
        F.col("symbol").alias("ticker"),
        F.replace(F.col("symbol"), F.lit(SYMBOL_SUFFIX), F.lit("")).alias("name"),
        round_half_even(F.col("last_price").cast("double")).alias("price"),
        vol.alias("volume"),
        F.coalesce(F.col("market_cap").cast("double"), F.lit(0.0)).alias("market_cap"),
        F.lit(TICK_DEFAULTS["currency"]).alias("currency"),
        iso_local(F.col("fetched_at"), tz).alias("fetched_at"),
        F.lit(TICK_DEFAULTS["exchange"]).alias("exchange"),
    ]
    if "seq" in snapshots.columns:
        cols.append(F.col("seq"))
    return df.select(*cols)


def ingest_counts(snapshots: DataFrame) -> DataFrame:
    """A5: per-batch ``published`` / ``skipped`` counters as a tiny table."""
    status = F.when(snapshot_is_valid(F.col("last_price")), F.lit("published")).otherwise(F.lit("skipped"))
    return snapshots.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def observe_published(snapshots: DataFrame, observation) -> DataFrame:
    """A5 live: ``published`` / ``skipped`` counted while the snapshots flow
    through (``DataFrame.observe``) — same pass, no extra job or shuffle.

    ``observation`` is a ``pyspark.sql.Observation`` for batch (read
    ``.get`` after the action) or a name for a stream (reported per
    micro-batch in ``query.lastProgress['observedMetrics'][name]``).
    """
    ok = snapshot_is_valid(F.col("last_price"))
    return snapshots.observe(observation, F.count_if(ok).alias("published"),
                             F.count_if(~ok).alias("skipped"))


# --------------------------------------------------------------------------
# Message side (publish / consume)
# --------------------------------------------------------------------------

def to_messages(ticks: DataFrame) -> DataFrame:
    """K1: ticks -> keyed JSON records ``(key = ticker, value = JSON)``."""
    value = F.to_json(F.struct(*[F.col(c) for c in TICK_COLS]))
    cols = [F.col("ticker").alias("key"), value.alias("value")]
    if "seq" in ticks.columns:
        cols.append(F.col("seq"))
    return ticks.select(*cols)


_RAW_SCHEMA = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in [*TICK_COLS, "__end"]]))
_JSON_OPTIONS = {"mode": "PERMISSIVE", "allowNonNumericNumbers": "true", "allowSingleQuotes": "false"}
# A JSON number, or one of the names that a float may have.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_NAMED = r"^\s*\"?[+-]?(?i:nan|inf|infinity)\"?\s*$"


def _unquote(c: Column) -> Column:
    # A bare NaN arrives as the text "NaN" *with* quotes under a string schema.
    return F.when(c.rlike(_NAMED), F.btrim(c, F.lit('" '))).when(c.rlike(_NUMBER), c)


def _double(raw: Column) -> Column:
    return _unquote(raw).try_cast("double")


def _bigint(raw: Column) -> Column:
    txt = _unquote(raw)
    wide = txt.try_cast("double")
    return F.coalesce(txt.try_cast("bigint"), F.when(F.abs(wide) < F.lit(2.0 ** 63), wide).try_cast("bigint"))


# Fixed value: the field of the closing element that follows a message in the parsed array.
_END = "__end"


def _with_end(value: Column) -> Column:
    """``[value, {"__end": mark}]``; the mark is a hash of the text, which the text can't hold itself."""
    return F.concat(F.lit("["), value, F.lit(',{"' + _END + '":"'), F.hex(F.xxhash64(value)), F.lit('"}]'))


def _only_object(parsed: Column, value: Column) -> Column:
    """True if the text was a single JSON object: the closing element comes second and last.

    Text that ends the array early, or a second value, moves or hides it.
    """
    whole = (F.size(parsed) == 2) & (F.get(parsed, F.lit(1)).getField(_END) == F.hex(F.xxhash64(value)))
    return F.coalesce(whole & F.get(parsed, F.lit(0)).isNotNull(), F.lit(False))


def bind(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Evaluate ``expr`` once per row as column ``name`` (a LATERAL VIEW).

    Catalyst pushes filters through projections by inlining the projected
    expressions, once per reference: a filter reading nine fields of a
    ``from_json`` result would parse the text nine times.  A column produced
    by a generator is an attribute no filter can inline, so the expression
    below it runs exactly once per row.
    """
    return df.select("*", F.inline(F.array(F.struct(expr.alias(name)))))


def parse_messages(messages: DataFrame) -> DataFrame:
    """JSON text -> tick columns + ``reject`` reason (NULL when good).

    Every numeric field is read as text first and cast with ``try_cast``, so
    ``"12.5"``, ``7``, ``1.9`` and ``NaN`` are accepted and ``"abc"`` is a
    reject rather than a failure.  Pass-through columns: ``seq``, ``key``
    and ``value`` (raw text, kept for the quarantine).  The text is parsed
    once per row (``bind``), however many fields later filters read.
    """
    both = bind(messages, "_both", F.from_json(_with_end(F.col("value")), _RAW_SCHEMA, _JSON_OPTIONS))
    df = both.select("*", F.get("_both", F.lit(0)).alias("_j"), _only_object(F.col("_both"), F.col("value")).alias("_whole"))
    raw = {c: F.col(f"_j.{c}") for c in TICK_COLS}
    parsed = {
        "price": _double(raw["price"]),
        "volume": _bigint(raw["volume"]),
        "market_cap": _double(raw["market_cap"]),
    }
    bad_number = F.lit(False)
    for c, v in parsed.items():
        bad_number = bad_number | (raw[c].isNotNull() & v.isNull())
    reject = (F.when(~F.col("_whole"), F.lit(REJECT_MALFORMED))
              .when(bad_number, F.lit(REJECT_BAD_NUMBER)))
    out = []
    for c in TICK_COLS:
        v = parsed.get(c, raw[c])
        out.append(F.coalesce(v, F.lit(TICK_DEFAULTS[c])).alias(c))
    keep = [c for c in ("seq", "key", "value") if c in messages.columns]
    extra = [c for c in ("partition", "arrival_ts") if c in messages.columns]
    return df.select(*[F.col(c) for c in keep + extra], *out, reject.alias("reject"))


def parsed_ticks(parsed: DataFrame) -> DataFrame:
    """rows that parsed — tick columns + ``seq`` (P3 column list)."""
    cols = TICK_COLS + [c for c in ("seq", "partition", "arrival_ts") if c in parsed.columns]
    return parsed.filter(F.col("reject").isNull()).select(*cols)


def quarantined(parsed: DataFrame) -> DataFrame:
    """Complement of F2: ``seq, key, raw value, reason``."""
    cols = [c for c in ("seq", "key") if c in parsed.columns]
    return (parsed.filter(F.col("reject").isNotNull())
            .select(*cols, F.col("value").alias("raw_value"), F.col("reject").alias("reason")))


def observe_parsed(parsed: DataFrame, observation) -> DataFrame:
    """Live ``parsed`` / ``quarantined`` counters of ``parse_messages``
    output, observed in the same pass (see ``observe_published``)."""
    bad = F.col("reject").isNotNull()
    return parsed.observe(observation, F.count_if(~bad).alias("parsed"),
                          F.count_if(bad).alias("quarantined"))


def sink_time() -> Column:
    """``inserted_at`` stamped by a sink: now, truncated to the second, as
    NTZ UTC (the reference table default is ``now()`` at 1 s precision)."""
    return instant_to_utc(F.date_trunc("second", F.current_timestamp()))


def to_bronze(ticks: DataFrame, inserted_at: Column | None = None) -> DataFrame:
    """P3 + K2 projection: parsed ticks -> ``BRONZE`` columns."""
    ins = inserted_at if inserted_at is not None else sink_time()
    df = ticks.withColumn("inserted_at", ins)
    if "seq" not in df.columns:
        df = df.withColumn("seq", F.lit(None).cast("bigint"))
    # a log's partition stays with its offset: offsets are unique in one partition only
    return df.select(*BRONZE_COLS, *(["partition"] if "partition" in df.columns else []))
