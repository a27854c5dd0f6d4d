"""Time expressions that do not depend on the session time zone.

Batch results are kept in TIMESTAMP_NTZ holding **UTC wall-clock** time, so a
result is the same whatever ``spark.sql.session.timeZone`` the caller runs
with.  Several built-ins silently cast NTZ to the session-zone TIMESTAMP
(``date_trunc``, ``date_format``, ``timestampdiff``); the helpers here avoid
those paths:

* ``ntz - TIMESTAMP_NTZ'1970-01-01'`` is a zone-free interval, cast to
  seconds it gives epoch micros; buckets are integer arithmetic on those;
* ``convert_timezone(src, dst, ntz)`` moves wall clock between named zones;
* text comes from ``CAST(ntz AS STRING)``, which is zone-free.

Each helper reads its input column once (``iso_text`` at most three
times).  That matters: Catalyst pushes filters through projections by
inlining the projected expressions, so a helper that read its input many
times would multiply an expensive input (e.g. a parsed string) inside the
pushed-down predicate.

Strings with an explicit offset (``2026-04-21T10:15:00.123456+03:00``) are
parsed with ``try_cast(... AS TIMESTAMP)``, which is exact; junk gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: trading venue zone (UTC+3, no daylight saving).
NAIROBI = "Africa/Nairobi"

# Trading session 09:00 <= local time < 15:30, Monday-Friday.
SESSION_OPEN_MINUTE = 9 * 60
SESSION_CLOSE_MINUTE = 15 * 60 + 30

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

_UNIT_MICROS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000,
                "minute": 60_000_000, "hour": 3_600_000_000, "day": 86_400_000_000}


def width_micros(width: str) -> int:
    """'5 minutes' -> 300000000 (fixed-length units only)."""
    n, unit = width.strip().split()
    unit = unit.lower().rstrip("s")
    return int(n) * _UNIT_MICROS[unit]


def ntz_micros(c: Column) -> Column:
    """Epoch microseconds of an NTZ value read as UTC (BIGINT).

    ``ts - epoch`` between two NTZ values is a zone-free DAY TO SECOND
    interval; its seconds (DECIMAL, 6 places) times 10^6 are the micros.
    ``c`` is referenced once.
    """
    secs = (c - F.expr(_EPOCH)).cast("interval second").cast("decimal(20,6)")
    return (secs * F.lit(1_000_000)).cast("bigint")


def micros_to_ntz(us: Column) -> Column:
    """Epoch microseconds -> NTZ UTC wall clock."""
    return F.timestamp_add("MICROSECOND", us, F.expr(_EPOCH))


def wall_to_instant(c: Column, tz: str = "UTC") -> Column:
    """Read an NTZ wall-clock value as local time in ``tz`` -> TIMESTAMP."""
    return F.timestamp_micros(ntz_micros(local_to_utc(c, tz) if tz != "UTC" else c))


def instant_to_utc(c: Column) -> Column:
    """TIMESTAMP (instant) -> NTZ UTC wall clock."""
    return micros_to_ntz(F.unix_micros(c))


def utc_to_local(c: Column, tz: str) -> Column:
    """NTZ UTC wall clock -> NTZ wall clock in ``tz``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), c)


def local_to_utc(c: Column, tz: str) -> Column:
    """NTZ wall clock in ``tz`` -> NTZ UTC wall clock."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), c)


# A date and time to the minute at least, and the same with nothing behind it.
_FULL = r"^\s*\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{2}"
_BARE = _FULL + r"(:\d{1,2}(\.\d*)?)?\s*$"
# Zone of a text that names none: the servers of the feed run on UTC.
DEFAULT_ZONE = "UTC"


def parse_instant(s: Column, zone: str = DEFAULT_ZONE) -> Column:
    """ISO-8601 text -> TIMESTAMP; NULL for junk, '' and texts without a full date and time.

    Text without an offset is read in ``zone``, whatever the session's zone is.
    """
    seconds = F.when(s.rlike(_FULL + r"\s*$"), F.lit(":00")).otherwise(F.lit(""))   # a zone needs them before it
    whole = F.when(s.rlike(_BARE), F.concat(F.trim(s), seconds, F.lit(f" {zone}"))).when(s.rlike(_FULL), s)
    return whole.try_cast("timestamp")


def parse_to_utc(s: Column, zone: str = DEFAULT_ZONE) -> Column:
    """ISO-8601 text -> NTZ UTC wall clock (``parseDateTime64BestEffort``)."""
    return instant_to_utc(parse_instant(s, zone))


def local_date(utc: Column, tz: str) -> Column:
    """Calendar date in ``tz`` of an NTZ UTC instant (``toDate`` in a zone)."""
    return F.to_date(utc_to_local(utc, tz))


def floor_time(c: Column, width: str) -> Column:
    """Start of the epoch-aligned bucket of ``width`` (e.g. '1 minute'),
    by integer arithmetic on epoch micros (zone-free, ``c`` read once)."""
    w = F.lit(width_micros(width))
    return micros_to_ntz(F.floor(ntz_micros(c) / w).cast("bigint") * w)


def month_key(c: Column) -> Column:
    """``toYYYYMM``: year * 100 + month as INT, zone-free on NTZ and DATE."""
    return (F.year(c) * 100 + F.month(c)).cast("int")


def _two_digits(n: Column) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


def iso_text(local: Column, utc: Column) -> Column:
    """``isoformat()`` text from a local wall clock and the same instant in
    UTC: ``YYYY-MM-DDTHH:MM:SS[.ffffff]+HH:MM``, the fraction left out when
    it is zero, exactly as Python does.  Pass attributes for ``local`` /
    ``utc``; ``local`` is read three times, ``utc`` once.
    """
    base = F.translate(F.substring(local.cast("string"), 1, 19), " ", "T")
    # micros within the second survive any zone shift (offsets are whole
    # seconds), so the session-zone cast is harmless here
    frac = F.nullif(F.pmod(F.unix_micros(local.cast("timestamp")), F.lit(1_000_000)), F.lit(0))
    frac_txt = F.coalesce(F.concat(F.lit("."), F.lpad(frac.cast("string"), 6, "0")), F.lit(""))
    off = (local - utc).cast("interval minute").cast("int")
    sign = F.when(off < 0, F.lit("-")).otherwise(F.lit("+"))
    off_txt = F.concat(sign, _two_digits((F.abs(off) / 60).cast("int")), F.lit(":"), _two_digits(F.abs(off) % 60))
    return F.concat(base, frac_txt, off_txt)


def iso_local(utc: Column, tz: str) -> Column:
    """``datetime.now(tz).isoformat()`` text for an NTZ UTC instant."""
    return iso_text(utc_to_local(utc, tz), utc)


def in_session(utc: Column, tz: str = NAIROBI,
               open_minute: int = SESSION_OPEN_MINUTE,
               close_minute: int = SESSION_CLOSE_MINUTE) -> Column:
    """Trading-session predicate on an NTZ UTC instant.

    Monday-Friday and ``open <= local minute-of-day < close``; no holiday
    calendar (none exists in the reference either).  Written on the local
    minute-of-week (1970-01-01 was a Thursday, so Monday 00:00 is epoch
    minute 4 * 1440) so the local time is computed once.
    """
    minute = F.floor(ntz_micros(utc_to_local(utc, tz)) / F.lit(60_000_000))
    mow = F.pmod(minute.cast("bigint") + F.lit(3 * 1440), F.lit(7 * 1440))
    return (F.pmod(mow, F.lit(1440)).between(open_minute, close_minute - 1)) & (mow < 5 * 1440)


def epoch_order_key(ts_micros: Column, seq: Column, partition: Column | None = None) -> Column:
    """Pack (timestamp micros, non-negative sequence) into DECIMAL(38,0).

    ``ts * 10^19 + seq`` orders exactly like the pair (for any BIGINT micros
    and 0 <= seq < 10^19), and being a single fixed-width value it keeps
    ``min_by``/``max_by`` on Spark's HashAggregate path (a STRUCT ordering
    forces SortAggregate, i.e. a sort of every row before the shuffle).

    With ``partition`` it orders like (timestamp, partition, sequence), for times up to
    the year 9999, partitions below 10^5 and offsets below 10^15; a null
    partition counts as 0, and then any sequence below 10^19 fits.
    """
    def power(n: int) -> Column:
        return F.expr(f"CAST(1{'0' * n} AS DECIMAL(38,0))")

    low = seq.cast("decimal(38,0)")
    if partition is None:
        return ts_micros.cast("decimal(38,0)") * power(19) + low
    place = F.coalesce(partition, F.lit(0)).cast("decimal(38,0)") * power(15)
    return ts_micros.cast("decimal(38,0)") * power(20) + place + low
