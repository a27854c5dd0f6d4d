"""Declarative data-quality checks — operators Q1-Q5.

A check is data: ``Check(table, column, kind, ...)``.  ``run_checks``
compiles every check of one table into a single aggregation (one
``count_if`` per check, partial-aggregated per task) and unpivots the
counters into rows ``(table_name, column_name, check_name, failures,
severity)`` — one scan per table instead of one query per check.
``failing_rows`` returns the offending rows themselves, again one scan per
table.

Semantics follow the reference's test kinds: ``not_null`` fails on NULL;
``accepted_range`` and ``accepted_values`` let NULL pass; NaN is out of any
range (it fails every comparison in the reference engines, but compares
greater than everything in Spark).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ticksmith.functions.numeric import in_range

NOT_NULL = "not_null"
ACCEPTED_RANGE = "accepted_range"
ACCEPTED_VALUES = "accepted_values"


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    kind: str
    min_value: float | None = None
    max_value: float | None = None
    inclusive: bool = True
    values: tuple[str, ...] = ()
    severity: str = "warn"   # Q5: checks report, they do not block

    def fails(self) -> Column:
        c = F.col(self.column)
        if self.kind == NOT_NULL:
            return c.isNull()
        if self.kind == ACCEPTED_RANGE:
            return F.coalesce(~in_range(c, self.min_value, self.max_value, self.inclusive), F.lit(False))
        if self.kind == ACCEPTED_VALUES:
            return F.coalesce(~c.isin(list(self.values)), F.lit(False))
        raise ValueError(f"unknown check kind {self.kind!r}")


# The reference's 22 declared checks (17 not_null,
# 4 accepted_range, 1 accepted_values), by table.
REFERENCE_CHECKS: tuple[Check, ...] = (
    Check("raw_ticks", "ticker", NOT_NULL),
    Check("raw_ticks", "price", NOT_NULL),
    Check("raw_ticks", "fetched_at", NOT_NULL),
    Check("ohlcv_5min", "ticker", NOT_NULL),
    Check("ohlcv_5min", "window_start", NOT_NULL),
    Check("ohlcv_5min", "close_price", NOT_NULL),
    Check("stg_ticks", "ticker", NOT_NULL),
    Check("stg_ticks", "price", NOT_NULL),
    Check("stg_ticks", "price", ACCEPTED_RANGE, min_value=0, inclusive=False),
    Check("stg_bars", "ticker", NOT_NULL),
    Check("stg_bars", "tick_count", ACCEPTED_RANGE, min_value=1),
    Check("daily_summary", "trade_date", NOT_NULL),
    Check("daily_summary", "ticker", NOT_NULL),
    Check("daily_summary", "open_price", NOT_NULL),
    Check("daily_summary", "open_price", ACCEPTED_RANGE, min_value=0, inclusive=False),
    Check("daily_summary", "close_price", NOT_NULL),
    Check("daily_summary", "pct_change", NOT_NULL),
    Check("top_movers", "trade_date", NOT_NULL),
    Check("top_movers", "direction", NOT_NULL),
    Check("top_movers", "direction", ACCEPTED_VALUES, values=("gainer", "loser")),
    Check("top_movers", "rank", NOT_NULL),
    Check("top_movers", "rank", ACCEPTED_RANGE, min_value=1, max_value=5),
)


def retarget(checks: Iterable[Check], source: str, target: str) -> tuple[Check, ...]:
    """The checks declared for table ``source``, pointed at ``target`` —
    e.g. the staging checks run over the parsed feed before staging filters
    it, to count what staging will drop."""
    return tuple(replace(ch, table=target) for ch in checks if ch.table == source)


def _by_table(checks: Iterable[Check]) -> dict[str, list[Check]]:
    out: dict[str, list[Check]] = {}
    for ch in checks:
        out.setdefault(ch.table, []).append(ch)
    return out


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_checks(tables: Mapping[str, DataFrame],
               checks: Iterable[Check] = REFERENCE_CHECKS) -> DataFrame:
    """Q1-Q3 + Q5: failure counts per check, one aggregation per table."""
    parts = []
    for table, chs in _by_table(checks).items():
        df = tables[table]
        counts = df.agg(*[F.count_if(ch.fails()).alias(f"_c{i}") for i, ch in enumerate(chs)])
        rows = F.array(*[F.struct(F.lit(ch.table).alias("table_name"),
                                  F.lit(ch.column).alias("column_name"),
                                  F.lit(ch.kind).alias("check_name"),
                                  F.col(f"_c{i}").cast("bigint").alias("failures"),
                                  F.lit(ch.severity).alias("severity"))
                         for i, ch in enumerate(chs)])
        parts.append(counts.select(F.inline(rows)))
    return _union(parts)


def failing_rows(tables: Mapping[str, DataFrame],
                 checks: Iterable[Check] = REFERENCE_CHECKS) -> DataFrame:
    """Rows that fail a check: ``table_name, column_name, check_name,
    row_json`` — one scan per table, one output row per (row, failed check)."""
    parts = []
    for table, chs in _by_table(checks).items():
        df = tables[table]
        payload = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
        tags = F.array(*[F.when(ch.fails(), F.struct(F.lit(ch.column).alias("column_name"),
                                                     F.lit(ch.kind).alias("check_name")))
                         for ch in chs])
        tagged = (df.select(payload.alias("row_json"), F.filter(tags, lambda x: x.isNotNull()).alias("_f"))
                  .filter(F.size("_f") > 0))
        parts.append(tagged.select(F.lit(table).alias("table_name"), F.explode("_f").alias("_t"), "row_json")
                     .select("table_name", "_t.column_name", "_t.check_name", "row_json"))
    return _union(parts)


def blocking_failures(results: DataFrame) -> DataFrame:
    """Checks with ``severity = 'error'`` that failed (empty for warn-only)."""
    return results.filter((F.col("severity") == "error") & (F.col("failures") > 0))


def counters(table: str, checks: Iterable[Check] = REFERENCE_CHECKS) -> list[Column]:
    """The failure counts of one table's checks as aggregates, for ``DataFrame.observe``."""
    return [F.count_if(ch.fails()).alias(f"_c{i}") for i, ch in enumerate(_by_table(checks).get(table, []))]


def observed_checks(spark: SparkSession, observed: Mapping[str, Observation],
                    checks: Iterable[Check] = REFERENCE_CHECKS) -> DataFrame:
    """``run_checks`` of the tables that were written under ``observed``: the counts come from the write pass itself.

    One small row a check; no table is scanned.
    """
    rows = [(ch.table, ch.column, ch.kind, int(observed[table].get[f"_c{i}"]), ch.severity)
            for table, chs in _by_table(checks).items() if table in observed for i, ch in enumerate(chs)]
    return spark.createDataFrame(rows, "table_name string, column_name string, check_name string, failures bigint, severity string")
