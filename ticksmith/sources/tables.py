"""Parquet table readers.

Readers take an explicit column list so the scan's ``ReadSchema`` is narrow
from the start; Catalyst would prune anyway, but an explicit list keeps the
intent visible and protects callers that ``select *`` downstream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, base: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """Read ``<base>/<name>.parquet`` (a file or a directory of parts)."""
    df = spark.read.parquet(table_path(base, name))
    return df.select(*columns) if columns else df


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a table written by ``plans.storage.write_table`` with its declared
    schema, so the partition column keeps its declared type instead of the
    inferred one."""
    return spark.read.schema(schema).parquet(path)
