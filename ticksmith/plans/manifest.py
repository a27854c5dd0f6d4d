"""Month tables with atomic versions.

A table is a folder ``ym=<month>/version=<id>/part-*`` plus ``_manifest/<n>``,
small JSON files.  The newest complete manifest names the current version of
every month; nothing else is read.  A change writes new versions first, which
no reader sees, and then one manifest: that single file is the commit, so a
run that breaks off at any step leaves the table as it was, and a repeated
run is a new version, never a second copy of rows.

The manifest is created exclusively (two writers that start from one state:
the second fails with ``CommitConflict``) and counts only when its JSON is
whole, so a writer that dies inside the commit changes nothing either.
``vacuum`` deletes the versions that the last two manifests don't name;
readers that resolved an older state must be done by then.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticksmith.functions.timefn import month_key
from ticksmith.schemas import conform

PART_COL = "ym"
VERSION_COL = "version"
# Bytes of stored input for one range of a rewritten month; a file holds one range.
RANGE_BYTES = 256 << 20
# Rows of one range: a task sorts them in memory, where compressed rows are many times their stored size.
RANGE_ROWS = 1 << 20


class CommitConflict(RuntimeError):
    """Another writer has committed since this one read the state."""


def range_count(size: int, n_rows: int) -> int:
    """Ranges for a rewrite of so many stored bytes and rows: none is above RANGE_BYTES or RANGE_ROWS by much."""
    return max(1, -(-size // RANGE_BYTES), -(-n_rows // RANGE_ROWS))


class MonthTable:
    """A month-partitioned, key-sorted Parquet table whose months change atomically."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, sort_cols: Sequence[str] = (),
                 part_col: str = PART_COL):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.sort_cols, self.part_col = list(sort_cols), part_col
        self.full = T.StructType([*schema.fields, T.StructField(part_col, T.IntegerType())])

    # ------------------------------------------------------------ state

    def _at(self, *names: str):
        jvm = self.spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))
        return hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hpath

    def _manifests(self) -> list[int]:
        fs, folder = self._at("_manifest")
        if not fs.exists(folder):
            return []
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(folder) if s.getPath().getName().isdigit())

    def _load(self, number: int) -> dict | None:
        fs, at = self._at("_manifest", str(number))
        stream = fs.open(at)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            found = json.loads(text)
        except ValueError:     # its writer died: not a commit
            return None
        return {"months": {int(m): v for m, v in found["months"].items()}, "notes": found["notes"]}

    def state(self) -> dict:
        """``months`` ({month: {"version", "taken"}}), ``notes``, and ``last``, the newest manifest's number."""
        numbers = self._manifests()
        for n in reversed(numbers):
            found = self._load(n)
            if found is not None:
                return {**found, "last": numbers[-1]}
        return {"months": {}, "notes": {}, "last": numbers[-1] if numbers else 0}

    def exists(self) -> bool:
        return bool(self._manifests())

    # ------------------------------------------------------------ reading

    def read(self, months: Iterable[int] | None = None, state: dict | None = None) -> DataFrame:
        """The current rows (declared columns and the month), of the given months only.

        Files of one month are found without listing the others.
        """
        state = state or self.state()
        wanted = sorted(state["months"] if months is None else set(months) & set(state["months"]))
        versioned = T.StructType([*self.full.fields, T.StructField(VERSION_COL, T.StringType())])
        if not wanted:
            return self.spark.createDataFrame([], self.full)
        paths = [f"{self.path}/{self.part_col}={m}/{VERSION_COL}={state['months'][m]['version']}" for m in wanted]
        df = self.spark.read.schema(versioned).option("basePath", self.path).parquet(*paths)
        return df.filter(F.col(self.part_col).isin(wanted)).select(*self.full.fieldNames())

    # ------------------------------------------------------------ writing

    def write(self, df: DataFrame, ranges: int | None = None,
              observe: tuple[Observation, list[Column]] | None = None) -> tuple[str, list[int]]:
        """Step one: rows (with the month column) as a new version of their months, seen by nobody yet.

        The rows are conformed to the declared schema and ranged on (month, sort
        keys): by ``ranges``, else as many as the session shuffles into, where
        adaptive execution merges small neighbours.  A hash of the row is the last key
        of the ranges, so that rows of one hot sort key are split too.  ``observe`` counts while
        the sorted rows go to the writer, so each row is counted once.
        """
        version = uuid.uuid4().hex
        keys = [self.part_col, *self.sort_cols]
        rows = conform(df, self.full)
        by = [*keys, F.xxhash64(*rows.columns)]
        parted = rows.repartitionByRange(ranges, *by) if ranges else rows.repartitionByRange(*by)
        final = parted.sortWithinPartitions(*keys)
        if observe and observe[1]:
            final = final.observe(observe[0], *observe[1])
        (final.withColumn(VERSION_COL, F.lit(version))
         .write.mode("append").partitionBy(self.part_col, VERSION_COL).parquet(self.path))
        return version, [m for m in self._folders() if self._holds(m, version)]

    def _folders(self) -> list[int]:
        fs, at = self._at()
        if not fs.exists(at):
            return []
        names = (s.getPath().getName() for s in fs.listStatus(at) if s.isDirectory())
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{self.part_col}="))

    def _holds(self, month: int, version: str) -> bool:
        fs, at = self._at(f"{self.part_col}={month}", f"{VERSION_COL}={version}")
        return fs.exists(at)

    def commit(self, state: dict, months: dict[int, dict | None], notes: dict | None = None) -> None:
        """Step two: the manifest after ``state`` in which ``months`` have new versions, or (None) are gone."""
        merged = {**state["months"], **months}
        text = json.dumps({"months": {str(m): v for m, v in sorted(merged.items()) if v is not None},
                           "notes": state["notes"] if notes is None else notes})
        fs, at = self._at("_manifest", str(state["last"] + 1))
        if fs.exists(at):
            raise CommitConflict(f"{self.path}: manifest {state['last'] + 1} exists")
        try:
            out = fs.create(at, False)
        except Exception as e:
            raise CommitConflict(f"{self.path}: manifest {state['last'] + 1} exists") from e
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def replace(self, df: DataFrame, months: Sequence[int] | None = None, taken: dict[int, str] | None = None,
                notes: dict | None = None, ranges: int | None = None,
                observe: tuple[Observation, list[Column]] | None = None) -> None:
        """Months become the rows of ``df`` in one commit; those without rows are gone.

        ``months`` None: the whole table.  ``taken`` is noted with each month.
        """
        state = self.state()
        version, found = self.write(df, ranges, observe)
        gone = set(state["months"] if months is None else months) - set(found)
        self.commit(state, {**{m: None for m in gone},
                            **{m: {"version": version, "taken": (taken or {}).get(m)} for m in found}}, notes)

    def expire(self, as_of: date | datetime | str, keep: str, ts_col: str) -> None:
        """Rows past ``ts + keep`` go, in one commit.

        Months wholly past it leave the manifest unread; the boundary month is
        written anew, sorted like any other.
        """
        from ticksmith.plans.storage import _alive, retention_cutoff
        state = self.state()
        cutoff = retention_cutoff(as_of, keep)
        edge = int(self.spark.range(1).select(month_key(cutoff).alias("m")).first()["m"])
        changed: dict[int, dict | None] = {m: None for m in state["months"] if m < edge}
        if edge in state["months"]:
            held = self.read([edge], state)
            version, found = self.write(held.filter(_alive(ts_col, as_of, keep)), self._ranges([edge], state))
            changed[edge] = {**state["months"][edge], "version": version} if found else None
        if changed:
            self.commit(state, changed)

    def _ranges(self, months: Sequence[int], state: dict) -> int:
        size = 0
        for m in months:
            fs, at = self._at(f"{self.part_col}={m}", f"{VERSION_COL}={state['months'][m]['version']}")
            size += fs.getContentSummary(at).getLength()
        return range_count(size, self.read(months, state).count())     # counted in the files' footers

    def vacuum(self) -> int:
        """Delete versions and manifests that the last two complete manifests don't need; returns how many versions."""
        numbers = self._manifests()
        whole = [(n, s) for n in numbers[::-1] if (s := self._load(n)) is not None][:2]
        kept = {(m, v["version"]) for _, s in whole for m, v in s["months"].items()}
        gone = 0
        for m in self._folders():
            fs, folder = self._at(f"{self.part_col}={m}")
            for s in list(fs.listStatus(folder)):
                name = s.getPath().getName()
                if name.startswith(f"{VERSION_COL}=") and (m, name.partition("=")[2]) not in kept:
                    fs.delete(s.getPath(), True)
                    gone += 1
            if not list(fs.listStatus(folder)):
                fs.delete(folder, True)
        for n in numbers:
            if whole and n < whole[-1][0]:
                fs, at = self._at("_manifest", str(n))
                fs.delete(at, False)
        return gone
