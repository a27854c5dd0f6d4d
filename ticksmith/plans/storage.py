"""Storage layout and lifecycle — operators K2-K6, K8-K10.

* ``write_table``: month partitioning (``ym = toYYYYMM``, INT like the
  reference), sort-key layout for Parquet min/max skipping, full rebuild
  (``overwrite``) or dynamic partition overwrite for incremental days.
  Rows are range-partitioned on ``(ym, sort keys)`` before the write, so a
  huge month is split over many tasks (never one task per month) and each
  file covers a narrow, sorted key range.
* ``retain``: keep rows newer than ``as_of - keep`` (the bronze TTL); the
  ``ym`` predicate lets Spark skip whole expired months.
* ``enforce_retention``: apply the TTL to a stored table — rewrite only the
  boundary month, drop older month directories.
* ``between_days``: a day range as both the partition predicate and the row
  predicate (Spark does not derive ``ym`` bounds from a timestamp filter).
* ``work_dir`` / ``materialize``: lineage cuts go to the cluster's shared
  ``spark.checkpoint.dir`` — never a machine-local folder, never
  ``localCheckpoint`` — so a lost executor costs a recompute, not the job.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticksmith.functions.timefn import month_key
from ticksmith.plans.manifest import PART_COL, MonthTable, range_count

# Fixed value: bronze retention (TTL).
BRONZE_RETENTION = "2 years"


def _is_local(spark: SparkSession) -> bool:
    """True for a ``local[...]`` master (read from the session conf, which
    classic and Connect sessions both expose)."""
    try:
        master = spark.conf.get("spark.master", None) or spark.sparkContext.master
    except Exception:
        return False
    return str(master).startswith("local")


def work_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and streaming state.

    Uses ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only
    when neither is set on a ``local[...]`` master — local runs and tests —
    a fresh temp folder is created and registered; on a cluster that is an
    error, never a machine-local folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:   # no driver-side context (e.g. Spark Connect)
            d = None
    if not d:
        if not _is_local(spark):
            raise ValueError("spark.checkpoint.dir is not set: lineage cuts and stream state need "
                             "a folder every executor shares (HDFS or an object store)")
        d = tempfile.mkdtemp(prefix="ticksmith-")
        spark.conf.set("spark.checkpoint.dir", d)
        try:
            spark.sparkContext.setCheckpointDir(d)
        except Exception:
            pass
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared work folder and read it back, so
    several readers share one computation and lineage stops here."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the scratch tables behind ``materialize``d frames once nothing reads them.

    Only folders that ``scratch_path`` made below the work folder are deleted.
    """
    for df in frames:
        spark = df.sparkSession
        root = work_dir(spark).partition(":")[2].lstrip("/") or work_dir(spark).lstrip("/")
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if root in folder and re.fullmatch(r".+-[0-9a-f]{32}", folder.rpartition("/")[2]):
                hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def with_month(df: DataFrame, source_col: str, part_col: str = PART_COL) -> DataFrame:
    """K8: add ``ym = year * 100 + month`` of ``source_col``."""
    return df.withColumn(part_col, month_key(F.col(source_col)))


def write_table(df: DataFrame, path: str, partition_source: str | None = None,
                sort_cols: Sequence[str] = (), mode: str = "overwrite",
                dynamic: bool = False, part_col: str = PART_COL,
                max_records_per_file: int | None = None) -> None:
    """K6 + K8 + K9: write a month-partitioned, key-sorted Parquet table.

    ``dynamic=True`` overwrites only the months present in ``df``.
    """
    spark = df.sparkSession
    if partition_source is not None:
        df = with_month(df, partition_source, part_col)
    keys = [part_col, *sort_cols] if part_col in df.columns else list(sort_cols)
    if keys:
        df = df.repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    w = df.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if part_col in df.columns:
        w = w.partitionBy(part_col)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def published(df: DataFrame, order: Sequence[Column], position: str = "position") -> DataFrame:
    """O1/O2: ``df`` with each row's place (from 1) in the whole order, without one task that holds all rows.

    Rows are ranged on the order, sorted inside each range and stored with the
    row's number there; one small row a range gives the ranges' offsets.  The
    order must be total.
    """
    stored = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("_id", F.monotonically_increasing_id()), "published")
    inside = F.lit(1 << 33)      # an id is its partition's number times this, plus the row's place there
    sizes = stored.groupBy(F.floor(F.col("_id") / inside).alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)     # as many rows as ranges
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (stored.withColumn("_range", F.floor(F.col("_id") / inside)).join(F.broadcast(offsets), "_range")
            .withColumn(position, F.col("_before") + F.col("_id") % inside + 1).select(*df.columns, position))


def table_schema(schema: T.StructType, part_col: str = PART_COL) -> T.StructType:
    """Declared schema plus the INT partition column, for reading back."""
    return T.StructType(schema.fields + [T.StructField(part_col, T.IntegerType())])


def _ts(as_of: date | datetime | str | Column) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def retention_cutoff(as_of: date | datetime | str | Column, keep: str = BRONZE_RETENTION) -> Column:
    return _ts(as_of) - F.expr(f"INTERVAL {keep}")


def _alive(ts_col: str, as_of, keep: str) -> Column:
    return F.col(ts_col) + F.expr(f"INTERVAL {keep}") > _ts(as_of)


def retain(df: DataFrame, as_of: date | datetime | str | Column,
           keep: str = BRONZE_RETENTION, ts_col: str = "inserted_at",
           part_col: str = PART_COL) -> DataFrame:
    """Rows that survive ``TTL ts + keep`` at ``as_of``
    (``ts + keep > as_of``; a leap day expires with 28 February), pruning whole months first when ``df`` is
    month-partitioned."""
    cutoff = retention_cutoff(as_of, keep)
    cond = _alive(ts_col, as_of, keep)
    if part_col in df.columns:
        cond = (F.col(part_col) >= month_key(cutoff)) & cond
    return df.filter(cond)


def between_days(df: DataFrame, first_day: date | str, last_day: date | str,
                 ts_col: str, part_col: str = PART_COL) -> DataFrame:
    """Rows with ``first_day <= ts < last_day + 1``; also bounds ``ym`` so
    the scan prunes month directories."""
    lo = F.lit(str(first_day)).cast("date")
    hi = F.lit(str(last_day)).cast("date")
    cond = ((F.col(ts_col) >= lo.cast("timestamp_ntz"))
            & (F.col(ts_col) < F.date_add(hi, 1).cast("timestamp_ntz")))
    if part_col in df.columns:
        cond = cond & (F.col(part_col) >= month_key(lo)) & (F.col(part_col) <= month_key(hi))
    return df.filter(cond)


def enforce_retention(spark: SparkSession, path: str, schema: T.StructType,
                      as_of: date | datetime | str, keep: str = BRONZE_RETENTION,
                      ts_col: str = "inserted_at", part_col: str = PART_COL,
                      sort_cols: Sequence[str] = ()) -> None:
    """Apply the TTL to a stored month-partitioned table.

    A table with a manifest (``plans.manifest``) changes in one commit.  Of a
    plain one (``write_table``), months wholly older than the cutoff are deleted as directories (no data
    is read); the boundary month is rewritten through a staged copy with
    dynamic partition overwrite; newer months are untouched.
    """
    jvm = spark.sparkContext._jvm
    log = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_spark_metadata")
    if log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(log):
        raise ValueError(f"{path} is a streaming sink output whose commit log lists its files; "
                         "apply retention to the compacted table (compact_months) instead")
    if MonthTable(spark, path, schema, sort_cols, part_col).exists():
        MonthTable(spark, path, schema, sort_cols, part_col).expire(as_of, keep, ts_col)
        return
    full = table_schema(schema, part_col)
    cutoff_row = spark.range(1).select(
        retention_cutoff(as_of, keep).alias("c"), month_key(retention_cutoff(as_of, keep)).alias("m")
    ).first()
    cutoff_ym = int(cutoff_row["m"])
    boundary = (spark.read.schema(full).parquet(path)
                .filter((F.col(part_col) == cutoff_ym) & _alive(ts_col, as_of, keep)))
    staged = scratch_path(spark, "retention")
    boundary.write.mode("overwrite").partitionBy(part_col).parquet(staged)
    kept = spark.read.schema(full).parquet(staged)
    if sort_cols:
        kept = kept.repartitionByRange(part_col, *sort_cols).sortWithinPartitions(part_col, *sort_cols)
    # dynamic overwrite only replaces months present in the new data, so a
    # boundary month with nothing left is removed with the older months
    keep_boundary = kept.limit(1).count() > 0
    if keep_boundary:
        (kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(part_col).parquet(path))
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(hpath):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{part_col}="):
            ym = int(name.split("=", 1)[1])
            if ym < cutoff_ym or (ym == cutoff_ym and not keep_boundary):
                fs.delete(status.getPath(), True)


def _partition_values(spark: SparkSession, path: str, part_col: str = PART_COL) -> list[int]:
    """``ym`` values of a table: those of its manifest, else the directories
    under ``path`` (a listing, no data read); empty when ``path`` does not exist."""
    table = MonthTable(spark, path, T.StructType([]), part_col=part_col)
    if table.exists():
        return sorted(table.state()["months"])
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    out = []
    for status in fs.listStatus(hpath):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{part_col}="):
            out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def _month_files(df: DataFrame, part_col: str) -> list[tuple[int, str]]:
    """(month, file) of the files that ``df``, a scan of a month-partitioned table, reads."""
    found = []
    for f in df.inputFiles():
        month = f.rpartition(f"/{part_col}=")[2].partition("/")[0]
        if month.isdigit():
            found.append((int(month), f))
    return found


def compact_months(spark: SparkSession, stream_path: str, table_path: str, schema: T.StructType,
                   first_month: int, last_month: int, sort_cols: Sequence[str],
                   part_col: str = PART_COL, as_of: date | None = None) -> None:
    """Rewrite months ``first_month..last_month`` of a streaming file-sink
    output into a key-sorted table of atomic month versions (``MonthTable``).

    A stream appends small, unsorted files per micro-batch; compaction of
    closed months restores the sort-key layout (K9) that Parquet min/max
    skipping needs, the way the reference's storage engine merges parts in
    the background.  The stream output is read through the sink's commit
    log (committed files only) and left alone: its commit log owns those files.

    The stream files that went into the months are listed beside the table
    (``<table>.sources/<id>``), and the manifest names that list with each month
    in the same commit that makes the new version current.  So files that the
    stream commits to a compacted month afterwards are still read, each once;
    the next compaction takes them in; and a run broken off at any step changes nothing.
    A month that isn't over at ``as_of`` (default: today, UTC) is refused.
    """
    today = as_of or datetime.now(timezone.utc).date()
    if last_month >= today.year * 100 + today.month:
        raise ValueError(f"month {last_month} isn't over on {today}: only closed months are compacted")
    live = spark.read.schema(table_schema(schema, part_col)).parquet(stream_path)
    taken = [(m, f) for m, f in _month_files(live, part_col) if first_month <= m <= last_month]
    if not taken:
        return
    note = uuid.uuid4().hex
    spark.createDataFrame(taken, f"{part_col} int, file string").write.parquet(f"{table_path.rstrip('/')}.sources/{note}")
    # the very files that are noted: what the stream commits meanwhile stays its own
    rows = spark.read.schema(table_schema(schema, part_col)).option("basePath", stream_path).parquet(*(f for _, f in taken))
    MonthTable(spark, table_path, schema, sort_cols, part_col).replace(
        rows, sorted({m for m, _ in taken}), taken={m: note for m, _ in taken}, ranges=_ranges(spark, [f for _, f in taken], rows.count()))


def _ranges(spark: SparkSession, files: Sequence[str], n_rows: int) -> int:
    """Ranges for a rewrite of these files and their rows (a count that reads only the files' footers)."""
    conf, size = spark.sparkContext._jsc.hadoopConfiguration(), 0
    for f in files:
        hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)
        size += hpath.getFileSystem(conf).getFileStatus(hpath).getLen()
    return range_count(size, n_rows)


def read_compacted(spark: SparkSession, stream_path: str, table_path: str, schema: T.StructType,
                   part_col: str = PART_COL) -> DataFrame:
    """One relation over a compacted table and its stream output: months that
    the table's manifest names come from there, every other month from the
    stream.  Both sides carry a ``ym`` predicate (one value per month), so
    each scan prunes to its own months.  Stream files of a compacted month
    that its compaction didn't take in are read too, and only those; the lists
    of files are as long as the ones Spark's own scan of the stream holds."""
    full = table_schema(schema, part_col)
    table = MonthTable(spark, table_path, schema, part_col=part_col)
    state = table.state()
    done = sorted(state["months"])
    live = spark.read.schema(full).parquet(stream_path)
    if not done:
        return live
    both = table.read(state=state).unionByName(live.filter(~F.col(part_col).isin(done)))
    notes = sorted({v["taken"] for v in state["months"].values() if v["taken"]})
    taken: set[tuple[int, str]] = set()
    for note in notes:
        listed = spark.read.schema(f"{part_col} int, file string").parquet(f"{table_path.rstrip('/')}.sources/{note}")
        taken |= {(r[part_col], r["file"]) for r in listed.toLocalIterator() if state["months"].get(r[part_col], {}).get("taken") == note}
    late = [f for m, f in _month_files(live, part_col) if m in done and (m, f) not in taken]
    if late:
        both = both.unionByName(spark.read.schema(full).option("basePath", stream_path).parquet(*late))
    return both
