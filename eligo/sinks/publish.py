"""Write-audit-publish of state batches (D06, D08, C13) and compaction.

A state table is a directory of ``batch_id=N`` partitions plus a small batch
log.  A batch is written in full, audited with Spark aggregates, and becomes
current only when its row is appended to the log: readers take the largest
logged ``batch_id``.  A failed or half-written batch is never logged, so it is
invisible, and a re-run overwrites it.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import asdict, dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eligo.operators.joins import DEFAULT_BROADCAST_BYTES, key_set, semi_join, split_null_keys
from eligo.schemas import KEY_COLS, STATE_COLS
from eligo.session import materialize
from eligo.sources.tables import read_parquet_or_none

LOG_SCHEMA = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("rows", T.LongType()),
    T.StructField("update_rows", T.LongType()),
    T.StructField("carried_rows", T.LongType()),
    T.StructField("previous_batch_id", T.LongType()),
    T.StructField("published_at", T.StringType()),
    T.StructField("note", T.StringType()),
])


class AuditError(RuntimeError):
    pass


def batch_path(state_path: str, batch_id: int) -> str:
    return f"{state_path.rstrip('/')}/batch_id={batch_id}"


def logged_batches(spark: SparkSession, log_path: str) -> DataFrame | None:
    return read_parquet_or_none(spark, log_path)


def last_logged_batch(spark: SparkSession, log_path: str) -> int | None:
    log = logged_batches(spark, log_path)
    if log is None:
        return None
    return log.agg(F.max("batch_id").alias("m")).first()["m"]


def read_batch(spark: SparkSession, state_path: str, batch_id: int,
               columns: list[str] | None = STATE_COLS) -> DataFrame:
    """One batch, read from its own directory (no listing of other batches)."""
    df = spark.read.option("basePath", state_path).parquet(batch_path(state_path, batch_id))
    df = df.withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return df.select(*columns) if columns else df


def read_current(spark: SparkSession, table_path: str, log_path: str,
                 columns: list[str] | None = None) -> DataFrame | None:
    """The last published version of a log-committed table, or ``None``."""
    v = last_logged_batch(spark, log_path)
    return None if v is None else read_batch(spark, table_path, v, columns)


def commit_version(spark: SparkSession, log_path: str, version: int, rows: int,
                   previous: int | None, note: str = "") -> None:
    """Append the log row that makes ``version`` current."""
    row = (version, rows, None, None, previous,
           _dt.datetime.now(_dt.timezone.utc).isoformat(), note)
    spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(log_path)


def write_batch(df: DataFrame, state_path: str, batch_id: int, partition_cols=()) -> None:
    """Write the rows of one batch to ``batch_id=N`` (replacing an unlogged attempt), in directories below it by
    ``partition_cols`` (sorted within each task, so a task has one file open)."""
    rows = df.where(F.col("batch_id") == batch_id).drop("batch_id")
    if partition_cols:
        rows = rows.sortWithinPartitions(*partition_cols)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_cols).parquet(
        batch_path(state_path, batch_id))


@dataclass
class BatchAudit:
    batch_id: int
    rows: int
    update_rows: int
    carried_rows: int
    previous_rows: int
    previous_rows_replaced: int
    written_rows_of_updated_keys: int
    null_key_rows: int
    updated_keys_with_several_rows: int = 0   # ties beyond uses; reported, not a failure
    update_row_copies: int = 0                # update rows beyond the distinct ones; reported too

    def problems(self) -> list[str]:
        out = []
        if self.rows != self.update_rows + self.previous_rows - self.previous_rows_replaced:
            out.append("rows != updates + previous rows that were not replaced")
        if self.carried_rows != self.previous_rows - self.previous_rows_replaced:
            out.append("carried rows do not equal previous rows minus replaced ones")
        if self.written_rows_of_updated_keys != self.update_rows:
            out.append("an updated key also has carried rows")
        return out


def _key_profile(df: DataFrame, ks) -> tuple[int, int, int]:
    """(rows, rows whose key is in the key set, rows with a NULL key).

    Rows with a NULL key are in no key set; they are counted before the join and stay out
    of it, so past the broadcast limit they do not all hash to one task.
    """
    any_null = F.lit(False)
    for k in ks.keys:
        any_null = any_null | F.col(k).isNull()
    keys = df.select(*ks.keys)
    r = keys.agg(F.count(F.lit(1)).alias("n"), F.count_if(any_null).alias("nulls")).first()
    hits = keys.where(~any_null).join(ks.frame.select(*ks.keys), list(ks.keys), "left_semi").count()
    return int(r["n"]), hits, int(r["nulls"])


def audit_batch(spark: SparkSession, state_path: str, batch_id: int,
                updates: DataFrame, previous: DataFrame | None,
                max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> BatchAudit:
    """Exact invariants of a written batch, from one keys-only pass over the
    written batch and one over the previous batch.  Each figure is counted on its own:

    * rows (written) = update rows (stored pairs) + previous rows whose key was not updated,
    * carried rows (written, key not updated) = previous rows whose key was not updated,
    * rows of the written batch whose key was updated = update rows
      (no key is both updated and carried).
    """
    ks = key_set(updates, KEY_COLS, max_broadcast_bytes)
    written = read_batch(spark, state_path, batch_id)
    rows, written_updated, null_keys = _key_profile(written, ks)
    update_rows = updates.count()
    multi, copies = _repeats(updates)
    prev_rows, prev_replaced = 0, 0
    if previous is not None:
        prev_rows, prev_replaced, _ = _key_profile(previous, ks)
    return BatchAudit(batch_id, rows, update_rows, rows - written_updated, prev_rows,
                      prev_replaced, written_updated, null_keys, multi, copies)


@dataclass
class WriteCounts:
    """What one write put into a batch, counted while it was written."""

    rows: int
    update_rows: int
    carried_rows: int
    null_key_rows: int


def observed_write(updates: DataFrame, carried: DataFrame, write) -> WriteCounts:
    """``write(rows, watch)`` the union of both, counting its rows on the way (C13): no read of the written batch is needed for them.

    ``write`` applies ``watch`` after its last shuffle, so the counts belong to the tasks of the write itself, and an
    attempt that is lost or repeated counts once.
    """
    labelled = updates.withColumn("_update", F.lit(True)).unionByName(carried.withColumn("_update", F.lit(False)))
    any_null = F.lit(False)
    for k in KEY_COLS:
        any_null = any_null | F.col(k).isNull()
    seen = Observation()
    write(labelled, lambda rows: rows.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if("_update").alias("update_rows"),
        F.count_if(~F.col("_update")).alias("carried_rows"), F.count_if(any_null).alias("null_key_rows")).drop("_update"))
    return WriteCounts(**{k: int(v or 0) for k, v in seen.get.items()})


def audit_observed(counts: WriteCounts, written: DataFrame, updates: DataFrame, touched: DataFrame | None, previous_rows: int,
                   batch_id: int, max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> BatchAudit:
    """The audit of a batch whose write was observed: the counts are there, and what remains is one keys-only read of
    the written batch, to see that no key is both updated and carried.

    ``touched`` are the previous rows that share a key with the increment (stored when it was classified); those whose
    key was updated are the replaced ones, so the previous batch is not read again.  ``previous_rows`` is in the batch log.
    """
    ks = key_set(updates, KEY_COLS, max_broadcast_bytes)
    keys = written.select(*KEY_COLS)
    if ks.bitmap is not None:
        keys, _ = ks.bitmap.split(keys)
    written_updated = keys.join(ks.frame, KEY_COLS, "left_semi").count()
    replaced = 0
    if touched is not None:
        replaced = touched.select(*KEY_COLS).join(ks.frame, KEY_COLS, "left_semi").count()
    several, copies = _repeats(updates)
    return BatchAudit(batch_id, counts.rows, counts.update_rows, counts.carried_rows, previous_rows, replaced,
                      written_updated, counts.null_key_rows, several, copies)


def _repeats(updates: DataFrame) -> tuple[int, int]:
    """(keys with several update rows, update rows beyond the distinct ones).

    Copies share their key, so whole rows are compared only among the rows of such keys.  Rows with a NULL key (equal
    keys here) are compared without the join, where they would share one task.
    """
    several = materialize(updates.groupBy(*KEY_COLS).count().where(F.col("count") > 1).select(*KEY_COLS), "several-keys")
    n = several.count()
    if n == 0:
        return 0, 0
    keyed, unkeyed = split_null_keys(updates, KEY_COLS)
    rows = semi_join(keyed, several, KEY_COLS).unionByName(unkeyed)
    distinct = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    copies = distinct.agg(F.sum(F.col("_n") - 1).alias("copies")).first()["copies"]
    return n, int(copies or 0)


def logged_rows(spark: SparkSession, log_path: str, batch_id: int) -> int:
    """Rows of a published batch, from the log."""
    return int(logged_batches(spark, log_path).where(F.col("batch_id") == batch_id).agg(F.max("rows")).first()[0])


def publish(spark: SparkSession, log_path: str, audit: BatchAudit,
            previous_batch_id: int | None, note: str = "") -> None:
    """Commit a batch: fail on audit problems, else append its log row."""
    problems = audit.problems()
    if problems:
        raise AuditError(f"batch {audit.batch_id} not published: {problems}; {asdict(audit)}")
    row = (audit.batch_id, audit.rows, audit.update_rows, audit.carried_rows,
           previous_batch_id, _dt.datetime.now(_dt.timezone.utc).isoformat(), note)
    spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(log_path)


def write_version(df: DataFrame, table_path: str, version: int) -> int:
    """Write a full table version to ``batch_id=<version>``; returns its rows, counted on the way."""
    return counted(df, lambda rows, watch: watch(rows).write.mode("overwrite").parquet(batch_path(table_path, version)))


def counted(df: DataFrame, write) -> int:
    """``write(df, watch)``, which applies ``watch`` after its last shuffle; the number of rows written."""
    seen = Observation()
    write(df, lambda rows: rows.observe(seen, F.count(F.lit(1)).alias("rows")))
    return int(seen.get["rows"] or 0)


def table_checksum(df: DataFrame) -> tuple[int, int]:
    """(rows, order-independent content checksum)."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(h).alias("s")).first()
    return int(r["n"]), int(r["s"] or 0)


def partition_checksums(df: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Rows and order-independent checksum per partition value."""
    data = [c for c in df.columns if c not in partition_cols]
    h = F.xxhash64(*[F.col(f"`{c}`") for c in data]).cast("decimal(38,0)")
    return df.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("n"), F.sum(h).alias("s"))


def compact(spark: SparkSession, table_path: str, partition_cols: list[str],
            cluster_by: list[str], rows_per_file: int = 2_000_000,
            where=None) -> int:
    """Rewrite the selected partitions of a table into fewer, clustered files.

    One pass for all selected partitions (``where`` is a predicate on the
    partition columns, so the read is pruned): the rows are range-partitioned
    on (partition columns, ``cluster_by``) into about ``rows / rows_per_file``
    files, written beside the table (moves need one file system), compared partition by
    partition (rows and checksum) with the original, and only then moved into
    place as they are, so the clustering stays; the old directories are kept
    beside the table too (``<table>_compact-<id>-old``).  Returns the number of rows
    rewritten.
    """
    src = spark.read.parquet(table_path.rstrip("/"))
    if where is not None:
        src = src.where(where)
    rows = src.count()
    if rows == 0:
        return 0
    n_files = max(1, -(-rows // rows_per_file))
    staged = f"{table_path.rstrip('/')}_compact-{uuid.uuid4().hex}"
    (src.repartitionByRange(n_files, *partition_cols, *cluster_by)
     .sortWithinPartitions(*partition_cols, *cluster_by)
     .write.partitionBy(*partition_cols).parquet(staged))
    restaged = spark.read.parquet(staged).select(*src.columns)
    compare_partitions(src, restaged, partition_cols, table_path)
    swap_partitions(spark, staged, table_path, staged + "-old", len(partition_cols))
    return rows


# ---- compaction by file size -------------------------------------------------------

def file_sizes(src: DataFrame, partition_cols: list[str]) -> DataFrame:
    """``(partition columns, file, bytes)`` of the files of a table, from their metadata alone."""
    return (src.select(*partition_cols, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
            .groupBy(*partition_cols, "file").agg(F.max("bytes").alias("bytes")))


def small_file_groups(sizes: DataFrame, partition_cols: list[str], target_bytes: int) -> DataFrame:
    """``sizes`` of files to rewrite, with the ``group`` of each: small files of a partition, in groups of about the target
    size by a running sum.  Files of three quarters of the target or more are left alone, and so is a file that is
    the only one of its group."""
    small = sizes.where(F.col("bytes") < 0.75 * target_bytes)
    order = Window.partitionBy(*partition_cols).orderBy("file").rowsBetween(Window.unboundedPreceding, 0)
    grouped = small.withColumn("group", F.floor((F.sum("bytes").over(order) - F.col("bytes")) / F.lit(target_bytes)))
    together = Window.partitionBy(*partition_cols, "group")
    return grouped.withColumn("_n", F.count(F.lit(1)).over(together)).where(F.col("_n") > 1).drop("_n")


def compact_small(spark: SparkSession, table_path: str, partition_cols: list[str], cluster_by: list[str],
                  target_bytes: int = 256 << 20, where=None) -> int:
    """Put the small files of the selected partitions together; files already large stay as they are.

    The small files' rows are range-partitioned on (partition columns, ``cluster_by``), one task for each group of files, written
    beside the table, compared with the originals partition by partition (rows and checksum), and moved into place;
    the originals are kept beside the table.  Returns the number of files replaced.
    """
    table_path = table_path.rstrip("/")
    src = spark.read.parquet(table_path)
    if where is not None:
        src = src.where(where)
    groups = materialize(small_file_groups(file_sizes(src, partition_cols), partition_cols, target_bytes), "small-files")
    # Names only: they are moved one by one.  (The metadata column spells them as URIs.)
    files = [unquote(r["file"]) for r in groups.select("file").collect()]
    if not files:
        return 0
    tasks = groups.select(*partition_cols, "group").distinct().count()
    # ``src`` keeps its partition columns: the files are named, not listed.
    small = spark.read.option("basePath", table_path).parquet(*files).select(*src.columns)
    staged = f"{table_path}_compact-{uuid.uuid4().hex}"
    (small.repartitionByRange(tasks, *partition_cols, *cluster_by).sortWithinPartitions(*partition_cols, *cluster_by)
     .write.partitionBy(*partition_cols).parquet(staged))
    compare_partitions(small, spark.read.parquet(staged).select(*src.columns), partition_cols, table_path)
    swap_files(spark, staged, table_path, files, staged + "-old", len(partition_cols))
    return len(files)


def compare_partitions(before: DataFrame, after: DataFrame, partition_cols: list[str], table_path: str) -> None:
    """Raise where a partition's rows or their checksum differ."""
    a = partition_checksums(before, partition_cols).alias("a")
    b = partition_checksums(after, partition_cols).alias("b")
    bad = a.join(b, partition_cols, "full_outer").where(
        ~F.col("a.n").eqNullSafe(F.col("b.n")) | ~F.col("a.s").eqNullSafe(F.col("b.s"))).limit(5).collect()
    if bad:
        raise AuditError(f"compaction of {table_path} changed partitions: {bad}")


def swap_files(spark: SparkSession, staged: str, table_path: str, files: list[str], old: str, depth: int) -> None:
    """Move ``files`` out of the table to ``old``, and the files of ``staged`` into their partitions."""
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    base = Path(table_path)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base, staged = (fs.makeQualified(Path(p)).toString() for p in (table_path, staged))
    moves = []
    for status in fs.globStatus(Path(staged + "/*=*" * depth + "/*.parquet")):
        moves.append((status.getPath(), Path(table_path + status.getPath().toString()[len(staged):])))
    for f in files:
        path = fs.makeQualified(Path(f))
        moves.append((path, Path(old + path.toString()[len(base):])))
    for source, target in moves:       # new files first: a reader may see rows twice in between, never too few
        fs.mkdirs(target.getParent())
        if not fs.rename(source, target):
            raise AuditError(f"compaction of {table_path}: {source} could not be moved to {target}")


def swap_partitions(spark: SparkSession, staged: str, table_path: str, old: str, depth: int) -> None:
    """Move each partition directory of ``staged`` into the table, its old directory to ``old``.

    File-system moves of directories only (one listing, two moves a partition); tables that are
    read while they are compacted belong behind a batch log."""
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    base = Path(staged)
    fs = base.getFileSystem(conf)
    base = fs.makeQualified(base).toString()
    for status in fs.globStatus(Path(base + "/*=*" * depth)):
        part = status.getPath().toString()[len(base):].lstrip("/")
        target, kept = Path(f"{table_path.rstrip('/')}/{part}"), Path(f"{old}/{part}")
        fs.mkdirs(kept.getParent())
        if not fs.rename(target, kept) or not fs.rename(status.getPath(), target):
            raise AuditError(f"compaction of {table_path}: {part} could not be moved; its files are in {old} and {staged}")
