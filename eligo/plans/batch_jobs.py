"""The three batch jobs, composed from sources -> operators -> sinks.

* ``run_saved_offers``: land an hour window of saved offers, stage the latest
  row of every offer from the whole raw table, MERGE into the dimension.
* ``run_init``: Parquet dump -> expiry status -> active / inactive state.
* ``run_increment``: land an hour window of eligibility snapshots, stage the
  latest version per key, classify against the last state batch, write,
  audit and publish the next full batch.

Every intermediate that more than one step reads is a written table, so each
step restarts from stored data, not from a long lineage.  Rows are counted while they are written.

With a ``database`` in ``Tables`` the versioned tables are read and written through Spark's catalog (bucketed by their
key, if ``buckets`` is given); without one they are directories.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eligo.operators import classify, expiry, flatten, merge, offers
from eligo.operators.joins import DEFAULT_BROADCAST_BYTES, with_offer_bucket
from eligo.operators.latest import latest_per_key
from eligo.schemas import (
    KEY_COLS, OFFER_BUCKET, PARTITION_COLS, SAVED_OFFER_COLS, SAVED_OFFER_SCHEMA, STATE_COLS, STATE_SCHEMA, Tables,
)
from eligo.session import materialize
from eligo.sinks import publish, write
from eligo.sinks.catalog import VersionedTable
from eligo.sources import landing, ledger
from eligo.sources.tables import read_parquet_or_none


def window_batch_id(end: datetime) -> int:
    """Batch id from the window end, ``yyyymmddhh``."""
    return int(end.strftime("%Y%m%d%H"))


def next_version(last: int | None, wanted: int | None, end: datetime) -> int:
    """The id of a run.  A wanted id must be after the last published one.  Without one it is the
    window's id, or the next number if the table has come past that: a window that is run
    again for late data, or one after an initial state with a larger id, gets a new version."""
    if wanted is None:
        return max(window_batch_id(end), (last or 0) + 1)
    if last is not None and wanted <= last:
        raise ValueError(f"version {wanted} is not after the last published one, {last}")
    return wanted


# ---- versioned tables ------------------------------------------------------------

def catalog_table(spark: SparkSession, tables: Tables, path: str, log_path: str,
                  columns: T.StructType, keys) -> VersionedTable | None:
    """The catalog's table over ``path`` with its published versions, or ``None`` where the tables are directories."""
    if tables.database is None:
        return None
    columns = T.StructType([f for f in columns.fields if f.name != "batch_id"])
    name = f"{tables.database}.{path.rstrip('/').rsplit('/', 1)[-1]}"
    log = publish.logged_batches(spark, log_path)
    versions = [] if log is None else [r[0] for r in log.select("batch_id").distinct().collect()]   # one for each run
    return VersionedTable(spark, name, path, columns, tuple(keys), tables.buckets).attach(versions)


def saved_offers_table(spark: SparkSession, tables: Tables) -> VersionedTable | None:
    return catalog_table(spark, tables, tables.saved_offers, tables.saved_offers_log, SAVED_OFFER_SCHEMA, ["offer_id"])


def state_table(spark: SparkSession, tables: Tables, path: str | None = None) -> VersionedTable | None:
    return catalog_table(spark, tables, path or tables.cs_active, tables.batch_log, STATE_SCHEMA, KEY_COLS)


# ---- landing ---------------------------------------------------------------------

def replace_hours(spark: SparkSession, raw: DataFrame, raw_path: str, start: datetime, end: datetime) -> tuple[bool, int]:
    """Write a window's hours into a raw table; hours of the window that no longer
    land are removed, all other hours stay.  Returns whether the window had landed before, and its corrupt lines.

    Corrupt lines are counted while the window is written."""
    def hours(df):   # at most the window's hours
        return {tuple(r) for r in df.select(*PARTITION_COLS).distinct().collect()}

    before = landing.read_hours(spark, raw_path, start, end, "parquet")
    landed = hours(before) if before is not None else set()
    stale = landed - hours(raw) if landed else set()
    seen = Observation()
    write.overwrite_partitions(raw.observe(seen, F.count_if("corrupt").alias("corrupt")), raw_path, PARTITION_COLS)
    write.drop_partitions(spark, raw_path, [
        "/".join(f"{c}={v}" for c, v in zip(PARTITION_COLS, h)) for h in sorted(stale)])
    return bool(landed), int(seen.get["corrupt"] or 0)


def land_window(spark: SparkSession, base: str, start: datetime, end: datetime,
                raw_path: str) -> DataFrame:
    """Copy one hour window of the landing into the raw table, every line whole (only that
    window's hours are replaced), and return the window read back from it."""
    return land_counted(spark, base, start, end, raw_path)[0]


def land_counted(spark: SparkSession, base: str, start: datetime, end: datetime,
                 raw_path: str) -> tuple[DataFrame, int]:
    """``land_window`` and the window's corrupt lines, counted while it was written."""
    raw = landing.read_window(spark, base, start, end)
    _, corrupt = replace_hours(spark, raw, raw_path, start, end)
    back = landing.read_hours(spark, raw_path, start, end, "parquet")
    return (back if back is not None else raw.limit(0)), corrupt


# ---- saved offers --------------------------------------------------------

def run_saved_offers(spark: SparkSession, tables: Tables, base: str,
                     start: datetime, end: datetime, version: int | None = None) -> int:
    previous = publish.last_logged_batch(spark, tables.saved_offers_log)
    version = next_version(previous, version, end)      # refused before anything is written
    df = landing.read_window(spark, base, start, end, landing.SAVED_OFFER_LANDING_SCHEMA)
    raw = df.select("id", F.col("eligibilityRequirement.latestEndTime").alias("latestEndTime"),
                    "startTime", "endTime", "line", "data", "corrupt", *PARTITION_COLS)
    landed_before, corrupt = replace_hours(spark, raw, tables.raw_saved_offers, start, end)

    # One stage for each version.  A window on new hours is merged into the last stage, so an hourly
    # run reads its own hours only; one that replaces hours rebuilds the stage from all of raw.
    window = landing.read_hours(spark, tables.raw_saved_offers, start, end, "parquet")
    if previous is None or landed_before:
        staged = offers.stage_saved_offers(spark.read.schema(raw.schema).parquet(tables.raw_saved_offers))
    else:
        last_stage = publish.read_batch(spark, tables.stg_saved_offers, previous, SAVED_OFFER_COLS)
        staged = offers.restage_saved_offers(last_stage, window if window is not None else raw.limit(0))
    rows_staged = publish.write_version(staged, tables.stg_saved_offers, version)
    source = publish.read_batch(spark, tables.stg_saved_offers, version, SAVED_OFFER_COLS)
    dups = merge.duplicate_keys(source.where(F.col("offer_id").isNotNull()), "offer_id").limit(1).collect()
    if dups:
        raise ValueError(f"staged saved offers repeat an offer id: {dups}")

    compare = ["start_time", "end_time", "latest_end_time"]
    table = saved_offers_table(spark, tables)
    if table is not None:
        rows = publish.counted(table.merged(previous, source, compare), lambda df, watch: table.write(df, version, watch, dealt=True))
    else:
        target = publish.read_current(spark, tables.saved_offers, tables.saved_offers_log, SAVED_OFFER_COLS)
        if target is None:
            target = spark.createDataFrame([], SAVED_OFFER_SCHEMA)
        merged = merge.merge_upsert(target, source, "offer_id", compare)
        rows = publish.write_version(merged.select(*SAVED_OFFER_COLS), tables.saved_offers, version)
    publish.commit_version(spark, tables.saved_offers_log, version, rows, previous,
                           f"window {start:%Y-%m-%d %H} -> {end:%Y-%m-%d %H}; "
                           f"{rows_staged} offers staged; corrupt lines {corrupt}")
    return rows


def current_saved_offers(spark: SparkSession, tables: Tables) -> DataFrame | None:
    return publish.read_current(spark, tables.saved_offers, tables.saved_offers_log,
                                SAVED_OFFER_COLS)


# ---- initial state -------------------------------------------------------

def batch_id_from_dump_path(path: str) -> int:
    """``.../<name>=<batch id>[/]`` -> batch id."""
    last = path.rstrip("/").rsplit("/", 1)[-1]
    if "=" not in last:
        raise ValueError(f"dump path {path!r} does not end in <name>=<batch id>")
    return int(last.split("=", 1)[1])


def run_init(spark: SparkSession, tables: Tables, dump_path: str, as_of: date,
             batch_id: int | None = None) -> dict:
    """Dump -> dump table -> expiry status -> active / inactive batch."""
    batch_id = batch_id or batch_id_from_dump_path(dump_path)
    if publish.last_logged_batch(spark, tables.batch_log) is not None:
        raise ValueError("state already initialised")
    write.overwrite(spark.read.parquet(dump_path), tables.dump)
    dump = spark.read.parquet(tables.dump)

    saved = current_saved_offers(spark, tables)
    if saved is None:
        saved = spark.createDataFrame([], SAVED_OFFER_SCHEMA)
    with_status = expiry.with_expiry_status(dump, saved, as_of)
    # One table for each batch id, overwritten: neither a stopped run's rows nor another snapshot's are taken up.
    status_path = publish.batch_path(tables.dump_with_expiry, batch_id)
    write.overwrite(with_status, status_path, ["expiry_status"])
    status = spark.read.schema(with_status.schema).parquet(status_path)
    active, inactive = expiry.split_by_expiry(status)

    def as_state(df):
        return df.withColumn("batch_id", F.lit(batch_id).cast("bigint")).select(*STATE_COLS)

    def write_state(df, path):
        """CTAS IF NOT EXISTS of the state's first batch in the catalog, or its directory."""
        table = state_table(spark, tables, path)
        if table is None:
            return publish.counted(as_state(df), lambda rows, watch: publish.write_batch(watch(rows), path, batch_id))
        if batch_id in table.versions():      # left by a run that stopped before it was published
            table.drop(batch_id)
        return publish.counted(as_state(df), lambda rows, watch: table.create_as(rows, batch_id, watch))

    rows, gone, dumped = write_state(active, tables.cs_active), write_state(inactive, tables.cs_inactive), dump.count()
    if rows + gone != dumped:
        raise ValueError(f"batch {batch_id}: {rows} active and {gone} inactive rows of {dumped} in the dump")
    publish.commit_version(spark, tables.batch_log, batch_id, rows, None, f"init from {dump_path}")
    return {"batch_id": batch_id, "active_rows": rows, "inactive_rows": gone}


# ---- incremental eligibility ---------------------------------------------

@dataclass
class IncrementResult:
    batch_id: int
    previous_batch_id: int | None
    audit: publish.BatchAudit
    rule_counts: dict
    corrupt_lines: int = 0


def run_increment(spark: SparkSession, tables: Tables, base: str, start: datetime,
                  end: datetime, batch_id: int | None = None,
                  max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                  compact_rows_per_file: int | None = None,
                  tiebreak: bool = False) -> IncrementResult:
    """One hourly increment.  With ``compact_rows_per_file`` the new batch is
    rewritten into clustered files before it is audited and published (the
    carried rows otherwise keep the previous batch's file layout)."""
    previous_id = publish.last_logged_batch(spark, tables.batch_log)
    batch_id = next_version(previous_id, batch_id, end)

    files = ledger.listed_files(spark, base, start, end)
    if files is not None:
        ledger.record_files(files, tables.raw_files)
    window, corrupt = land_counted(spark, base, start, end, tables.raw)
    fields = flatten.landed_fields(window, tables.origin)
    staged = latest_per_key(flatten.by_origin(fields, tables.origin), tiebreak)
    write.overwrite(staged, tables.stg)
    incr = spark.read.parquet(tables.stg)

    table = state_table(spark, tables)
    if tables.offer_buckets and (table is not None or compact_rows_per_file):
        raise ValueError("offer_buckets is a layout of directories: it takes neither a database nor compact_rows_per_file")
    if table is not None and tables.buckets and compact_rows_per_file:
        raise ValueError("buckets set the files of a bucketed state: it takes no compact_rows_per_file")
    prev, previous_rows = None, 0
    if previous_id is not None:
        columns = [*STATE_COLS, OFFER_BUCKET] if tables.offer_buckets else STATE_COLS
        prev = table.read(previous_id) if table else publish.read_batch(spark, tables.cs_active, previous_id, columns)
        previous_rows = publish.logged_rows(spark, tables.batch_log, previous_id)
    nb = classify.next_batch(incr, prev, batch_id, max_broadcast_bytes, materialize=materialize,
                             buckets=tables.buckets if table else 0, keep_touched=True, offer_buckets=tables.offer_buckets)
    # ``pairs`` are stored by ``next_batch``: updates and the keys the
    # carry-forward excludes both come from that one copy.
    updates = nb.updates
    if tables.offer_buckets:   # carried rows come from one directory's files and stay in it; only updates are dealt out
        n = tables.offer_buckets
        counts = publish.observed_write(
            with_offer_bucket(updates, n).repartitionByRange(OFFER_BUCKET, "user_id"), with_offer_bucket(nb.carried, n),
            lambda rows, watch: publish.write_batch(watch(rows), tables.cs_active, batch_id, [OFFER_BUCKET]))
    elif table is None:
        counts = publish.observed_write(updates, nb.carried, lambda rows, watch: publish.write_batch(
            watch(rows), tables.cs_active, batch_id))
    else:   # carried rows lie in their buckets; only the updates are dealt out
        dealt = updates.repartition(tables.buckets, *KEY_COLS) if tables.buckets else updates
        counts = publish.observed_write(dealt, nb.carried, lambda rows, watch: table.write(rows, batch_id, watch, dealt=True))
    if compact_rows_per_file:
        # (offer_id, user_id), not offer_id alone: range bounds then split a hot offer.
        publish.compact(spark, tables.cs_active, ["batch_id"], ["offer_id", "user_id"],
                        compact_rows_per_file, where=F.col("batch_id") == batch_id)

    audit = publish.audit_observed(counts, publish.read_batch(spark, tables.cs_active, batch_id), updates, nb.touched,
                                   previous_rows, batch_id, max_broadcast_bytes)
    counts = {r["rule"]: r["n"] for r in
              nb.pairs.groupBy("rule").agg(F.count(F.lit(1)).alias("n")).collect()}
    publish.publish(spark, tables.batch_log, audit, previous_id,
                    f"window {start:%Y-%m-%d %H} -> {end:%Y-%m-%d %H}; rules {counts}; corrupt lines {corrupt}")
    return IncrementResult(batch_id, previous_id, audit, counts, corrupt)


def run_late(spark: SparkSession, tables: Tables, base: str, start: datetime, end: datetime, **options) -> list[IncrementResult]:
    """Run again exactly those hours of ``[start, end)`` that got files since they were landed (or never were), oldest first.

    An hour is landed whole, so its early rows come again and are stale; its late rows are new keys or fresher versions,
    or older than the state and then no update."""
    late = ledger.late_hours(spark, base, start, end, tables.raw_files)
    if late is None:
        return []
    return [run_increment(spark, tables, base, a, b, **options) for a, b in ledger.windows(late)]


def read_state(spark: SparkSession, tables: Tables) -> DataFrame | None:
    return publish.read_current(spark, tables.cs_active, tables.batch_log, STATE_COLS)


def register_views(spark: SparkSession, tables: Tables) -> list[str]:
    """Temp views for SQL users, named like the tables (S07): the staged
    increment, the current active state batch and the current saved offers.
    Returns the names registered (a table that does not exist yet is skipped)."""
    names = []
    stg = read_parquet_or_none(spark, tables.stg)
    frames = {
        tables.stg: stg,
        tables.cs_active: read_state(spark, tables),
        tables.saved_offers: current_saved_offers(spark, tables),
    }
    for path, df in frames.items():
        if df is None:
            continue
        name = path.rstrip("/").rsplit("/", 1)[-1]
        df.createOrReplaceTempView(name)
        names.append(name)
    return names


def register_tables(spark: SparkSession, tables: Tables, database: str,
                    start: datetime, end: datetime) -> list[str]:
    """The warehouse's tables in the catalog, ``CREATE TABLE IF NOT EXISTS`` over their folders.

    Raw tables learn the hours of the window ``[start, end)``; versioned tables learn the logged
    versions only, so an unpublished batch stays invisible to SQL users as well.  Returns the
    names; a table that does not exist yet is skipped."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []

    def create(path, df, partition_cols, specs):
        name = f"{database}.{path.rstrip('/').rsplit('/', 1)[-1]}"
        write.create_table(spark, name, df.schema, partition_cols, path)
        if specs:
            write.add_partitions(spark, name, specs)
        spark.catalog.refreshTable(name)
        names.append(name)

    for path in (tables.raw, tables.raw_saved_offers):
        hours = landing.read_hours(spark, path, start, end, "parquet")
        if hours is not None:
            found = hours.select(*PARTITION_COLS).distinct().collect()   # at most the window's hours
            create(path, hours, PARTITION_COLS, [r.asDict() for r in found])
    stg = read_parquet_or_none(spark, tables.stg)
    if stg is not None:
        create(tables.stg, stg, None, [])
    if tables.database is not None and tables.database != database:
        raise ValueError(f"the versioned tables are in {tables.database}, not in {database}")
    for path, log_path in ((tables.cs_active, tables.batch_log), (tables.saved_offers, tables.saved_offers_log),
                           (tables.stg_saved_offers, tables.saved_offers_log)):
        log = publish.logged_batches(spark, log_path)
        if log is not None:
            versions = [r[0] for r in log.select("batch_id").distinct().collect()]   # one row for each run
            if tables.database is not None and path != tables.stg_saved_offers:
                names.append((state_table if path == tables.cs_active else saved_offers_table)(spark, tables).name)
                continue
            create(path, publish.read_batch(spark, path, max(versions), None), ["batch_id"],
                   [{"batch_id": v} for v in versions])
    return names
