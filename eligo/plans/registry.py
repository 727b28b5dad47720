"""The query registry: one Spark plan per operator group, over the test tables.

Every query reads the shared tables (or frames Spark derives from them) whole;
``oracle.py`` holds the DuckDB SQL that must give the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eligo.functions.casts import json_field, nvl_decimal, typed
from eligo.functions.paths import hour_window, path_parts
from eligo.functions.time import epoch_ms_to_ts, ts_to_epoch_ms, utc_to_zone
from eligo.operators import classify, drift, expiry, flatten, merge, offers
from eligo.operators.latest import latest_per_key
from eligo.plans import standins as S
from eligo.schemas import OFFER_TIME_ZONE, SAVED_OFFER_COLS, SAVED_OFFER_SCHEMA
from eligo.sinks.catalog import VersionedTable
from eligo.sinks.publish import compact
from eligo.sources import landing
from eligo.sources.tables import batch_slice, last_batch_value
from eligo.session import materialize, scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark, sf_dir):
    return S.table(spark, sf_dir, "events")


# ---- eligibility state ---------------------------------------------------

def _staged_pair(spark, sf_dir):
    hist_flat, incr_flat = S.split_history(S.snapshot_flat(_events(spark, sf_dir)))
    return latest_per_key(hist_flat), latest_per_key(incr_flat)


def _history_state(hist_staged: DataFrame) -> DataFrame:
    """The state batch written when there is no earlier batch."""
    return classify.next_batch(hist_staged, None, S.HIST_BATCH_ID).rows()


def _next(spark, sf_dir) -> classify.NextBatch:
    """History batch and staged increment are stored once (as the job stores
    its state and staging tables), then the next batch is derived from them."""
    hist_staged, incr = _staged_pair(spark, sf_dir)
    prev = materialize(_history_state(hist_staged), "hist_state")
    incr = materialize(incr, "stg_incr")
    return classify.next_batch(incr, prev, S.NEXT_BATCH_ID, materialize=materialize)


def q_latest_per_key(spark, sf_dir):
    return latest_per_key(S.snapshot_flat(_events(spark, sf_dir)))


def q_new_mappings(spark, sf_dir):
    nb = _next(spark, sf_dir)
    return classify.updates_from_pairs(nb.pairs.where(F.col("rule").isin("N1", "N2")),
                                       S.NEXT_BATCH_ID)


def q_matching(spark, sf_dir):
    nb = _next(spark, sf_dir)
    return (nb.pairs.where(F.col("rule").isin(*classify.MATCH_LABELS))
            .drop("rule").dropDuplicates())


def q_pruned_matches(spark, sf_dir):
    """The matches read from a state in directories by offer: the increment's offers prune the scan at run time."""
    from eligo.operators.joins import with_offer_bucket
    from eligo.schemas import OFFER_BUCKET, STATE_COLS
    from eligo.sinks import publish
    hist_staged, incr = _staged_pair(spark, sf_dir)
    path = scratch_path(spark, "pruned_state")
    publish.write_batch(with_offer_bucket(_history_state(hist_staged), 32).repartitionByRange(OFFER_BUCKET, "user_id"),
                        path, S.HIST_BATCH_ID, [OFFER_BUCKET])
    prev = publish.read_batch(spark, path, S.HIST_BATCH_ID, [*STATE_COLS, OFFER_BUCKET])
    nb = classify.next_batch(materialize(incr, "stg_incr"), prev, S.NEXT_BATCH_ID, materialize=materialize, offer_buckets=32)
    return nb.pairs.where(F.col("rule").isin(*classify.MATCH_LABELS)).drop("rule").dropDuplicates()


def q_classify(spark, sf_dir):
    nb = _next(spark, sf_dir)
    return nb.pairs.groupBy("rule").agg(F.count(F.lit(1)).alias("n_rows"))


def q_state_updates(spark, sf_dir):
    return _next(spark, sf_dir).updates


def q_carry_forward(spark, sf_dir):
    return _next(spark, sf_dir).carried


def q_state_batch(spark, sf_dir):
    return _next(spark, sf_dir).rows()


def q_carry_forward_large(spark, sf_dir):
    """The carry-forward past the broadcast limit: rows that a bitmap of the increment's keys rules out pass
    map-only, the others go through the exact anti join."""
    hist_staged, incr = _staged_pair(spark, sf_dir)
    prev = materialize(_history_state(hist_staged), "hist_state")
    return classify.next_batch(materialize(incr, "stg_incr"), prev, S.NEXT_BATCH_ID, max_broadcast_bytes=0,
                               materialize=materialize).carried


def q_audit_counts(spark, sf_dir):
    """The audit of a written batch, counted while it was written: rows, updates, carried, replaced and copies."""
    from eligo.schemas import STATE_COLS
    from eligo.sinks import publish
    hist_staged, incr = _staged_pair(spark, sf_dir)
    prev = materialize(_history_state(hist_staged), "hist_state")
    nb = classify.next_batch(materialize(incr, "stg_incr"), prev, S.NEXT_BATCH_ID, materialize=materialize, keep_touched=True)
    path = scratch_path(spark, "audited")
    counts = publish.observed_write(nb.updates, nb.carried, lambda rows, watch: publish.write_batch(
        watch(rows), path, S.NEXT_BATCH_ID))
    a = publish.audit_observed(counts, publish.read_batch(spark, path, S.NEXT_BATCH_ID, STATE_COLS), nb.updates, nb.touched,
                               prev.count(), S.NEXT_BATCH_ID)
    return spark.createDataFrame(
        [(a.rows, a.update_rows, a.carried_rows, a.previous_rows, a.previous_rows_replaced, a.written_rows_of_updated_keys,
          a.updated_keys_with_several_rows, a.update_row_copies, not a.problems())],
        "rows bigint, update_rows bigint, carried_rows bigint, previous_rows bigint, replaced_rows bigint, "
        "rows_of_updated_keys bigint, keys_with_several_rows bigint, update_copies bigint, sound boolean")


def q_last_batch(spark, sf_dir):
    orders = _orders_batched(spark, sf_dir)
    return orders.agg(F.max("batch_id").alias("last_batch"))


def _orders_batched(spark, sf_dir):
    o = S.table(spark, sf_dir, "orders")
    return o.withColumn("batch_id", (F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("bigint"))


def q_batch_slice(spark, sf_dir):
    orders = _orders_batched(spark, sf_dir)
    return batch_slice(orders, last_batch_value(orders))


# ---- landing, scalar functions, flatteners -------------------------------

def q_hour_window(spark, sf_dir):
    ev = S.with_landing_parts(_events(spark, sf_dir))
    win = hour_window(datetime.strptime(S.WINDOW_START, "%Y-%m-%d %H"),
                      datetime.strptime(S.WINDOW_END, "%Y-%m-%d %H"))
    return ev.where(win).select("event_id", "ts", "user_id", "event_type",
                                "year", "month", "day", "hour")


def q_path_parts(spark, sf_dir):
    ev = S.with_landing_parts(_events(spark, sf_dir))
    with_path = ev.select("event_id", S.landing_path(ev).alias("file_path"))
    parts = path_parts("file_path")
    return with_path.select("event_id", "file_path", *[c.alias(n) for n, c in parts.items()])


def q_json_field(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return ev.select("event_id", json_field("props", "$.k").alias("k_text"),
                     json_field("props", "$.missing").alias("missing_text"))


def q_epoch_to_ts(spark, sf_dir):
    ev = _events(spark, sf_dir)
    ms = ts_to_epoch_ms("ts")
    return ev.select("event_id", ms.alias("epoch_ms"), epoch_ms_to_ts(ms).alias("ts_sec"))


def q_chicago_time(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return ev.select("event_id",
                     utc_to_zone(epoch_ms_to_ts(ts_to_epoch_ms("ts")), OFFER_TIME_ZONE)
                     .alias("chicago_ts"))


def q_typed_progress(spark, sf_dir):
    ev = _events(spark, sf_dir)
    k = S.offer_k()
    text = ev.select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("abc"))
         .when(F.col("event_type") == "view", F.lit(None).cast("string"))
         .otherwise(F.col("value").cast("string")).alias("quantity_text"),
        k.alias("uses_text"),
        F.col("value").cast("string").alias("dollars_text"),
        F.when(k.cast("int") % 10 == 0, "true").when(k.cast("int") % 10 == 1, "maybe")
         .otherwise("false").alias("holdout_text"),
    )
    return text.select(
        "event_id",
        nvl_decimal("quantity_text").alias("quantity"),
        typed("uses_text", "decimal(38,0)").alias("uses"),
        typed("dollars_text", "double").alias("dollars"),
        typed("holdout_text", "boolean").alias("holdout"),
        typed("quantity_text", "bigint").alias("max_uses"),
    )


def q_flatten_legacy(spark, sf_dir):
    return flatten.legacy(S.legacy_payloads(_events(spark, sf_dir)).select("payload"))


def q_flatten_kafka(spark, sf_dir):
    return flatten.kafka(S.kafka_snapshots(_events(spark, sf_dir)))


def q_stage_legacy(spark, sf_dir):
    """Legacy payloads -> flatten -> latest version per key, typed (C02 + C04)."""
    return latest_per_key(flatten.legacy(S.legacy_payloads(_events(spark, sf_dir)).select("payload")))


def q_stage_kafka(spark, sf_dir):
    """Kafka snapshots -> flatten -> latest version per key, typed (C03 + C04)."""
    return latest_per_key(flatten.kafka(S.kafka_snapshots(_events(spark, sf_dir))))


def q_dedupe_rows(spark, sf_dir):
    li = S.table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber").dropDuplicates()


def q_clustered_rows(spark, sf_dir):
    ev = S.with_landing_parts(_events(spark, sf_dir))
    return (ev.sortWithinPartitions("year", "month", "day", "hour")
            .select("event_id", "user_id", "year", "month", "day", "hour"))


# ---- saved offers, merge, expiry -----------------------------------------

def _raw_offers(spark, sf_dir):
    return S.raw_saved_offers(_events(spark, sf_dir))


def q_offer_stage(spark, sf_dir):
    return offers.stage_saved_offers(_raw_offers(spark, sf_dir))


def q_offer_merge(spark, sf_dir):
    raw = _raw_offers(spark, sf_dir)
    cut = F.lit(S.CUT).cast("timestamp_ntz")
    hour_ts = F.make_timestamp_ntz("year", "month", "day", "hour", F.lit(0), F.lit(0))
    target = offers.stage_saved_offers(raw.where(hour_ts < cut))
    source = offers.stage_saved_offers(raw.where(hour_ts >= cut))
    return merge.merge_upsert(target, source, "offer_id",
                              ["start_time", "end_time", "latest_end_time"]).select(*SAVED_OFFER_COLS)


def q_merge_bucketed(spark, sf_dir):
    """``q_offer_merge`` on a catalog table bucketed by offer: the target is read as it lies in its buckets, the
    merged rows are its next version, read back by name."""
    raw = _raw_offers(spark, sf_dir)
    cut = F.lit(S.CUT).cast("timestamp_ntz")
    hour_ts = F.make_timestamp_ntz("year", "month", "day", "hour", F.lit(0), F.lit(0))
    table = VersionedTable(spark, f"eligo_queries.offers_{uuid.uuid4().hex}", scratch_path(spark, "merge_bucketed"),
                           SAVED_OFFER_SCHEMA, ("offer_id",), 16).create()
    table.write(offers.stage_saved_offers(raw.where(hour_ts < cut)), 1)
    source = offers.stage_saved_offers(raw.where(hour_ts >= cut))
    table.write(table.merged(1, source, ["start_time", "end_time", "latest_end_time"]), 2, dealt=True)
    return spark.table(table.name).where("batch_id = 2").select(*SAVED_OFFER_COLS)


def q_catalog_tables(spark, sf_dir):
    """The saved-offers job on catalog tables: the window before the cut, the one after it, and that one again;
    all versions of the dimension, read by the table's name."""
    from eligo.plans import batch_jobs
    from eligo.schemas import Tables
    root = scratch_path(spark, "catalog_tables")
    land = f"{root}/landing"
    (S.saved_offer_landing(S.by_landing_hour(_events(spark, sf_dir)))
     .write.partitionBy("year", "month", "day", "hour").json(land))
    tables = Tables(f"{root}/warehouse", "legacy", f"eligo_q_{uuid.uuid4().hex}", 8)
    cut = datetime.strptime(S.CUT, "%Y-%m-%d %H:%M:%S")
    first, last = S.data_span(_events(spark, sf_dir))
    for version, (start, end) in enumerate([(first, cut), (cut, last), (cut, last)], 1):
        batch_jobs.run_saved_offers(spark, tables, land, start, end, version)
    return spark.sql(f"SELECT * FROM {tables.database}.saved_offers")


def q_saved_offers_job(spark, sf_dir):
    """The saved-offers job end to end: the events stand-in is written as a JSON
    landing (year=/month=/day=/hour=) in the scratch folder, the job runs for
    the window before the cut and then for the window after it, and the
    published dimension is read back.  Equal to ``q_offer_merge``."""
    from eligo.plans import batch_jobs
    from eligo.schemas import Tables
    root = scratch_path(spark, "saved_offers_job")
    land = f"{root}/landing"
    (S.saved_offer_landing(S.by_landing_hour(_events(spark, sf_dir)))
     .write.partitionBy("year", "month", "day", "hour").json(land))
    tables = Tables(f"{root}/warehouse", "legacy")
    cut = datetime.strptime(S.CUT, "%Y-%m-%d %H:%M:%S")
    first, last = S.data_span(_events(spark, sf_dir))
    for start, end in [(first, cut), (cut, last)]:
        batch_jobs.run_saved_offers(spark, tables, land, start, end)
    return batch_jobs.current_saved_offers(spark, tables)


def q_eligibility_job(spark, sf_dir):
    """The incremental eligibility job end to end: legacy payloads derived from
    events are written as a JSON landing in the scratch folder, the job runs for
    the window before the cut (batch 1, no earlier state) and the window after
    it (batch 2), each landing, staging, classifying, writing, auditing and
    publishing; the published state is read back."""
    from eligo.plans import batch_jobs
    from eligo.schemas import Tables
    root = scratch_path(spark, "eligibility_job")
    land = f"{root}/landing"
    (S.legacy_payloads(S.by_landing_hour(_events(spark, sf_dir)))
     .write.partitionBy("year", "month", "day", "hour").json(land))
    tables = Tables(f"{root}/warehouse", "legacy")
    cut = datetime.strptime(S.CUT, "%Y-%m-%d %H:%M:%S")
    first, last = S.data_span(_events(spark, sf_dir))
    batch_jobs.run_increment(spark, tables, land, first, cut, S.HIST_BATCH_ID)
    batch_jobs.run_increment(spark, tables, land, cut, last, S.NEXT_BATCH_ID)
    return batch_jobs.read_state(spark, tables)


def q_kafka_job(spark, sf_dir):
    """The incremental job over landed kafka JSON, untidy lines included (``standins.kafka_landing``):
    two windows, then the first one again, which brings nothing fresher; the published state is
    read back."""
    from eligo.plans import batch_jobs
    from eligo.schemas import Tables
    root = scratch_path(spark, "kafka_job")
    land = f"{root}/kafka-stream"
    (S.kafka_landing(S.by_landing_hour(_events(spark, sf_dir)))
     .write.partitionBy("year", "month", "day", "hour").text(land))
    tables = Tables.for_raw_path(f"{root}/warehouse", land)
    cut = datetime.strptime(S.CUT, "%Y-%m-%d %H:%M:%S")
    first, last = S.data_span(_events(spark, sf_dir))
    batch_jobs.run_increment(spark, tables, land, first, cut, S.HIST_BATCH_ID)
    batch_jobs.run_increment(spark, tables, land, cut, last, S.NEXT_BATCH_ID)
    batch_jobs.run_increment(spark, tables, land, first, cut, S.NEXT_BATCH_ID + 1)
    return batch_jobs.read_state(spark, tables)


def q_init_job(spark, sf_dir):
    """The init job end to end: the history state as a Parquet dump (offer ids as saved offers spell
    them), the dimension published by the saved-offers job, then dump -> expiry -> active and
    inactive batch, both read back."""
    from eligo.plans import batch_jobs
    from eligo.schemas import STATE_COLS, Tables
    from eligo.sinks import publish
    root = scratch_path(spark, "init_job")
    land, dump = f"{root}/landing", f"{root}/dump/snapshot={S.HIST_BATCH_ID}"
    events = _events(spark, sf_dir)
    (S.saved_offer_landing(S.by_landing_hour(events))
     .write.partitionBy("year", "month", "day", "hour").json(land))
    offer_id = (F.col("user_id").cast("bigint") * 1000 + F.col("offer_id").cast("bigint")).cast("string")
    (_history_state(_staged_pair(spark, sf_dir)[0]).withColumn("offer_id", offer_id)
     .drop("expiry_status", "batch_id").write.parquet(dump))
    tables = Tables(f"{root}/warehouse", "legacy")
    batch_jobs.run_saved_offers(spark, tables, land, *S.data_span(events))
    batch_jobs.run_init(spark, tables, dump, date.fromisoformat(S.INIT_AS_OF))
    active, inactive = (publish.read_batch(spark, path, S.HIST_BATCH_ID)
                        for path in (tables.cs_active, tables.cs_inactive))
    return active.unionByName(inactive).select(*STATE_COLS)


def q_landing_window(spark, sf_dir):
    """A written landing read for one hour window: every line of its hours, whole."""
    land = f"{scratch_path(spark, 'landing_window')}/landing"
    (S.kafka_landing(S.by_landing_hour(_events(spark, sf_dir)))
     .write.partitionBy("year", "month", "day", "hour").text(land))
    win = landing.read_window(spark, land, datetime.strptime(S.WINDOW_START, "%Y-%m-%d %H"),
                              datetime.strptime(S.WINDOW_END, "%Y-%m-%d %H"))
    return win.groupBy("year", "month", "day", "hour").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if("corrupt").alias("n_corrupt"))


def q_schema_drift(spark, sf_dir):
    """What the untidy kafka landing holds, field by field: path, type, lines, and whether the feed's schema names it."""
    lines = S.kafka_landing(_events(spark, sf_dir)).select(landing.parsed("value").alias("data"))
    return drift.drift(lines, flatten.KAFKA_SCHEMA)


def _part_end_times(li):
    # a returned line's end is open (NULL) and loses to any known one; all lines are aggregated
    end = F.when(F.col("l_returnflag") != "R", F.col("l_shipdate"))
    return li.select(F.col("l_partkey").alias("p_partkey"), end.alias("latest_end_time"))


def _part_expiry(spark, sf_dir):
    part = S.table(spark, sf_dir, "part")
    dim = _part_end_times(S.table(spark, sf_dir, "lineitem"))
    return expiry.with_expiry_status(part, dim, date.fromisoformat(S.EXPIRY_AS_OF), key="p_partkey")


def q_expiry_status(spark, sf_dir):
    return _part_expiry(spark, sf_dir)


def q_expiry_salted(spark, sf_dir):
    """The lookup past the broadcast limit: every order line looks its part up; a part on
    more than 30 lines is hot and salted."""
    li = S.table(spark, sf_dir, "lineitem")
    lines = li.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    return expiry.with_expiry_status(lines, _part_end_times(li), date.fromisoformat(S.EXPIRY_AS_OF), key="p_partkey",
                                     max_broadcast_bytes=0, rows_per_task=30)


def q_expiry_split(spark, sf_dir):
    active, inactive = expiry.split_by_expiry(_part_expiry(spark, sf_dir))

    def summary(df, side):
        return df.agg(F.lit(side).alias("side"), F.count(F.lit(1)).alias("n_rows"),
                      F.sum("p_partkey").cast("bigint").alias("key_checksum"))
    return summary(active, "active").unionByName(summary(inactive, "inactive"))


def q_late_hours(spark, sf_dir):
    """Hours that got files after they were landed: the events land, but for errors; the window is landed and its files are
    recorded; then the errors' lines arrive.  Their hours, files and lines, each line's file named by the raw table."""
    from eligo.plans import batch_jobs
    from eligo.sources import ledger
    root = scratch_path(spark, "late_hours")
    land, events = f"{root}/kafka-stream", _events(spark, sf_dir)
    for rows, mode in ((events.where("event_type <> 'error'"), "overwrite"), (events.where("event_type = 'error'"), "append")):
        (S.kafka_landing(S.by_landing_hour(rows)).write.mode(mode)
         .partitionBy("year", "month", "day", "hour").text(land))
        span = S.data_span(events)
        if mode == "overwrite":
            ledger.record_files(ledger.listed_files(spark, land, *span), f"{root}/files")
    late = materialize(ledger.late_files(spark, land, *span, f"{root}/files"), "late_files")
    lines = batch_jobs.land_window(spark, land, *span, f"{root}/raw")
    name = F.regexp_extract("file_path", "[^/]+$", 0)
    own = lines.withColumn("name", name).join(late.select(F.regexp_extract("path", "[^/]+$", 0).alias("name"), "hour", "day", "month", "year"),
                                              ["name", "hour", "day", "month", "year"], "left_semi")
    return own.groupBy("year", "month", "day", "hour").agg(F.countDistinct("file_path").alias("n_files"),
                                                           F.count(F.lit(1)).alias("n_lines"))


def q_compact_small(spark, sf_dir):
    """Many small files a day and one large one, put together by size; for each day: its rows, whether files fell,
    whether the new files' ranges are apart, and whether the large file stayed."""
    from eligo.sinks.publish import compact_small, file_sizes
    ev = _events(spark, sf_dir).withColumn("day", F.col("ts").cast("date"))
    root = scratch_path(spark, "compact_small")
    big = (F.col("event_id") % 2) == 0
    ev.where(big).repartition("day").write.partitionBy("day").parquet(root)
    ev.where(~big).repartition(12).write.mode("append").partitionBy("day").parquet(root)

    def sizes(name):
        return materialize(file_sizes(spark.read.parquet(root), ["day"]), name)
    before = sizes("files_before")
    # The target is between the sizes of the two kinds, so it grows with the table.
    small, large = before.agg(F.percentile("bytes", 0.5), F.max("bytes")).first()
    target = int((small * large) ** 0.5)
    compact_small(spark, root, ["day"], ["event_id"], target)
    after = sizes("files_after")
    kept = before.where(F.col("bytes") >= 0.75 * target).join(after.select("file"), "file", "left_semi").groupBy("day").agg(
        F.count(F.lit(1)).alias("kept"))
    counts = before.groupBy("day").agg(F.count(F.lit(1)).alias("was"), F.count_if(F.col("bytes") >= 0.75 * target).alias("large")).join(
        after.groupBy("day").agg(F.count(F.lit(1)).alias("now")), "day").join(kept, "day", "left")
    back = spark.read.parquet(root).withColumn("file", F.col("_metadata.file_path"))
    ranges = back.groupBy("day", "file").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("lo"), F.max("event_id").alias("hi")) \
        .join(before.select("file", F.lit(True).alias("old")), "file", "left")
    new = ranges.where("old is null").withColumn("next", F.lead("lo").over(Window.partitionBy("day").orderBy("lo")))
    apart = new.groupBy("day").agg(F.every(F.coalesce(F.col("next") > F.col("hi"), F.lit(True))).alias("disjoint"))
    return (ranges.groupBy("day").agg(F.sum("n").alias("n_rows")).join(counts, "day").join(apart, "day", "left")
            .select("day", "n_rows", (F.col("now") < F.col("was")).alias("fewer_files"),
                    F.coalesce("disjoint", F.lit(False)).alias("disjoint"),
                    (F.coalesce("kept", F.lit(0)) == F.col("large")).alias("large_kept")))


def q_compact_check(spark, sf_dir):
    """Write events as many small files per day, compact all days in one pass,
    read back."""
    ev = _events(spark, sf_dir).withColumn("day", F.col("ts").cast("date"))
    root = scratch_path(spark, "compact_check")
    ev.write.mode("overwrite").partitionBy("day").parquet(root)
    compact(spark, root, ["day"], cluster_by=["event_id"], rows_per_file=1000)
    back = spark.read.parquet(root)
    return back.select("event_id", "ts", "user_id", "event_type", "value", "props")


QUERIES: dict[str, Query] = {
    "q_hour_window": q_hour_window,
    "q_path_parts": q_path_parts,
    "q_json_field": q_json_field,
    "q_flatten_legacy": q_flatten_legacy,
    "q_flatten_kafka": q_flatten_kafka,
    "q_epoch_to_ts": q_epoch_to_ts,
    "q_chicago_time": q_chicago_time,
    "q_typed_progress": q_typed_progress,
    "q_stage_legacy": q_stage_legacy,
    "q_stage_kafka": q_stage_kafka,
    "q_dedupe_rows": q_dedupe_rows,
    "q_latest_per_key": q_latest_per_key,
    "q_last_batch": q_last_batch,
    "q_batch_slice": q_batch_slice,
    "q_new_mappings": q_new_mappings,
    "q_matching": q_matching,
    "q_pruned_matches": q_pruned_matches,
    "q_classify": q_classify,
    "q_state_updates": q_state_updates,
    "q_carry_forward": q_carry_forward,
    "q_carry_forward_large": q_carry_forward_large,
    "q_audit_counts": q_audit_counts,
    "q_state_batch": q_state_batch,
    "q_offer_stage": q_offer_stage,
    "q_offer_merge": q_offer_merge,
    "q_merge_bucketed": q_merge_bucketed,
    "q_catalog_tables": q_catalog_tables,
    "q_saved_offers_job": q_saved_offers_job,
    "q_eligibility_job": q_eligibility_job,
    "q_kafka_job": q_kafka_job,
    "q_init_job": q_init_job,
    "q_landing_window": q_landing_window,
    "q_schema_drift": q_schema_drift,
    "q_late_hours": q_late_hours,
    "q_expiry_status": q_expiry_status,
    "q_expiry_split": q_expiry_split,
    "q_expiry_salted": q_expiry_salted,
    "q_clustered_rows": q_clustered_rows,
    "q_compact_check": q_compact_check,
    "q_compact_small": q_compact_small,
}
