"""Bucketed catalog tables (S04, D01, D03, D05, D07) and the key bitmap (J01-J03 past the broadcast limit)."""

from __future__ import annotations

import json
import os
import random
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eligo.operators import classify
from eligo.operators.joins import KeyBitmap, anti_join, key_bitmap, key_set, semi_join
from eligo.operators.merge import merge_upsert
from eligo.plans import batch_jobs as J
from eligo.schemas import KEY_COLS, SAVED_OFFER_COLS, SAVED_OFFER_SCHEMA, STATE_COLS, STATE_SCHEMA, Tables
from eligo.sinks import publish
from eligo.sinks.catalog import VersionedTable
from tests.helpers import explain, stage, stage_df, state, state_df, ts

COMPARE = ["start_time", "end_time", "latest_end_time"]


@pytest.fixture()
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def offers_df(spark, rows):
    """(offer_id, start day) rows of the dimension."""
    return spark.createDataFrame([(i, d and ts(d), ts(30), None, 2024, 1, 1, 0) for i, d in rows], SAVED_OFFER_SCHEMA)


def offers_table(spark, tmp_dir, buckets=6, name=None):
    name = name or f"eligo_test.offers_{uuid.uuid4().hex[:8]}"
    return VersionedTable(spark, name, os.path.join(tmp_dir, "offers"), SAVED_OFFER_SCHEMA, ("offer_id",), buckets)


def dimension(df):
    return sorted((r.offer_id is None, r.offer_id or "", str(r.start_time)) for r in df.collect())


def test_merge_reads_the_bucketed_target_as_it_lies(spark, tmp_dir, no_broadcast):
    t = offers_table(spark, tmp_dir).create()
    old = offers_df(spark, [(f"o{i}", 1 + i % 5) for i in range(500)] + [(None, 3)])
    new = offers_df(spark, [(f"o{i}", 2) for i in range(0, 700, 7)] + [(None, 4), ("o3", None)])
    t.write(old, 1)
    merged = t.merged(1, new, COMPARE)
    want = dimension(merge_upsert(old, new, "offer_id", COMPARE))
    assert dimension(merged) == want
    # The target's side of the join: a bucketed scan, and no Exchange between it and the join.
    join = explain(t.merged(1, new, COMPARE), "simple").split("SortMergeJoin", 1)[1].split("Union")[0]
    left = join.split("+- Sort")[0]
    assert "FullOuter" in join and "Bucketed: true" in left and "Exchange" not in left
    t.write(merged, 2, dealt=True)
    assert dimension(t.read(2)) == want and dimension(t.read(1)) == dimension(old)
    assert dimension(publish.read_batch(spark, t.path, 2, SAVED_OFFER_COLS)) == want     # the same folders, read as paths
    files = [f for f in os.listdir(os.path.join(t.path, "batch_id=1")) if f.endswith(".parquet")]
    assert len(files) == 6


def test_a_version_is_replaced_and_others_stay(spark, tmp_dir):
    t = offers_table(spark, tmp_dir, 3).create()
    t.write(offers_df(spark, [("a", 1), ("b", 1)]), 1)
    t.write(offers_df(spark, [("c", 1)]), 2)
    t.write(offers_df(spark, [("d", 1)]), 2)
    assert t.versions() == [1, 2]
    assert [r.offer_id for r in t.read(2).collect()] == ["d"] and t.read(1).count() == 2
    assert "PartitionFilters: [isnotnull(batch_id" in explain(t.read(1), "simple")
    assert not t.create_as(offers_df(spark, [("e", 1)]), 1) and t.read(1).count() == 2     # CTAS IF NOT EXISTS
    assert t.create_as(offers_df(spark, [("e", 1)]), 9) and t.versions() == [1, 2, 9]
    assert t.merged(None, offers_df(spark, [("x", 1)]), COMPARE).count() == 1


def test_another_session_attaches_the_published_versions(spark, tmp_dir):
    t = offers_table(spark, tmp_dir, 4).create()
    for v in (1, 2):
        t.write(offers_df(spark, [(f"o{i}", v) for i in range(40)]), v)
    spark.sql(f"DROP TABLE {t.name}")            # a new session's catalog knows nothing
    again = offers_table(spark, tmp_dir, 4).attach([1])
    assert again.versions() == [1] and again.read(1).count() == 40 and again.read(2).count() == 0
    with pytest.raises(ValueError, match="buckets"):
        VersionedTable(spark, again.name, t.path, SAVED_OFFER_SCHEMA, ("offer_id",), 8).create()
    plain = os.path.join(tmp_dir, "plain")
    publish.write_version(offers_df(spark, [("a", 1)]), plain, 1)
    with pytest.raises(ValueError, match="not written in 4 buckets"):
        VersionedTable(spark, f"eligo_test.plain_{uuid.uuid4().hex[:8]}", plain, SAVED_OFFER_SCHEMA, ("offer_id",), 4).attach([1])


# ---- key bitmap

def key_rows(spark, n, seed=0):
    rng = random.Random(seed)
    return spark.createDataFrame([(f"u{rng.randrange(5000)}", f"o{rng.randrange(300)}") for _ in range(n)], "user_id string, offer_id string")


def test_every_key_meets_its_bit_and_few_others_do(spark):
    keys = key_rows(spark, 3000).dropDuplicates()
    n = keys.count()
    bitmap = key_bitmap(keys, KEY_COLS, n)
    assert isinstance(bitmap, KeyBitmap) and bitmap.bits >= 16 * n
    maybe, surely_not = bitmap.split(keys)
    assert (maybe.count(), surely_not.count()) == (n, 0)
    others = spark.range(20_000).selectExpr("concat('x', id) AS user_id", "'o' AS offer_id", "id AS extra")
    maybe, surely_not = bitmap.split(others)
    assert maybe.count() + surely_not.count() == 20_000 and maybe.count() < 0.12 * 20_000
    assert maybe.columns == others.columns
    nulls = spark.createDataFrame([(None, "o1"), ("u1", None), (None, None)], "user_id string, offer_id string")
    assert bitmap.split(nulls)[0].count() == 0 and bitmap.split(nulls)[1].count() == 3
    empty = key_bitmap(keys.limit(0), KEY_COLS, 0)
    assert empty.split(keys)[1].count() == n


def test_the_bitmap_is_bounded_however_many_keys(spark):
    keys = key_rows(spark, 2000)
    bitmap = key_bitmap(keys, KEY_COLS, 10 ** 12, max_bytes=8192)
    assert bitmap.bits == 65536 and bitmap.blocks.count() <= 2
    assert bitmap.split(keys)[1].count() == 0


@pytest.mark.parametrize("most", [0, 4096, 1 << 20])
def test_filtered_joins_equal_plain_ones(spark, most):
    big = key_rows(spark, 4000, 1).withColumn("v", F.monotonically_increasing_id()).unionByName(
        spark.createDataFrame([(None, "o1", 1), ("u1", None, 2)], "user_id string, offer_id string, v long"))
    keys = key_rows(spark, 900, 2)
    ks = key_set(keys, KEY_COLS, 0, most)
    assert not ks.broadcast and (ks.bitmap is None) == (most == 0)
    assert sorted(r.v for r in anti_join(big, ks, KEY_COLS).collect()) == sorted(
        r.v for r in big.join(keys, KEY_COLS, "left_anti").collect())
    assert sorted(r.v for r in semi_join(big, ks, KEY_COLS).collect()) == sorted(
        r.v for r in big.join(keys, KEY_COLS, "left_semi").collect())


def shuffled_bytes(spark, run) -> int:
    """Shuffle bytes that ``run`` writes, by the status store's stages."""
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway
    none = gateway.jvm.java.util.ArrayList()

    def total():
        stages = store.stageList(none, False, False, gateway.new_array(gateway.jvm.double, 0), none)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))
    before = total()
    run()
    return total() - before


def _large_state(spark, tmp_dir):
    prev = spark.range(60_000).selectExpr("concat('u', id) AS user_id", "concat('o', id % 50) AS offer_id", "id")
    row = state()
    prev = prev.select("user_id", "offer_id", *[F.lit(row[c]).cast(STATE_SCHEMA[c].dataType).alias(c)
                                                for c in STATE_COLS if c not in KEY_COLS]).select(*STATE_COLS)
    path = os.path.join(tmp_dir, "state")
    prev.write.parquet(path)
    incr = stage_df(spark, [stage(f"u{i}", f"o{i % 50}", updated=ts(20)) for i in range(0, 900, 3)] + [stage("new", "o1")])
    return spark.read.parquet(path), incr


def test_the_bitmap_keeps_untouched_state_out_of_the_shuffle(spark, tmp_dir, no_broadcast):
    prev, incr = _large_state(spark, tmp_dir)
    got = {}

    def run(most):
        def once():
            nb = classify.next_batch(incr, prev, 2, max_broadcast_bytes=0, max_bitmap_bytes=most)
            got[most] = nb.carried.select(*KEY_COLS).agg(F.count("*"), F.sum(F.xxhash64(*KEY_COLS).cast("decimal(38,0)"))).first()
        return once
    plain, filtered = shuffled_bytes(spark, run(0)), shuffled_bytes(spark, run(1 << 20))
    assert got[0] == got[1 << 20] and got[0][0] == 60_000 - 300
    assert filtered < 0.2 * plain


def test_a_bucketed_state_is_not_moved_by_classification(spark, tmp_dir, no_broadcast):
    prev, incr = _large_state(spark, tmp_dir)
    columns = STATE_SCHEMA.fields[:-1]
    from pyspark.sql import types as T
    t = VersionedTable(spark, f"eligo_test.state_{uuid.uuid4().hex[:8]}", os.path.join(tmp_dir, "cat"), T.StructType(columns),
                       tuple(KEY_COLS), 4).create()
    t.write(prev, 1)
    nb = classify.next_batch(incr, t.read(1), 2, max_broadcast_bytes=0, buckets=4)
    plan = explain(nb.carried, "simple").split("SortMergeJoin", 1)[1]
    want = classify.next_batch(incr, prev, 2)
    for a, b in ((nb.updates, want.updates), (nb.carried, want.carried)):
        assert a.count() == b.count() and a.exceptAll(b).count() == 0
    left = plan.split("+- Sort")[0]
    assert "Bucketed: true" in left and "Exchange" not in left
    assert t.untouched(1, incr).count() == want.carried.count()


# ---- the jobs on catalog tables

def _land(root, hour, lines):
    d = os.path.join(root, f"year={hour:%Y}", f"month={hour:%m}", f"day={hour:%d}", f"hour={hour:%H}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "part-0.json"), "w") as f:
        f.write("\n".join(lines) + "\n")


def _offer_line(i, start):
    return json.dumps({"id": f"o{i}", "startTime": start, "endTime": start + 10, "eligibilityRequirement": {"latestEndTime": start + 5}})


def _snapshot(user, updated, offers):
    return json.dumps({"user_id": user, "updated_timestamp_ms": updated, "offers": [
        {"offer_id": o, "start_timestamp_ms": updated, "potentially_eligible_in_future": False} for o in offers]})


def test_jobs_on_catalog_tables_equal_jobs_on_folders(spark, tmp_dir):
    buckets = 5
    offers, snaps = os.path.join(tmp_dir, "offers"), os.path.join(tmp_dir, "kafka-stream")
    h = [datetime(2024, 3, 1, i) for i in range(4)]
    ms = 1_709_000_000_000
    _land(offers, h[0], [_offer_line(i, ms) for i in range(30)])
    _land(offers, h[1], [_offer_line(i, ms + 60_000 * i) for i in range(20, 40)] + ["{broken"])
    _land(snaps, h[0], [_snapshot(f"u{i}", ms, [f"o{i}", "o99"]) for i in range(25)])
    _land(snaps, h[1], [_snapshot(f"u{i}", ms + 5000, [f"o{i}"]) for i in range(10, 30)])
    seen = {}
    for kind, database in (("folders", None), ("catalog", f"eligo_jobs_{uuid.uuid4().hex[:8]}")):
        tables = Tables.for_raw_path(os.path.join(tmp_dir, kind), snaps, database, buckets if database else 0)
        for a, b in ((h[0], h[1]), (h[1], h[2]), (h[1], h[2])):
            J.run_saved_offers(spark, tables, offers, a, b)
            res = J.run_increment(spark, tables, snaps, a, b, max_broadcast_bytes=0 if buckets else 1 << 20)
            assert res.audit.problems() == []
        seen[kind] = (dimension(J.current_saved_offers(spark, tables)),
                      sorted(map(str, J.read_state(spark, tables).drop("batch_id").collect())), res.audit, res.batch_id)
    assert seen["folders"] == seen["catalog"]
    audit = seen["catalog"][2]
    assert audit.rows == audit.update_rows + audit.carried_rows == audit.previous_rows == 55
    # Read by name, after the session's catalog has lost the tables.
    for name in spark.catalog.listTables(database):
        spark.sql(f"DROP TABLE {database}.{name.name}")
    names = J.register_tables(spark, tables, database, h[0], h[2])
    state_name = next(n for n in names if n.endswith("current_state_active_kafka"))
    by_version = {r.batch_id: r["count"] for r in spark.table(state_name).groupBy("batch_id").count().collect()}
    assert len(by_version) == 3 and by_version[res.batch_id] == 55


def test_init_writes_its_catalog_tables_once(spark, tmp_dir):
    dump = os.path.join(tmp_dir, "snapshot=7")
    state_df(spark, [state("u1"), state("u2", "o2")]).drop("expiry_status", "batch_id").write.parquet(dump)
    tables = Tables(os.path.join(tmp_dir, "wh"), "legacy", f"eligo_init_{uuid.uuid4().hex[:8]}", 3)
    left = J.state_table(spark, tables)              # a run that stopped before it was published
    left.write(state_df(spark, [state("gone")]).drop("batch_id"), 7)
    out = J.run_init(spark, tables, dump, ts(1).date())
    assert out == {"batch_id": 7, "active_rows": 2, "inactive_rows": 0}
    assert J.state_table(spark, tables).read(7).count() == 2
    with pytest.raises(ValueError, match="already"):
        J.run_init(spark, tables, dump, ts(1).date())


# ---- audit by observation

def test_observed_counts_equal_a_second_reading(spark, tmp_dir):
    path = os.path.join(tmp_dir, "state")
    prev = state_df(spark, [state(f"u{i}") for i in range(50)] + [state(None, "o1")])
    incr = stage_df(spark, [stage(f"u{i}", updated=ts(20)) for i in range(40, 60)] + [stage("u41", updated=ts(20), pct=None)])
    nb = classify.next_batch(incr, prev, 2, keep_touched=True)
    counts = publish.observed_write(nb.updates, nb.carried, lambda rows, watch: publish.write_batch(watch(rows), path, 2))
    written = publish.read_batch(spark, path, 2)
    got = publish.audit_observed(counts, written, nb.updates, nb.touched, 51, 2)
    assert got == publish.audit_batch(spark, path, 2, nb.updates, prev) and got.problems() == []
    # Lost carried rows, and a key both updated and carried, are found.
    for spoil, fault in ((lambda c: c.limit(5), "carried rows"), (lambda c: c.unionByName(
            prev.where("user_id = 'u45'").withColumn("batch_id", F.lit(2).cast("bigint"))), "also has carried rows")):
        counts = publish.observed_write(nb.updates, spoil(nb.carried), lambda rows, watch: publish.write_batch(watch(rows), path, 2))
        problems = publish.audit_observed(counts, publish.read_batch(spark, path, 2), nb.updates, nb.touched, 51, 2).problems()
        assert any(fault in p for p in problems)
