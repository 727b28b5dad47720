"""Schema drift, the offer-bucket layout, compaction by file size and the ledger of landed files."""

from __future__ import annotations

import json
import os
import random
from collections import Counter
from datetime import datetime

from pyspark.sql import functions as F

from eligo.operators import classify, drift, flatten
from eligo.operators.joins import pruned_semi_join, with_offer_bucket
from eligo.plans import batch_jobs as J
from eligo.schemas import KEY_COLS, OFFER_BUCKET, STATE_COLS, Tables
from eligo.sinks import publish
from eligo.sources import landing, ledger
from tests.helpers import explain, stage, stage_df, state, state_df, ts

# ---- drift


def walk(x, path="$"):
    kinds = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}
    yield path, kinds.get(type(x), "number")
    for k, v in x.items() if isinstance(x, dict) else [(None, v) for v in x] if isinstance(x, list) else []:
        yield from walk(v, f"{path}[*]" if k is None else f"{path}.{k}")


def random_json(rng, depth=0):
    if depth > 3 or rng.random() < 0.4:
        return rng.choice([1, -2.5, 10 ** 20, "x", "", True, None, 1e300])
    if rng.random() < 0.4:
        return [random_json(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    return {rng.choice("abcé"): random_json(rng, depth + 1) for _ in range(rng.randint(0, 4))}


def test_drift_counts_lines_of_every_path_and_type(spark):
    rng = random.Random(4)
    docs = [{"user_id": "u", "offers": [{"offer_id": 1, "new": random_json(rng)} for _ in range(rng.randint(0, 3))],
             "more": random_json(rng)} for _ in range(60)]
    lines = [json.dumps(d) for d in docs] + ["{broken", "[1]", "null", "7", ""]
    landed = spark.createDataFrame([(x,) for x in lines], "line string").select(landing.parsed("line").alias("data"))
    got = {(r.path, r.type): (r.n_lines, r.known) for r in drift.drift(landed.repartition(3), flatten.KAFKA_SCHEMA).collect()}
    want = Counter(p for d in docs for p in set(walk(d)))
    known = set(drift.schema_paths(flatten.KAFKA_SCHEMA))
    assert got == {k: (n, k[0] in known) for k, n in want.items()}
    assert ("$.offers[*].new", "object") in got and not got[("$.offers[*].new", "object")][1] and got[("$.user_id", "string")] == (60, True)
    assert drift.field_types(landed.limit(0)).count() == 0


def test_unknown_offer_fields_survive_in_raw(spark, tmp_dir):
    d = os.path.join(tmp_dir, "land", "year=2024", "month=01", "day=16", "hour=00")
    os.makedirs(d)
    with open(os.path.join(d, "a.json"), "w") as f:
        f.write('{"user_id": "u", "updated_timestamp_ms": 1705363200000, "offers": [{"offer_id": "o", "colour": "red"}]}\n')
    window = datetime(2024, 1, 16, 0), datetime(2024, 1, 16, 1)
    raw = J.land_window(spark, os.path.join(tmp_dir, "land"), *window, os.path.join(tmp_dir, "raw"))
    got = raw.select(F.try_variant_get("data", "$.offers[0].colour", "string").alias("colour"), "file_path").first()
    assert got.colour == "red" and got.file_path.endswith("hour=00/a.json")
    assert "parse_json" not in explain(flatten.kafka(flatten.landed_fields(raw, "kafka"))).lower()   # the line is not parsed again


def test_legacy_progress_as_object_and_as_text(spark):
    offers = [{"offerId": "a", "progress": {"type": "t", "uses": 3}}, {"offerId": "b", "progress": json.dumps({"type": "s", "uses": 4})},
              {"offerId": "c", "progress": None}, {"offerId": "d", "progress": "no json"}, {"offerId": "e"}]
    payloads = [(json.dumps({"userId": "u", "updated": 1705363200000, "offers": offers}),), ('{"offers": {}}',), ("[]",), (None,)]
    got = flatten.legacy(spark.createDataFrame(payloads, "payload string")).select("offer_id", "progress_type", "progress_uses").collect()
    assert [tuple(r) for r in got] == [("a", "t", "3"), ("b", "s", "4"), ("c", None, None), ("d", None, None), ("e", None, None)]


# ---- second partition level

def test_the_increments_offers_prune_the_state_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "state")
    prev = state_df(spark, [state(f"u{i}", f"o{i % 40}") for i in range(400)] + [state("u1", None), state(None, "o2")])
    publish.write_batch(with_offer_bucket(prev, 16), path, 1, [OFFER_BUCKET])
    back = publish.read_batch(spark, path, 1, [*STATE_COLS, OFFER_BUCKET])
    assert back.select(*STATE_COLS).exceptAll(prev).count() == 0 and back.count() == 402
    incr = stage_df(spark, [stage(f"u{i}", "o3", updated=ts(20)) for i in range(0, 100)] + [stage(None, "o3"), stage("u9", None)])
    touched = pruned_semi_join(back, incr, KEY_COLS, 16)
    assert "dynamicpruning" in explain(touched).lower()
    assert touched.count() == prev.join(incr, KEY_COLS, "left_semi").count() == 3
    # Run time: the scan read one directory of sixteen.
    def leaves(p):
        name = p.getClass().getSimpleName()
        if name.startswith("AdaptiveSparkPlan"):
            return leaves(p.executedPlan())
        if name.endswith("QueryStageExec"):
            return leaves(p.plan())
        kids = p.children()
        return [x for i in range(kids.size()) for x in leaves(kids.apply(i))] if kids.size() else [p]
    touched.collect()
    scans = [p for p in leaves(touched._jdf.queryExecution().executedPlan()) if p.getClass().getSimpleName() == "FileSourceScanExec"]
    assert [p.metrics().apply("numPartitions").value() for p in scans if p.metrics().contains("numPartitions")] == [1]
    for most in (0, 1 << 20):
        a = classify.next_batch(incr, back, 2, max_broadcast_bytes=most, offer_buckets=16)
        b = classify.next_batch(incr, prev, 2)
        for x, y in ((a.updates, b.updates), (a.carried, b.carried)):
            assert x.count() == y.count() and x.exceptAll(y).count() == 0


# ---- compaction by size

def files_of(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_only_small_files_are_put_together(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    rows = spark.range(0, 40_000).select(F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("x"),
                                         F.concat(F.lit("a b:"), F.col("id") % 3).alias("part"))
    rows.where("id < 30000").coalesce(1).write.partitionBy("part").parquet(path)
    large = files_of(path)
    rows.where("id >= 30000").repartition(10).write.mode("append").partitionBy("part").parquet(path)
    sizes = {r["file"]: r["bytes"] for r in publish.file_sizes(spark.read.parquet(path), ["part"]).collect()}
    assert len(sizes) == len(files_of(path)) == 33
    target = min(os.path.getsize(f) for f in large)
    replaced = publish.compact_small(spark, path, ["part"], ["id"], target)
    assert replaced == 30
    now = files_of(path)
    assert large <= now and len(now) - len(large) < 10
    back = spark.read.parquet(path)
    assert back.count() == 40_000 and back.exceptAll(rows).count() == 0
    assert publish.compact_small(spark, path, ["part"], ["id"], 1) == 0      # nothing is small
    assert publish.compact_small(spark, path, ["part"], ["id"], target, where=F.col("part") == "none") == 0


def test_groups_of_small_files(spark):
    sizes = spark.createDataFrame([("d1", f"f{i}", b) for i, b in enumerate([10, 20, 80, 30, 50, 70, 5])] + [("d2", "only", 5)],
                                  "day string, file string, bytes bigint")
    got = {r["file"]: r["group"] for r in publish.small_file_groups(sizes, ["day"], 100).collect()}
    assert got == {"f0": 0, "f1": 0, "f3": 0, "f4": 0, "f5": 1, "f6": 1}     # 80 is large; a lone small file stays


# ---- late files

def land(root, hour, name, lines):
    d = os.path.join(root, f"year={hour:%Y}", f"month={hour:%m}", f"day={hour:%d}", f"hour={hour:%H}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def snapshot(user, updated, offer="o1"):
    return json.dumps({"user_id": user, "updated_timestamp_ms": updated, "offers": [
        {"offer_id": offer, "start_timestamp_ms": updated, "potentially_eligible_in_future": False}]})


def test_late_files_name_the_hours_to_run_again(spark, tmp_dir):
    root = os.path.join(tmp_dir, "kafka-stream")
    h = [datetime(2024, 3, 1, 22), datetime(2024, 3, 1, 23), datetime(2024, 3, 2, 0), datetime(2024, 3, 2, 1)]
    end, ms = datetime(2024, 3, 2, 2), 1_709_330_400_000
    for i, hour in enumerate(h):
        land(root, hour, "a.json", [snapshot(f"u{i}", ms + 3_600_000 * i)])
    tables = Tables.for_raw_path(os.path.join(tmp_dir, "wh"), root)
    assert J.run_late(spark, tables, os.path.join(tmp_dir, "nothing"), h[0], end) == []
    J.run_increment(spark, tables, root, h[0], end)
    assert J.run_late(spark, tables, root, h[0], end) == []
    land(root, h[1], "b.json", [snapshot("late", ms + 3_600_000), snapshot("u3", ms)])     # a new key; an old version, stale
    land(root, h[2], "b.json", [snapshot("u0", ms + 9_000_000)])                           # a fresher version
    hours = ledger.late_hours(spark, root, h[0], end, tables.raw_files)
    assert sorted((r.day, r.hour, r.n_files) for r in hours.collect()) == [(1, 23, 1), (2, 0, 1)]
    assert ledger.windows(hours) == [(h[1], h[3])]
    runs = J.run_late(spark, tables, root, h[0], end)
    assert len(runs) == 1 and runs[0].audit.problems() == []
    assert runs[0].rule_counts.get("N1") == 1 and runs[0].rule_counts.get("stale", 0) >= 3
    got = {r.user_id: r.updated for r in J.read_state(spark, tables).collect()}
    assert set(got) == {"u0", "u1", "u2", "u3", "late"} and got["u0"] > got["u1"]
    assert J.run_late(spark, tables, root, h[0], end) == []
