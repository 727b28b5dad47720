"""SimHash near-dedup, exact dedup and line dedup against brute force."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from eligo.llm.components import connected_components
from eligo.llm.exact_dedup import exact_dedup
from eligo.llm.line_dedup import boilerplate_lines, line_dedup
from eligo.llm.simhash import links, simhash_dedup
from tests.llm.helpers import awkward, brute_components, brute_fingerprint, docs_frame, sentence, sha


def test_simhash_matches_brute_force(spark):
    rows = awkward(1)
    got = simhash_dedup(docs_frame(spark, rows)).collect()
    fps = [brute_fingerprint(t) for _, t, _, _ in rows]
    comp = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for (i, *_), c in zip(rows, comp, strict=True):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    want = [(i, f"{f:016x}", least.get(c)) for (i, *_), f, c in zip(rows, fps, comp, strict=True)]
    assert Counter(map(tuple, got)) == Counter(want)


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_links_have_the_components_of_all_pairs(spark, distance):
    rng = random.Random(distance)
    fps = set()
    for _ in range(25):  # clouds around centres: pairs at 1 to 6 bits
        c = rng.getrandbits(64)
        for _ in range(8):
            x = c
            for b in rng.sample(range(64), rng.randint(0, 3)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    edges = links(spark.createDataFrame([(x,) for x in signed], "fp bigint"), distance)
    rows = edges.collect()
    assert all(((u ^ v) & ((1 << 64) - 1)).bit_count() <= distance for u, v in rows)
    want = brute_components(fps, lambda a, b: (a ^ b).bit_count() <= distance)
    stars = {r.u: r.v for r in connected_components(edges).collect()}
    got = [stars.get(s, s) for s in signed]
    assert len(set(want)) == len(set(got)) == len(set(zip(want, got, strict=True)))


def test_large_near_copy_group_makes_no_pairs(spark):
    """A cloud of fingerprints around one centre: links stay far below all pairs."""
    rng = random.Random(5)
    fps = {0}
    while len(fps) < 400:
        x = 0
        for b in rng.sample(range(64), 2):
            x ^= 1 << b
        fps.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    rows = links(spark.createDataFrame([(x,) for x in signed], "fp bigint"), 3).collect()
    assert len({r.u for r in rows} | {r.v for r in rows}) == len(fps)
    assert len(rows) < 400 * 64


def _brute_exact(rows):
    groups = {}
    for n, (i, t, *_) in enumerate(rows):
        groups.setdefault(t or "", []).append((i is not None, i or 0, n))
    want = []
    for n, (i, t, *_) in enumerate(rows):
        g = groups[t or ""]
        want.append((i, rows[max(g)[2]][0], len(g), sha(t)))
    return want, len(groups)


@pytest.mark.parametrize("block", [3, 64, 4096])
def test_exact_dedup_matches_brute_force(spark, block):
    rows = awkward(2, 30)
    if block == 3:
        rows = [r for r in rows if len(r[1] or "") < 2000]
    got = exact_dedup(docs_frame(spark, rows), block_bytes=block).collect()
    want, n_groups = _brute_exact(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == Counter(want)
    assert sum(r.kept for r in got) == n_groups
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_survives_colliding_block_keys(spark):
    rows = awkward(3, 20)
    got = exact_dedup(docs_frame(spark, rows), block_bytes=64,
                      key=lambda b: F.unhex(F.substring(F.md5(b), 1, 2))).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == Counter(_brute_exact(rows)[0])


def test_exact_dedup_runs_no_python(spark):
    plan = exact_dedup(docs_frame(spark, awkward(4, 5)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


LINES = [(i, "\n".join([f"own line number {i} of its own", "a line that many sites carry", "short", f"site line {i % 3} again"]
                       + (["only twelve sites have this one"] if i < 12 else [])), "en", f"s{i % 15}") for i in range(40)]
LINES += [(None, "a line that many sites carry\nx", "en", "s3"), (90, None, "en", "s1"), (91, "", "en", "s1"), LINES[5],
          (92, "a line that many sites carry\n\n", "en", None)]


def _brute_lines(rows, min_sites, min_chars=16):
    sites, first = {}, {}
    for i, t, _, s in rows:
        for x in (t or "").split("\n") if t is not None else []:
            if len(x.strip(" ")) >= min_chars:
                sites.setdefault(x, set()).update([s] if s else [])
                if i is not None:
                    first[x] = min(first.get(x, i), i)
    want = []
    for i, t, _, _ in rows:
        ls = [] if t is None else t.split("\n")
        kept = [x for x in ls if len(sites.get(x, ())) < min_sites or first.get(x) == i]
        want.append((i, None if t is None else "\n".join(kept), len(ls), len(ls) - len(kept)))
    return want


@pytest.mark.parametrize("min_sites,limit", [(10, 1_000_000), (12, 1_000_000), (13, 0), (2, 0)])
def test_line_dedup_matches_brute_force(spark, min_sites, limit):
    got = line_dedup(docs_frame(spark, LINES), min_sites=min_sites, max_broadcast_lines=limit)
    assert set(got.columns) >= {"lang", "source", "n_chars", "row", "key", "n_lines", "n_removed"}
    assert Counter(map(tuple, got.select("doc_id", "text", "n_lines", "n_removed").collect())) \
        == Counter(_brute_lines(LINES, min_sites))


def test_lines_near_the_threshold_are_counted_exactly(spark):
    rows = [(i, f"line on {n} sites exactly", "en", f"site{i}") for n in range(28, 37) for i in range(n)]
    bad = boilerplate_lines(docs_frame(spark, rows), min_sites=32, lg_k=4, band=0.9)
    assert bad.count() == 5


@pytest.mark.parametrize("op", [simhash_dedup, exact_dedup, line_dedup])
def test_empty_tables(spark, op):
    assert op(docs_frame(spark, [])).collect() == []


def test_hot_groups_are_split_in_the_last_joins(spark):
    """Broadcast off and low thresholds: AQE splits a text and a fingerprint that most rows share."""
    rows = [(i, "the same words on every page", "en", "s") for i in range(30_000)] + [
        (50_000 + i, sentence(random.Random(i), 6), "en", "s") for i in range(300)]
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}   # several map tasks, as at scale
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        docs = docs_frame(spark, rows).repartition(8)
        for out in (exact_dedup(docs), simhash_dedup(docs)):
            assert len(out.collect()) == len(rows)
            assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
