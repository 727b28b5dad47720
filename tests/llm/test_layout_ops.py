"""Sharding, chat formatting, WARC and packing: brute force and exact round trips."""

from __future__ import annotations

import base64
import hashlib
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eligo.llm.chat import CONTROL, escape, format_conversations, read_loss_text, read_turns, unescape
from eligo.llm import packing
from eligo.llm.config_lp import best_fit, contents, cover, knapsack, lower_bound, plan, rows_of
from eligo.llm.packing import WordTokens, pack, sequences
from eligo.llm.queries import tokenizer_path
from eligo.llm.shard import Leaf, assign_shards, descend, grow, layout
from eligo.llm import warc
from eligo.llm.warc import arrow_uri, read_warc, write_warc
from tests.llm.helpers import awkward, docs_frame

# ---- sharding


def test_shards_slots_and_growth(spark):
    rows = [(i, f"text {i}", "en", "s") for i in range(6000)] + awkward(1, 10) + [(1, None, None, None)]
    tree = layout(24)
    got = assign_shards(docs_frame(spark, rows).repartition(7), tree, grow(tree)).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"key"}
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(24))
    n = [len(s) for s in slots.values()]
    assert 0.6 * len(rows) / 24 < min(n) and max(n) < 1.4 * len(rows) / 24
    moved = sum(r.grown_shard == 24 for r in got)
    assert 0.6 * len(rows) / 25 < moved < 1.4 * len(rows) / 25
    by_id = defaultdict(set)
    for r in got:
        by_id[r.doc_id].add((r.shard, r.grown_shard))
    assert all(len(v) == 1 for v in by_id.values())
    size = Counter((r.doc_id, r.size, r.text_crc32) for r in got)
    assert size == Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)


def test_weight_changes_move_rows_only_into_the_heavier_subtree(spark):
    tree = layout(24)
    heavy = [Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else 1.0) for x in tree]
    keys = spark.range(4000).select(F.col("id").cast("string").alias("k"))
    both = descend(descend(keys, "k", tree, "a"), "k", heavy, "b").collect()
    region = {x.shard: x.region for x in tree}
    rack = {x.shard: (x.region, x.rack) for x in tree}
    for r in both:
        if region[r.a] != region[r.b]:
            assert region[r.b] == region[5]
        elif rack[r.a] != rack[r.b]:
            assert rack[r.b] == rack[5]
        elif r.a != r.b:
            assert r.b == 5
    assert sum(r.b == 5 for r in both) > 1.8 * sum(r.a == 5 for r in both)


def test_shards_of_nothing_and_bad_weights(spark):
    assert assign_shards(docs_frame(spark, []), layout(3)).collect() == []
    with pytest.raises(ValueError):
        assign_shards(docs_frame(spark, []), [Leaf("g", "r", 0, 0.0), Leaf("g", "r", 1)])


# ---- chat

def _conversations():
    rng = random.Random(3)
    bits = [*CONTROL, "\\", "<", "[", "x", "\n", "é", "😀", "s>", "INST]", "", "[\\INST]", "$1"]
    rows = []
    for c in range(30):
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "a[ROLE]b", None]),
                         "".join(rng.choice(bits) for _ in range(rng.randint(0, 8))) if rng.random() < .9 else None))
    rows += [rows[0], (50, None, "assistant", None), (None, 1, "user", "no id"), (51, 0, "assistant", "y" * 200_000)]
    return rows


def test_chat_round_trip(spark):
    rows = _conversations()
    turns = spark.createDataFrame([(*r, 1, "z") for r in rows],
                                  "conv_id bigint, turn bigint, role string, text string, conv int, p string")
    out = format_conversations(turns).select(
        "conv_id", "formatted", read_turns(F.col("formatted")).alias("turns"),
        read_loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"), "loss_spans").collect()
    want = defaultdict(list)
    for c, t, r, x in rows:
        want[c].append((t is not None, t or 0, r or "", x or ""))
    assert len(out) == len(want)
    for o in out:
        turns_ = [(r, x) for _, _, r, x in sorted(want[o.conv_id])]
        assert [(t.role, t.text) for t in o.turns] == turns_
        assert o.loss == "".join(x for r, x in turns_ if r == "assistant")
        assert len(o.loss_spans) == sum(r == "assistant" for r, _ in turns_)
        blocks = 1 + sum(a[0] != b[0] for a, b in zip(turns_, turns_[1:], strict=False))
        assert o.formatted.count("</s>") == o.formatted.count("[ROLE]") == blocks
        assert o.formatted.count("[NEXT]") == len(turns_) - blocks and o.formatted.count("<s>") == 1


def test_escape_hides_every_control_string(spark):
    texts = [*CONTROL, *(a + b for a in CONTROL for b in ("\\", "[", "<", a)), "\\", "\\\\n", "[\\INST]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in CONTROL)


def test_chat_of_nothing(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert format_conversations(none).collect() == []


# ---- WARC

PAGES = [(i, f"http://x.example/{i}", f"<html>{'common words here ' * 20}{i % 40}</html>") for i in range(120)]
PAGES += [(200, None, None), (201, "u\r\nv", ""), (None, "n", "<p>only null ids</p>"), (None, "n", "<p>only null ids</p>"),
          (202, "big", "é" * 3_000_000), PAGES[3], (203, "http://x", "small"), (90_000, "x", PAGES[0][2])]


@pytest.mark.parametrize("min_bytes,sample", [(0, {}), (100, {"sample_records": 0}), (0, {"file_bytes": 2000})])
def test_warc_round_trip(spark, min_bytes, sample):
    pages = spark.createDataFrame([(*p, 1, "f") for p in PAGES], "page_id bigint, url string, html string, row int, file string")
    index = write_warc(pages, min_bytes=min_bytes, **sample)
    got = read_warc(index).collect()
    groups = defaultdict(list)
    for i, _, h in PAGES:
        groups[h or ""].append(i)
    want = Counter()
    for i, _, h in PAGES:
        body = (h or "").encode()
        want[(None if i is None else str(i), len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == want
    held = Counter(r.payload_digest for r in got if r.record_type == "response")
    for h, ids in groups.items():
        digest = base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
        real = [i for i in ids if i is not None]
        if len(h.encode()) < min_bytes:
            assert held[digest] == len(ids)
            continue
        assert held[digest] == 1
        for r in got:
            if r.payload_digest == digest:
                first = str(min(real)) if real else None
                if r.record_type == "response":
                    assert r.page_id == first and r.refers_to is None and bytes(r.payload) == h.encode()
                else:
                    assert r.refers_to == first and r.payload is None
    assert index.count() == len(PAGES)


def test_warc_of_nothing(spark):
    index = write_warc(spark.createDataFrame([], "page_id bigint, url string, html string"))
    assert index.count() == 0 and read_warc(index).collect() == []


def test_archives_are_read_by_as_many_tasks_as_there_are_files(spark):
    index = write_warc(spark.range(0, 4000, 1, 24).selectExpr(
        "id AS page_id", "concat('u', id) AS url", "repeat(concat('page ', id), 20) AS html"), file_bytes=4000)
    n = index.select("file").distinct().count()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        records = read_warc(index)
        per_task = records.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert n > 16 and len(per_task) == 16 and sum(r["count"] for r in per_task) == 4000
        assert max(r["count"] for r in per_task) < 3 * 4000 / 16
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_verdicts_join_by_shuffle_beyond_the_broadcast_limit(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"u{i}", f"body {i % 7}") for i in range(60)] + [(None, None, "body 3"), (5, "u5", "body 5")],
                                  "page_id bigint, url string, html string")
    want = sorted(map(str, read_warc(write_warc(pages)).drop("payload").collect()))
    monkeypatch.setattr(warc, "MOST_BROADCAST_ROWS", -1)
    assert sorted(map(str, read_warc(write_warc(pages)).drop("payload").collect())) == want


def test_addresses_of_shared_folders():
    assert arrow_uri("s3a://bucket/x/y") == arrow_uri("s3n://bucket/x/y") == "s3://bucket/x/y"
    assert arrow_uri("/data/x") == "/data/x" and arrow_uri("file:/data/x") == arrow_uri("file:///data/x") == "/data/x"
    assert arrow_uri("hdfs://host:9000/x") == "hdfs://host:9000/x"
    with pytest.raises(ValueError):
        arrow_uri("viewfs://store/x")


# ---- packing

def _check_bins(bins, hist, capacity):
    used = Counter()
    for config, uses in bins:
        assert uses >= 1 and sum(n * k for n, k in config) <= capacity
        for n, k in config:
            used[n] += k * uses
    assert used == Counter(hist)


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_every_piece_and_is_near_the_bound(seed):
    rng = random.Random(seed)
    capacity = rng.choice([16, 100, 1000])
    hist = Counter(min(capacity, 1 + int(rng.expovariate(6 / capacity))) for _ in range(rng.choice([1, 50, 5000])))
    bins = plan(dict(hist), capacity)
    _check_bins(bins, hist, capacity)
    total = sum(n * c for n, c in hist.items())
    assert sum(u for _, u in bins) <= -(-total // capacity) + max(1, total // capacity // 50)


def test_configuration_program_beats_greedy_where_greedy_is_wrong():
    """Pieces of 6, 4 and 3 in bins of 10: greedy halves are fine, threes need four to a 13."""
    hist = {7: 300, 6: 300, 4: 300, 3: 300}
    assert sum(u for _, u in plan(hist, 10)) == 600
    _check_bins(best_fit({5: 7, 2: 3, 1: 1}, 5), {5: 7, 2: 3, 1: 1}, 5)
    assert plan({}, 10) == []


@pytest.mark.parametrize("hist,most", [
    ({2049: 8000, 1024: 8000, 1020: 8000}, 8000), ({2100: 8000, 1365: 8000, 600: 8000}, 8000),
    ({2089: 6000, 1065: 6000, 1024: 12000, 983: 12000}, 10500),   # best-fit alone: 12,000
    ({n: 1000 + n % 7 * 900 for n in range(700, 2500, 61)}, 43200)])  # best-fit alone: 43,674
def test_spiky_histograms_are_packed_near_the_dual_bound(hist, most):
    bins = plan(dict(hist), 4096)
    _check_bins(bins, hist, 4096)
    rows = rows_of(hist, 4096)
    found = cover(rows, 4096)
    value, held = sum(x for _, x in found.columns), Counter()
    for c, x in found.columns:
        assert sum(int(rows.size[i]) * k for i, k in c) <= 4096
        for i, k in c:
            held[int(rows.size[i])] += k * x
    assert all(held[n] >= c * (1 - 1e-6) for n, c in hist.items())
    n, bound = sum(u for _, u in bins), lower_bound(hist, rows, found, 4096)
    assert found.bound <= value + 1e-6 <= 1.01 * found.bound and bound <= n + 1e-6 and n <= most
    assert found.value == pytest.approx(value) and bound >= 0.99 * found.bound


def _normal(n, mean, spread, seed=0):
    return dict(Counter(np.clip(np.random.default_rng(seed).normal(mean, spread, n).round().astype(int), 1, 4096).tolist()))


@pytest.mark.parametrize("hist", [
    _normal(100_000, 1500, 300), _normal(60_000, 1800, 500, 1), _normal(3000, 1100, 400, 2),
    dict(Counter(random.Random(3).randint(1100, 2600) for _ in range(8000)))], ids=["broad", "broader", "few", "flat"])
def test_broad_histograms_come_within_a_hundredth_of_the_dual_bound(hist):
    """Best-fit alone is 0.5 to 4 % off on these; thousands of lengths cost seconds, not minutes."""
    begun = time.process_time()
    bins = plan(hist, 4096)
    assert time.process_time() - begun < 40
    _check_bins(bins, hist, 4096)
    rows = rows_of(hist, 4096)
    found = cover(rows, 4096)
    n = sum(u for _, u in bins)
    assert n <= 1.01 * lower_bound(hist, rows, found, 4096) + 1
    assert n <= sum(u for _, u in best_fit(hist, 4096))


def test_the_plan_takes_its_sequences_from_the_program(monkeypatch):
    """Every histogram goes through the program, also where best-fit alone would reach the size bound."""
    from eligo.llm import config_lp
    calls = []
    real = config_lp.cover
    monkeypatch.setattr(config_lp, "cover", lambda *a, **k: calls.append(1) or real(*a, **k))
    for hist in ({5: 3, 1: 7}, {4096: 2}, {2048: 2, 1: 1}):
        _check_bins(config_lp.plan(hist, 4096), hist, 4096)
    assert len(calls) == 3


@pytest.mark.parametrize("seed", range(5))
def test_knapsack_is_the_dearest_contents_of_each_room(seed):
    rng = random.Random(seed)
    size = np.array(sorted(rng.sample(range(2, 14), 4)))
    price, unit = np.array([rng.random() for _ in size]), rng.choice([0.0, 0.05])
    worth, choice = knapsack(size, price, unit, 30)
    brute = [0.0]
    for w in range(1, 31):
        brute.append(max([brute[w - 1] + unit, *(brute[w - n] + p for n, p in zip(size.tolist(), price.tolist(), strict=True) if n <= w)]))
    assert worth.tolist() == pytest.approx(brute)
    for w in range(31):
        held = contents(w, choice, size)
        used = sum(int(size[i]) * k for i, k in held.items())
        assert used <= w and sum(price[i] * k for i, k in held.items()) + unit * (w - used) >= worth[w] - 1e-9


def test_rows_hold_every_length_and_small_pieces_are_tokens():
    hist = {n: n % 5 + 1 for n in range(1, 4097)}
    rows = rows_of(hist, 4096)
    assert [n for r in rows.lengths for n in r] == list(range(257, 4097)) and len(rows.size) < 900
    assert rows.small == sum(n * hist[n] for n in range(1, 257))
    assert all(s == r[-1] and c == sum(hist[n] for n in r) for s, c, r in zip(rows.size, rows.need, rows.lengths, strict=True))


def test_tokens_equal_the_tokenizers(monkeypatch):
    """Against an untouched tokenizer, which takes the strings of its added tokens for those tokens."""
    whole = Tokenizer.from_file(tokenizer_path())
    monkeypatch.setattr(packing, "CACHE_WORDS", 50)    # generations change all the time
    words = WordTokens(tokenizer_path())
    rng = random.Random(9)
    alphabet = ["a", "B", "É", "ß", "ÿ", " ", "\n", "\t", "'s", "'LL", "1", "٣", "_", "-", "<|endoftext|>", "<|startoftext|>", "<|END", "|>",
                "İ", "Σ", "é", "́", "ﬁ", "漢", " ", "\x1c", "👍", "½", "²", "​", "µ", "×", "\r", "\x00", "word"]
    for _ in range(2500):
        s = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 16)))
        assert np.frombuffer(words.encode(s), "<u4").tolist() == whole.encode(s, add_special_tokens=False).ids, s
    assert np.frombuffer(words.encode("a<|endoftext|>b <|startoftext|>"), "<u4").tolist()[1::2] == [49407, 49406]


def test_ranks_join_by_shuffle_beyond_the_broadcast_limit(spark, monkeypatch):
    rows = awkward(3, 30)
    want = sorted((r.doc_id or -1, r.piece, r.length) for r in pack(docs_frame(spark, rows), tokenizer_path(), capacity=64).collect())
    monkeypatch.setattr(packing, "MOST_BROADCAST_ROWS", 0)
    packed = pack(docs_frame(spark, rows), tokenizer_path(), capacity=64)
    assert "BroadcastHashJoin" not in packed._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.doc_id or -1, r.piece, r.length) for r in packed.collect()) == want


def test_packing_round_trip(spark):
    rows = awkward(7, 80)
    packed = pack(docs_frame(spark, rows).repartition(5), tokenizer_path(), capacity=64, with_ids=True)
    got = packed.collect()
    words = WordTokens(tokenizer_path())
    want = Counter()
    for i, t, *_ in rows:
        ids = words.encode(t or "") + np.array([1], "<u4").tobytes()
        for p, a in enumerate(range(0, len(ids), 256)):
            want[(i, p, a // 4, len(ids[a:a + 256]) // 4, zlib.crc32(ids[a:a + 256]))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in got)
    assert len(bins) <= 1.05 * -(-total // 64) + 1
    assert {r.sequence_id: r.n_tokens for r in sequences(packed).collect()} == {
        k: sum(n for _, n in b) for k, b in bins.items()}
    assert all(len(r.ids) == 4 * r.n_tokens for r in sequences(packed).collect())


def test_packing_of_nothing(spark):
    assert pack(docs_frame(spark, []), tokenizer_path()).collect() == []
