"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Texts become word sequences; the patterns are the benchmark's windows.  For the
patterns of one length, a shift table over blocks of two words says how far the
scan may jump (most blocks of a text are in no pattern, so it jumps nearly a
whole window).  Where the shift is 0, the block picks a bucket of patterns by
their suffix, the first block picks those of equal prefix, and a direct
comparison of the words confirms each occurrence.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eligo.llm.common import materialize, pick, type_of

#: A-Z to a-z; every other byte below 0x80 but 0-9 and a-z separates words.
_TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256))
SPANS = "array<struct<start:int,length:int>>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_TO_WORDS).split() if text else []


class WuManber:
    """Patterns of one length ``m`` (tuples of words), each with a payload list."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list[str]]):
        self.m = m = len(next(iter(patterns)))
        self.b = b = min(2, m)
        self.far = m - b + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict] = defaultdict(lambda: defaultdict(list))
        for p, items in patterns.items():
            for end in range(b, m + 1):
                block = p[end - b:end]
                self.shift[block] = min(self.shift.get(block, self.far), m - end)
            self.buckets[p[m - b:]][p[:b]].append((list(p), items))
        self.buckets = {k: dict(v) for k, v in self.buckets.items()}

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list[str]]]:
        m, b, far, shift = self.m, self.b, self.far, self.shift
        end, n = m, len(words)
        while end <= n:
            block = tuple(words[end - b:end])
            jump = shift.get(block, far)
            if jump:
                end += jump
                continue
            start = end - m
            for pattern, items in self.buckets[block].get(tuple(words[start:start + b]), ()):
                if words[start:end] == pattern:
                    yield start, items
            end += 1


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching (start, length) spans as disjoint ones."""
    out: list[list[int]] = []
    for s, n in sorted(spans):
        if out and s <= out[-1][0] + out[-1][1]:
            out[-1][1] = max(out[-1][1], s + n - out[-1][0])
        else:
            out.append([s, n])
    return [(s, n) for s, n in out]


def benchmark_windows(bench: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """``(words, item)``: the distinct windows of each item, words space-joined.

    An item of fewer words than a window, but not none, is one window.  A null
    item id is the string ``null``.
    """
    src = pick(bench, item=item_col, text=text_col).select(
        F.coalesce(F.col("item").cast("string"), F.lit("null")).alias("item"),
        F.col("text").cast("binary").alias("text"))

    def run(batches):
        for b in batches:
            for item, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                w = words_of(text.as_py())
                wins = {b" ".join(w[i:i + window]) for i in range(max(1, len(w) - window + 1))} if w else set()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sorted(wins), pa.binary()), pa.array([item] * len(wins), pa.string())],
                    names=["words", "item"])

    return src.mapInArrow(run, "words binary, item string").distinct()


def matchers_of(rows: list[tuple[bytes, str]]) -> list[WuManber]:
    """A matcher for each length of pattern; rows are (space-joined words, item)."""
    by_length: dict[int, dict] = defaultdict(dict)
    seen: dict[bytes, bytes] = {}
    for words, item in rows:
        p = tuple(seen.setdefault(w, w) for w in words.split(b" "))
        by_length[len(p)].setdefault(p, []).append(item)
    return [WuManber(p) for p in by_length.values()]


def _scan(src: DataFrame, patterns, keep: str) -> DataFrame:
    """(keep, text) rows -> (keep, n_words, spans, items); ``patterns`` is a broadcast."""
    def run(batches):
        matchers = matchers_of(patterns.value)
        for b in batches:
            n_words, spans, items = [], [], []
            for text in b.column(1):
                w = words_of(text.as_py())
                found, hit = set(), []
                for wm in matchers:
                    for start, names in wm.find(w):
                        found.update(names)
                        hit.append((start, wm.m))
                n_words.append(len(w))
                spans.append([{"start": s, "length": n} for s, n in merged(hit)])
                items.append(sorted(found))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())]))),
                 pa.array(items, pa.list_(pa.string()))], names=[keep, "n_words", "spans", "items"])

    return src.mapInArrow(run, f"{keep} {type_of(src, keep)}, n_words bigint, spans {SPANS}, items array<string>")


def _merge_spans(df: DataFrame) -> DataFrame:
    """Joins the spans that several blocks of patterns found in a text."""
    def run(batches):
        for b in batches:
            out = [[{"start": s, "length": n} for s, n in merged([(x["start"], x["length"]) for x in v or []])]
                   for v in b.column("spans").to_pylist()]
            i = b.schema.get_field_index("spans")
            yield b.set_column(i, "spans", pa.array(out, b.schema.field("spans").type))

    return df.mapInArrow(run, df.schema)


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", bench_text_col: str = "text", window: int = 10,
                  block_rows: int = 100_000) -> DataFrame:
    """One row for each row of ``docs``: ``id_col, n_words, spans, items``.

    ``spans`` are disjoint word spans covered by occurrences of windows,
    ``items`` the items with an occurring window.  Null and empty texts have no
    words.  Patterns are broadcast in blocks of about ``block_rows`` windows: a
    benchmark of any size is searched whole, block after block.  With one block
    there is no shuffle of ``docs``; with more, their hits are joined by row number.
    """
    wins = materialize(benchmark_windows(bench, item_col, bench_text_col, window), "windows")
    blocks = max(1, -(-wins.count() // block_rows))
    sc = docs.sparkSession.sparkContext
    src = pick(docs, id=id_col, text=text_col).withColumn("text", F.col("text").cast("binary"))
    numbered = wins.withColumn("block", F.pmod(F.xxhash64("words", "item"), F.lit(blocks)))

    def patterns(i):
        rows = numbered.where(F.col("block") == i).select("words", "item").collect()
        return sc.broadcast([(bytes(w), item) for w, item in rows])

    if blocks == 1:
        return _scan(src, patterns(0), "id").withColumnRenamed("id", id_col)
    src = materialize(src.withColumn("row", F.monotonically_increasing_id()), "decontaminate-docs")
    parts = []
    for i in range(blocks):
        use = patterns(i)
        hit = _scan(src.select("row", "text"), use, "row")
        parts.append(materialize(hit if i == 0 else hit.where(F.size("spans") > 0), f"hits-{i}"))
        use.unpersist()
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    one = _merge_spans(both.groupBy("row").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
    return src.select("row", F.col("id").alias(id_col)).join(one, "row").drop("row")
