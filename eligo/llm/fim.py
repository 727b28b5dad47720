"""Fill-in-middle transformation by content-defined chunk memoization.

A text is cut into chunks where a rolling hash of its last 32 bytes says so; equal
passages are therefore cut alike wherever they stand, and a chunk seen before (in another
document, or in a copy) is looked up, not counted again.  The cache maps a chunk's bytes, compared in full, to its
*boundary summary*: whether it starts and ends within a word, how many words end inside it, and its
code points.  Summaries of neighbours combine by addition (a word ends between two chunks if the left one ends in a
word and the right one starts with white space), so the number of tokens of a document,
and the chunk that holds a cut, come from summaries alone; only those two chunks are looked
into.  White space is ASCII and code points are counted by their first bytes, so chunks may be cut at any byte.

The pass is map-only: no shuffle, one document at a time, and a cache of bounded size in each Python
worker.  A lost executor costs its cache and its tasks, nothing else.
"""

from __future__ import annotations

import bisect
import hashlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eligo.llm.common import pick, slices, type_of, worker_state

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
LEAST, MOST = 512, 16384       # bytes of a chunk
MASK = np.uint32(0xFFE00000)   # 11 bits: a cut every 2 KiB on average
CACHE_BYTES = 64 << 20         # of chunks; the cache is emptied when full

#: The rolling hash's value of each byte: the low 32 bits of (byte + 1) x 2^64 / golden ratio, mixed once.
_GEAR = ((np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(29)).astype(np.uint32)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_FIRST = (np.arange(256) & 0xC0) != 0x80   # bytes that begin a code point


# ---- chunks and their summaries --------------------------------------------------

def rolling_hash(b: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes that end at each byte: sum of gear[b[i - j]] << j, by doubling the window five times."""
    h = _GEAR[b]
    for k in (1, 2, 4, 8, 16):
        h[k:] += h[:-k] << np.uint32(k)
    return h


def chunk_ends(b: np.ndarray) -> list[int]:
    """Ends of a text's chunks: after bytes where the hash's top bits are 0, LEAST to MOST apart."""
    n = len(b)
    if n <= LEAST:
        return [n] if n else []
    marks = (np.flatnonzero((rolling_hash(b) & MASK) == 0) + 1).tolist()
    ends, at, i = [], 0, 0
    while n - at > LEAST:
        i = bisect.bisect_left(marks, at + LEAST, i)
        at = min(marks[i] if i < len(marks) else n, at + MOST, n)
        ends.append(at)
    if at < n:
        ends.append(n)
    return ends


def summary(chunk: bytes) -> tuple[bool, bool, int, int]:
    """(starts with a word, ends in a word, words that end inside, code points)."""
    b = np.frombuffer(chunk, np.uint8)
    space = _SPACE[b]
    return (not space[0], not space[-1], int(np.count_nonzero(space[1:] & ~space[:-1])),
            int(np.count_nonzero(_FIRST[b])))


class ChunkCache(dict):
    """Summaries by content; a lookup compares the chunk's bytes, so equal hashes can't mix chunks up."""

    def __init__(self, most: int = CACHE_BYTES):
        super().__init__()
        self.most, self.held, self.hits, self.misses = most, 0, 0, 0

    def of(self, chunk: bytes) -> tuple[bool, bool, int, int]:
        got = self.get(chunk)
        if got is not None:
            self.hits += 1
            return got
        self.misses += 1
        if self.held + len(chunk) > self.most:
            self.clear()
            self.held = 0
        self[chunk] = got = summary(chunk)
        self.held += len(chunk)
        return got


class Cutter:
    """The tokens of one text, ``[white space]*word`` or trailing white space, counted and found by chunk summaries."""

    def __init__(self, text: bytes, cache: ChunkCache):
        self.text = text
        self.ends = chunk_ends(np.frombuffer(text, np.uint8))
        self.starts = [0, *self.ends][:len(self.ends)]
        parts = [cache.of(text[i:j]) for i, j in zip(self.starts, self.ends, strict=True)]
        # A word that reaches its chunk's last byte ends there if the next chunk starts with white space, or at the text's end.
        nexts = [*(not p[0] for p in parts[1:]), True][:len(parts)]
        self.words = list(accumulate((p[2] + (p[1] and e) for p, e in zip(parts, nexts, strict=True)), initial=0))
        self.chars = list(accumulate((p[3] for p in parts), initial=0))
        self.n = self.words[-1] + (bool(parts) and not parts[-1][1])

    def cut(self, k: int) -> tuple[int, int]:
        """(bytes, code points) of the first ``k`` tokens."""
        if k == 0:
            return 0, 0
        if k == self.n:
            return len(self.text), self.chars[-1]
        c = bisect.bisect_left(self.words, k) - 1    # the chunk in which the k-th word ends
        b = np.frombuffer(self.text, np.uint8)[self.starts[c]:self.ends[c]]
        space = _SPACE[b]
        inside = np.flatnonzero(space[1:] & ~space[:-1]) + 1
        j = k - self.words[c] - 1
        at = int(inside[j]) if j < len(inside) else len(b)
        return self.starts[c] + at, self.chars[c] + int(np.count_nonzero(_FIRST[b[:at]]))


# ---- the transformation ------------------------------------------------------------

def draws(doc_id, seed: int = 42) -> list[int]:
    """h1 to h4: the first four 8-digit groups of the SHA-256 of ``seed:doc_id`` (a null id is written as nothing)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12)]


def transform(doc_id, text: bytes, cache: ChunkCache, seed: int = 42, fim_percent: int = 50,
              spm_percent: int = 80) -> tuple[int, str, int | None, int | None, bytes]:
    """(n, form, prefix's code points, middle's, output) of one text; plain texts have no cuts."""
    cutter = Cutter(text, cache)
    h1, h2, h3, h4 = draws(doc_id, seed)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    if not text or h3 % 100 >= fim_percent or any(m in text for m in marks):
        return cutter.n, "plain", None, None, text
    a, b = sorted((h1 % (cutter.n + 1), h2 % (cutter.n + 1)))
    (i, ci), (j, cj) = cutter.cut(a), cutter.cut(b)
    prefix, middle, suffix = text[:i], text[i:j], text[j:]
    p, s, m = marks
    if h4 % 100 < spm_percent:
        return cutter.n, "spm", ci, cj - ci, b"".join((s, suffix, p, prefix, m, middle))
    return cutter.n, "psm", ci, cj - ci, b"".join((p, prefix, s, suffix, m, middle))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42,
                   fim_percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """One row for each row: ``id_col, n, form, prefix_chars, middle_chars, output``.

    Null and empty texts are plain, with 0 tokens and an empty output; so are texts that hold
    a sentinel, with the text as it is.  A null id draws like an empty one; equal ids draw alike.
    ``n`` counts tokens of every form.
    """
    src = pick(docs, id=id_col, text=text_col).select(
        "id", F.col("id").cast("string").alias("name"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches):
        cache = worker_state("fim chunks", ChunkCache)
        for b in slices(batches):
            texts = b.column("text").cast(pa.binary())
            rows = [transform(i, t.as_py(), cache, seed, fim_percent, spm_percent)
                    for i, t in zip(b.column("name").to_pylist(), texts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names=names)

    out = src.mapInArrow(run, f"id {type_of(src, 'id')}, n bigint, form string, prefix_chars bigint, "
                              "middle_chars bigint, output binary")
    return out.withColumn("output", F.col("output").cast("string")).withColumnRenamed("id", id_col)


def restored(output: Column, form: Column) -> Column:
    """The text rebuilt from an output and its form: its parts stand between the sentinels, which no text of these forms holds."""
    parts = F.split(output, "<[PSM]>", -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))
