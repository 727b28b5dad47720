"""Best-fit packing by a configuration linear program over the length histogram.

Documents are tokenized once and cut into pieces of at most one sequence.  Only the
histogram of piece lengths (``capacity`` numbers at most) reaches the driver, where
``config_lp.plan`` solves the configuration program by multiplicative weights and rounds it.

Pieces then find their place on their own: the r-th piece of a length has a
place in the plan, which is a few numbers for each length and configuration.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eligo.llm.common import materialize, pick, type_of, worker_state
from eligo.llm.config_lp import plan

CACHE_WORDS, CACHE_CHARS = 400_000, 64   # of a generation; two generations of words and of their parts are held
MOST_BROADCAST_ROWS = 500_000   # of 16 bytes


# ---- places -----------------------------------------------------------------------

def _places(bins: list[tuple[list[tuple[int, int]], int]]) -> dict[str, np.ndarray]:
    """For each (length, class of bins): first rank, uses in a bin, first sequence, first offset; sorted."""
    rows, first = [], 0
    for config, uses in bins:
        offset = 0
        for n, k in config:
            rows.append((n, k, uses, first, offset))
            offset += n * k
        first += uses
    rows.sort(key=lambda r: (r[0], r[3], r[4]))
    n, k, uses, base, offset = (np.array(x, np.int64) for x in zip(*rows, strict=True)) if rows \
        else (np.zeros(0, np.int64),) * 5
    total = np.cumsum(k * uses)
    start = total - k * uses
    if len(n):  # ranks count from 0 in each length
        new = np.r_[True, n[1:] != n[:-1]]
        start = start - np.maximum.accumulate(np.where(new, start, 0))
    return {"length": n, "start": start, "k": k, "base": base, "offset": offset}


# ---- tokens ------------------------------------------------------------------

class _Cache(dict):
    """Computes what it lacks; keeps it if the key is short.

    ``trim`` starts anew when full, with the last generation behind it, from which words still in use are taken over.
    """

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.last = make, most, {}

    def __missing__(self, key: str) -> bytes:
        out = self.last.get(key)
        if out is None:
            out = self.make(key)
        if len(key) <= CACHE_CHARS:
            self[key] = out
        return out

    def trim(self) -> None:
        if len(self) > self.most:
            self.last = dict(self)
            self.clear()


class WordTokens:
    """Token bytes of whole texts, for the public lower-casing word BPE.

    Its pre-tokenizer never joins characters over white space, so a text is split at blanks and
    line ends and each distinct word is encoded once (bounded caches hold the
    common ones).  A word of plain characters, on which normalization is the
    lower case and nothing else, is split by the tokenizer's own pattern and its parts go
    to the BPE model; any other word goes through the whole tokenizer, and so does any text that
    holds the string of an added token, which the tokenizer finds before all else.
    """

    PLAIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
    # The tokenizer's split pattern, on plain lower-case characters.
    PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")

    def __init__(self, path: str, cache_words: int | None = None):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        most = CACHE_WORDS if cache_words is None else cache_words
        self.words, self.parts = _Cache(self._word, most), _Cache(self._part, most)

    def _part(self, part: str) -> bytes:
        text = part if part.isascii() else self.as_bytes.pre_tokenize_str(part)[0][0]
        return array("I", [t.id for t in self.tokenizer.model.tokenize(text)]).tobytes()

    def _word(self, word: str) -> bytes:
        if not word:
            return b""
        if self.PLAIN.fullmatch(word):
            return b"".join(map(self.parts.__getitem__, self.PARTS.findall(word.lower())))
        return self._whole(word)

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Unsigned 32-bit ids of a text, in this machine's (little-endian) order."""
        if any(a in text for a in self.added):
            return self._whole(text)
        self.words.trim()
        self.parts.trim()
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


def tokenized_pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer_path: str, capacity: int,
                     end_id: int, with_ids: bool, cache_words: int | None = None) -> DataFrame:
    """One row for each piece: (id, piece, start, length, ids_crc32, part, r[, ids]).

    ``r`` numbers the pieces of one length within a partition ``part``.
    """
    src = pick(docs, id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        words = worker_state(f"tokens {tokenizer_path} {cache_words}", lambda: WordTokens(tokenizer_path, cache_words))
        part, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            for i in range(0, b.num_rows, 256):
                cols: list[list] = [[] for _ in range(7)]
                index = []
                for j, ids in enumerate(b.column(1)[i:i + 256]):
                    ids = words.encode(ids.as_py()) + end
                    for p, at in enumerate(range(0, len(ids), step)):
                        piece = ids[at:at + step]
                        n = len(piece) // 4
                        r = seen[n] = seen.get(n, -1) + 1
                        index.append(i + j)
                        for c, v in zip(cols, (p, at // 4, n, zlib.crc32(piece), part, r,
                                               piece if with_ids else None), strict=True):
                            c.append(v)
                types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(index, pa.int64())),
                     *(pa.array(c, t) for c, t in zip(cols, types, strict=True))][:8 if with_ids else 7],
                    names=["id", "piece", "start", "length", "ids_crc32", "part", "r", "ids"][:8 if with_ids else 7])

    return src.mapInArrow(run, f"id {type_of(src, 'id')}, piece int, start bigint, length bigint, ids_crc32 bigint, "
                               "part int, r bigint" + (", ids binary" if with_ids else ""))


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = 4096, end_id: int = 1, with_ids: bool = False,
         cache_words: int | None = None, **lp) -> DataFrame:
    """One row for each piece: ``id_col, piece, start, length, ids_crc32, sequence_id, offset[, ids]``.

    A document is its ids and then ``end_id`` (null text: empty, so ``end_id``
    alone).  Only documents longer than ``capacity`` are cut; their last piece may be
    shorter.  Offsets of a sequence are gapless from 0.  Repeated rows are packed each.
    ``cache_words`` bounds what a worker remembers of words (time against memory; default CACHE_WORDS).
    """
    pieces = materialize(tokenized_pieces(docs, id_col, text_col, tokenizer_path, capacity, end_id, with_ids, cache_words),
                         "pieces")
    counts = materialize(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    hist = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # capacity rows at most
    places = pieces.sparkSession.sparkContext.broadcast(_places(plan(hist, capacity, **lp)))

    # A piece's rank within its length: ranks of the partitions before, and its own in its partition.
    before = counts.select("part", "length", (F.sum("n").over(_by_part()) - F.col("n")).alias("before"))
    # One row for each partition and length: it grows with the corpus, so it is counted before it is broadcast.
    before = F.broadcast(before) if counts.count() <= MOST_BROADCAST_ROWS else before.hint("shuffle_hash")
    ranked = pieces.join(before, ["part", "length"]).withColumn("r", F.col("r") + F.col("before"))
    keep = ["id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def place(batches):
        p = places.value
        key = p["length"] * (1 << 48) + p["start"]
        for b in batches:
            n, r = (b.column(x).to_numpy(zero_copy_only=False) for x in ("length", "r"))
            at = np.searchsorted(key, n * (1 << 48) + r, side="right") - 1
            copy, slot = np.divmod(r - p["start"][at], p["k"][at])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(x) for x in keep), pa.array(p["base"][at] + copy), pa.array(p["offset"][at] + slot * n)],
                names=[*keep, "sequence_id", "offset"])

    schema = ", ".join(f"{x} {type_of(ranked, x)}" for x in keep) + ", sequence_id bigint, offset bigint"
    return ranked.select(*keep, "r").mapInArrow(place, schema).withColumnRenamed("id", id_col)


def _by_part():
    from pyspark.sql import Window
    return Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids, n_tokens)`` from a packing made ``with_ids``; a group is one sequence, so bounded."""
    return packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("x"), F.sum("length").alias("n_tokens")
    ).select("sequence_id", F.expr("aggregate(x.ids, X'', (a, b) -> concat(a, b))").alias("ids"), "n_tokens")
