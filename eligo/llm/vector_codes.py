"""Vector code compression: product quantization with exact integer arithmetic.

Components become integers, floor(256 x).  A vector is cut into equal parts, and each part
position has a codebook of integer entries.  The nearest entry needs
|a|^2 - 2 a.c + |c|^2 for all entries, a matrix product.  It runs in float64 BLAS and is
still exact: integers are broken into limbs of so few bits that the products of two limbs,
summed over a part, stay below 2^53; the limb products are then put together in int64.  The
first smallest distance wins, so ties go to the lower index on every machine.

Vectors too large for int64 distances (components beyond about 2^29 / sqrt(dimension))
take Python integers by the same formulas, batch by batch.

A round is one map-only pass over the vectors.  A task holds its codebooks' sums (64 x
dimension numbers) and returns them once, as limbs; Spark adds the limbs up, and the driver
divides: it never sees more than the sums of one codebook set.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eligo.llm.common import materialize, pick, type_of

SCALE = 256
LIMB = 32          # bits of a limb of a sum on its way through Spark
MOST = (1 << 63) - 1
ROWS = 2048        # vectors of one product


# ---- exact distances -----------------------------------------------------------

def as_integers(x: np.ndarray) -> np.ndarray:
    """floor(256 x) of finite float64: int64, or Python integers where int64 has no room."""
    v = np.floor(x * SCALE) if not x.size or np.abs(x).max() < 2.0 ** 900 else np.full(x.shape, np.inf)
    if not v.size or np.abs(v).max() < 2.0 ** 61:
        return v.astype(np.int64)
    whole = [int(y) * SCALE if abs(y) >= 2.0 ** 53 else math.floor(y * SCALE) for y in x.ravel().tolist()]
    return np.array(whole, object).reshape(x.shape)


def _most(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def _limbs(x: np.ndarray, bits: int) -> list[np.ndarray]:
    """float64 limbs of integers, lowest first: x = sum of limb_i << (bits i), all but the last from 0 to 2^bits - 1."""
    out = []
    while _most(x) >> bits:
        out.append((x & ((1 << bits) - 1)).astype(np.float64))
        x = x >> bits
    return [*out, x.astype(np.float64)]


def dot(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The exact a @ c.T of int64 matrices whose result fits int64."""
    # limbs are at most 2^bits in size, so a sum of `width` products is at most width 2^(2 bits) < 2^53
    bits = (52 - max(a.shape[1], 1).bit_length()) // 2
    out = np.zeros((len(a), len(c)), np.int64)
    right = [x.T for x in _limbs(c, bits)]
    for i, x in enumerate(_limbs(a, bits)):
        for j, y in enumerate(right):
            out += (x @ y).astype(np.int64) << (bits * (i + j))
    return out


def nearest(a: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first nearest row of ``c``, its squared distance) for each row of ``a``."""
    width = max(a.shape[1], 1)
    # every intermediate is at most 4 width m^2 in size
    if a.dtype != object and c.dtype != object and 4 * width * max(_most(a), _most(c), 1) ** 2 < 1 << 62:
        away = (c * c).sum(axis=1) - 2 * dot(a, c)
        at = away.argmin(axis=1)
        return at, away[np.arange(len(a)), at] + (a * a).sum(axis=1)
    entries = c.tolist()
    at, least = [], []
    for row in a.tolist():
        away = [sum((x - y) ** 2 for x, y in zip(row, e, strict=True)) for e in entries]
        least.append(min(away))
        at.append(away.index(least[-1]))
    return np.array(at, np.int64), np.array(least, object)


def _vectors(column, dim: int) -> np.ndarray:
    """Rows of a batch's list column as a float64 matrix; shorter vectors are filled up with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    n = np.diff(column.offsets.to_numpy())
    if len(flat) == len(n) * dim:
        return flat.reshape(len(n), dim)
    out = np.zeros((len(n), dim))
    out[np.arange(dim) < n[:, None]] = flat
    return out


def _assigned(batches, books: list[np.ndarray], dim: int):
    """(slice of a batch, parts of its vectors, nearest entries, squared distances), the last three by part."""
    parts = len(books)
    for b in batches:
        for i in range(0, b.num_rows, ROWS):
            some = b.slice(i, ROWS)
            cut = np.split(as_integers(_vectors(some.column("x"), dim)), parts, axis=1)
            found = [nearest(a, c) for a, c in zip(cut, books, strict=True)]
            yield some, cut, [f[0] for f in found], [f[1] for f in found]


# ---- Spark passes --------------------------------------------------------------

def kept_vectors(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, x, label): rows whose vector and components are all there and finite."""
    def finite(x: Column) -> Column:
        return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    src = pick(vectors, id=id_col, x=vec_col, label=label_col).withColumn("x", F.col("x").cast("array<double>"))
    return src.where(F.col("x").isNotNull() & F.forall("x", finite))


def _sums(kept: DataFrame, books: list[np.ndarray], dim: int) -> dict[tuple, int]:
    """Sum of the parts assigned to each entry, {(part, entry, position): sum}; position -1: their number."""
    shared = kept.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        books = shared.value
        width = dim // len(books)
        total = [np.zeros((len(c), width + 1), object) for c in books]   # whole sums, in Python integers
        for _, cut, at, _ in _assigned(batches, books, dim):
            for t, a, i in zip(total, cut, at, strict=True):
                here = np.zeros(t.shape, object if a.dtype == object or _most(a) >> 48 else np.int64)
                np.add.at(here, i, np.c_[a, np.ones((len(a), 1), np.int64)])
                t += here
        rows = [(p, e, w if w < width else -1, n, v)
                for p, t in enumerate(total) for e, line in enumerate(t.tolist()) if line[-1]
                for w, value in enumerate(line) for n, v in enumerate(_signed_limbs(value))]
        cols = list(zip(*rows, strict=True)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in cols[:4]), pa.array(cols[4], pa.int64())],
                                         names=["part", "entry", "pos", "limb", "v"])

    parts = kept.select("x").mapInArrow(run, "part int, entry int, pos int, limb int, v bigint")
    out: dict[tuple, int] = {}
    for p, e, w, n, v in parts.groupBy("part", "entry", "pos", "limb").agg(F.sum("v")).collect():  # one codebook set
        out[p, e, w] = out.get((p, e, w), 0) + (v << (LIMB * n))
    return out


def _signed_limbs(x: int) -> list[int]:
    """Limbs of LIMB bits, lowest first; the last one has the sign."""
    out = []
    while not -(1 << LIMB) < x < 1 << LIMB:
        out.append(x & ((1 << LIMB) - 1))
        x >>= LIMB
    return [*out, x]


def train_codebooks(kept: DataFrame, parts: int, entries: int, rounds: int) -> tuple[list[np.ndarray], int]:
    """(codebooks, dimension): one integer matrix for each part position.

    First the parts of the vectors of the ``entries`` smallest ids (nulls last; equal ids by
    their vectors); then ``rounds`` times, each entry becomes the floor of the mean of the
    parts nearest to it.  Entries without parts stay.
    """
    longest = kept.agg(F.max(F.size("x"))).first()[0] or 0
    dim = -(-longest // parts) * parts
    first = kept.select("id", "x").orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    seed = as_integers(np.array([[*r["x"], *[0.0] * (dim - len(r["x"]))] for r in first], np.float64).reshape(len(first), dim))
    books = [x.copy() for x in np.split(seed, parts, axis=1)]
    for _ in range(rounds if len(first) else 0):
        sums = _sums(kept, books, dim)
        new = []
        for p, c in enumerate(books):
            rows = [[sums[p, e, w] // sums[p, e, -1] for w in range(len(line))] if (p, e, -1) in sums else line
                    for e, line in enumerate(c.tolist())]
            small = all(-(1 << 61) < x < 1 << 61 for r in rows for x in r)
            new.append(np.array(rows, np.int64 if small else object).reshape(c.shape))
        books = new
    return books, dim


def codebooks_digest(books: list[np.ndarray]) -> str:
    text = ",".join(str(x) for c in books for row in c.tolist() for x in row)
    return hashlib.sha256(text.encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
             parts: int = 16, entries: int = 64, rounds: int = 2) -> tuple[DataFrame, list[np.ndarray]]:
    """(one row for each kept vector: ``id_col, label_col, codes`` (array of entry indexes by part), ``error``;
    the codebooks).

    Rows are dropped whose vector is null or holds null or non-finite components.  Null and
    repeated ids and labels are kept as they come.  Vectors of different lengths are filled up with zeros to
    the longest length, and that to a multiple of ``parts``.  ``error`` is the squared distance of the
    vector to its entries; beyond a bigint it is the largest bigint.  An empty
    table gives no rows and empty codebooks.
    """
    if entries > 256:
        raise ValueError("an index has two hex digits: at most 256 entries")
    kept = kept_vectors(vectors, id_col, vec_col, label_col)
    books, dim = train_codebooks(kept, parts, entries, rounds)
    shared = kept.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        for some, _, at, away in _assigned(batches, shared.value, dim):
            codes = np.stack(at, axis=1).astype(np.int16)
            far = [min(x, MOST) for x in sum(x.astype(object) for x in away).tolist()]
            ends = pa.array(np.arange(len(codes) + 1) * parts, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [some.column("id"), some.column("label"), pa.ListArray.from_arrays(ends, pa.array(codes.ravel())),
                 pa.array(far, pa.int64())], names=["id", "label", "codes", "error"])

    out = kept.mapInArrow(run, f"id {type_of(kept, 'id')}, label {type_of(kept, 'label')}, "
                               "codes array<smallint>, error bigint")
    return out.withColumnsRenamed({"id": id_col, "label": label_col}), books


def with_label_error(codes: DataFrame, label_col: str = "label") -> DataFrame:
    """``codes`` plus ``label_error``: the errors of its label summed up, nulls together, at most the largest bigint.

    The codes and the sums are written first, so a label with a third of all rows is one
    row on the small side and a plain shuffle, which can be split, on the other.
    """
    codes = materialize(codes, "vector-codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST).cast("decimal(38,0)")).cast("bigint")
    sums = materialize(codes.groupBy(F.col(label_col).alias("_label")).agg(total.alias("label_error")), "label-errors")
    return codes.join(sums, F.col(label_col).eqNullSafe(F.col("_label"))).drop("_label")


def code_text(codes: Column) -> Column:
    """Two lower-case hex digits for each index."""
    return F.array_join(F.transform(codes, lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
