"""Line dedup by distinct-site spread.

A line that many sites carry is boilerplate.  Per line hash a HyperLogLog sketch
of the sites is merged by aggregation; lines whose estimate is clearly below or
above the threshold are settled by it, the few near it get an exact distinct count.
Boilerplate goes from every document but the one with the smallest id that holds it, so no
text is lost from the corpus and the original of a much-copied document stays whole.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eligo.llm.common import content_key, materialize, pick, slices


def _keys(line: Column) -> list[Column]:
    """128 bits of a line; `_key` is the same in Python."""
    b = line.cast("binary")
    return [F.xxhash64(b).alias("k1"), F.xxhash64(F.concat(F.lit(b"#"), b)).alias("k2")]


def _key(line: str) -> bytes:
    b = line.encode()
    return xxhash.xxh64_digest(b, 42) + xxhash.xxh64_digest(b"#" + b, 42)


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """(id, site, t1, t2, pos, k1, k2) of each line that counts."""
    t1, t2 = content_key(F.col("text"))
    return (docs.select("id", "site", t1.alias("t1"), t2.alias("t2"),
                        F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
            .where(F.length(F.trim("line")) >= min_chars)
            .select("id", "site", "t1", "t2", "pos", *_keys(F.col("line"))))


def boilerplate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                      min_sites: int = 10, min_chars: int = 16, lg_k: int = 12, band: float = 0.1) -> DataFrame:
    """``(k1, k2, first)``: keys of the lines on ``min_sites`` sites or more, and the smallest id that holds each.

    ``band`` is the share of the threshold to either side within which the
    sketch isn't trusted (six standard errors at ``lg_k`` 12).  A null site is
    none; a null id counts only if a line has no other.
    """
    src = pick(docs, id=id_col, text=text_col, site=site_col)
    lines = _lines(src, min_chars)
    spread = materialize(
        lines.groupBy("k1", "k2").agg(F.hll_sketch_agg(F.col("site").cast("string"), lg_k).alias("sketch"),
                                      F.min("id").alias("first"), F.count("*").alias("n"))
        .where(F.col("n") >= min_sites)
        .select("k1", "k2", "first", F.hll_sketch_estimate("sketch").alias("est"))
        .where(F.col("est") >= min_sites * (1 - band)), "line-spread")
    sure = F.col("est") > min_sites * (1 + band)
    near = spread.where(~sure).select("k1", "k2")
    exact = (lines.join(near, ["k1", "k2"], "left_semi").groupBy("k1", "k2", "site").agg(F.lit(1).alias("one"))
             .groupBy("k1", "k2").agg(F.count("site").alias("sites")).where(F.col("sites") >= min_sites)
             .select("k1", "k2"))
    return materialize(spread.where(sure).select("k1", "k2", "first").unionByName(
        spread.where(~sure).join(exact, ["k1", "k2"], "left_semi").select("k1", "k2", "first")), "boilerplate")


def _clean(df: DataFrame, text_col: str, drops) -> DataFrame:
    """``df`` with lines cut from the text, ``n_lines`` and ``n_removed``; map-only.

    ``drops(batch)`` gives for each row a test of (position, line).
    """
    names = df.columns
    at = names.index(text_col)
    schema = T.StructType([*df.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])

    def run(batches):
        for b in slices(batches):
            texts, n_lines, n_removed = [], [], []
            for text, drop in zip(b.column(at), drops(b), strict=True):
                text = text.as_py()
                lines = [] if text is None else text.split("\n")
                kept = [x for i, x in enumerate(lines) if not drop(i, x)]
                texts.append(None if text is None else text if len(kept) == len(lines) else "\n".join(kept))
                n_lines.append(len(lines))
                n_removed.append(len(lines) - len(kept))
            out = [*b.columns, pa.array(n_lines, pa.int64()), pa.array(n_removed, pa.int64())]
            out[at] = pa.array(texts, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(out, names=[*names, "n_lines", "n_removed"])

    return df.mapInArrow(run, schema)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
               min_sites: int = 10, min_chars: int = 16, max_broadcast_lines: int = 1_000_000,
               **spread) -> DataFrame:
    """``docs`` with boilerplate lines cut from ``text_col``, plus ``n_lines`` and ``n_removed``.

    Lines of fewer than ``min_chars`` characters (blank ends aside) are left
    alone.  Null texts stay null, empty ones empty.  Columns named
    ``n_lines`` or ``n_removed`` are replaced, all others are kept.

    Up to ``max_broadcast_lines`` boilerplate lines (counted; about 50 bytes each) are
    broadcast and cut where the text is read, without a shuffle of it.  Beyond
    that, line positions are joined to the texts by id and content.
    """
    bad = boilerplate_lines(docs, id_col, text_col, site_col, min_sites, min_chars, **spread)
    rest = docs.drop("n_lines", "n_removed")
    if bad.count() <= max_broadcast_lines:
        first = docs.sparkSession.sparkContext.broadcast({
            k1.to_bytes(8, "big", signed=True) + k2.to_bytes(8, "big", signed=True): f
            for k1, k2, f in bad.select("k1", "k2", F.col("first").cast("string")).collect()})

        i = rest.columns.index(id_col)

        def known(batch):
            firsts, none = first.value, object()
            for id_ in batch.column(i):
                id_ = None if (id_ := id_.as_py()) is None else str(id_)
                yield lambda _, x, id_=id_: (len(x.strip(" ")) >= min_chars
                                             and (f := firsts.get(_key(x), none)) is not none and f != id_)

        return _clean(rest, text_col, known)
    src = pick(docs, id=id_col, text=text_col, site=site_col)
    hits = (_lines(src, min_chars).join(bad, ["k1", "k2"]).where(~F.col("id").eqNullSafe(F.col("first")))
            .groupBy("id", "t1", "t2").agg(F.collect_set("pos").alias("drop"))
            .select(F.col("id").alias("_id"), F.col("t1").alias("_u1"), F.col("t2").alias("_u2"), F.col("drop").alias("_drop")))
    t1, t2 = content_key(F.col(text_col))
    keyed = rest.withColumns({"_t1": t1, "_t2": t2})
    joined = keyed.join(hits, keyed["_t1"].eqNullSafe(hits["_u1"]) & (keyed["_t2"] == hits["_u2"])
                        & keyed[id_col].eqNullSafe(hits["_id"]), "left").select(*rest.columns, "_drop")

    def placed(batch):
        for gone in batch.column(len(batch.schema) - 1):
            gone = set(gone.as_py() or ())
            yield lambda pos, _, gone=gone: pos in gone

    return _clean(joined, text_col, placed).drop("_drop")
