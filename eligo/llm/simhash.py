"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints within ``max_distance`` bits meet half-way: some word of 64
bits lies within half that distance of both.  So each fingerprint emits all
variants within half the radius, the variants are shuffled, and fingerprints
that emitted the same variant are linked.

*Odd radius.*  For 3 bits the halves are 1 and 2.  Fingerprints an odd number
of bits apart differ in the parity of their set bits, so only those of odd
parity emit the larger ball (2,081 variants), those of even parity the smaller
(65); an even distance is at most 2 and meets within the smaller balls.

*No pairs inside a bucket.*  All that emitted one variant are linked to one
centre of the bucket: an even one if there is one (1 + 2 bits at most to each
other), else the smallest of those within 1 bit of the variant.  Each link is
within the radius (and verified), and any two that are within the radius are
joined through a centre.  A bucket holds distinct fingerprints inside one ball,
so its size is bounded by geometry (2,081), however large a group of copies is.

*Gate.*  With twice as many blocks as the radius, two fingerprints within it
agree on half the blocks.  One that shares no such half with another cannot
meet anything, so it emits its 20 block keys only, not its ball.  The gate is exact.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eligo.llm.common import materialize, pick, type_of
from eligo.llm.components import connected_components

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
CHUNK = 1 << 14


def fingerprint(text: bytes | None, shingle_words: int = 3) -> int:
    """Signed 64-bit SimHash of one text; see :func:`fingerprints`."""
    words = text.translate(LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_digest
    if len(words) <= shingle_words:
        raw = digest(joined, 42)
    else:
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        starts = [0, *(gaps[:len(words) - shingle_words] + 1).tolist()]
        ends = [*gaps[shingle_words - 1:].tolist(), len(joined)]
        raw = b"".join([digest(joined[a:z], 42) for a, z in zip(starts, ends, strict=True)])
    rows = np.frombuffer(raw, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(rows), CHUNK):
        ones += np.unpackbits(rows[i:i + CHUNK], axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(rows)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = 3) -> DataFrame:
    """``(id_col, fp)``, a row for each row: A-Z lower-cased, words split at ASCII
    white space, XXH64 (seed 42) of each shingle, bit set if in over half of them.

    Null, empty and blank texts have fingerprint 0; a text of fewer words than a
    shingle is one shingle.  One map-only pass.
    """
    src = pick(docs, id=id_col, text=text_col).withColumn("text", F.col("text").cast("binary"))

    def run(batches):
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle_words) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["id", "fp"])

    return (src.mapInArrow(run, f"id {type_of(src, 'id')}, fp bigint")
            .withColumnRenamed("id", id_col))


def _ball(radius: int) -> np.ndarray:
    masks = [0]
    for r in range(1, radius + 1):
        masks += [sum(1 << i for i in c) for c in itertools.combinations(range(64), r)]
    return np.array(masks, np.uint64)


def _block_masks(max_distance: int) -> list[int]:
    n = 2 * max_distance
    edges = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(edges)]
    signed = [sum(c) for c in itertools.combinations(blocks, max_distance)]
    return [m - (1 << 64) if m >> 63 else m for m in signed]


def _may_meet(fps: DataFrame, max_distance: int) -> DataFrame:
    """Fingerprints that agree with another one on half of the blocks."""
    keys = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m))
                                                   for m in _block_masks(max_distance)])).alias("k", "key"))
    shared = (keys.groupBy("k", "key").agg(F.min("fp").alias("a"), F.max("fp").alias("b"))
              .where("a <> b").select("k", "key"))
    return keys.join(shared, ["k", "key"], "left_semi").select("fp").distinct()


def links(fps: DataFrame, max_distance: int) -> DataFrame:
    """Star links ``(u, v)`` between distinct fingerprints (column ``fp``): each within
    ``max_distance``; their components are those of all pairs within it."""
    if not 0 <= max_distance <= 4:
        raise ValueError("max_distance: 0 to 4")
    small = max_distance // 2
    large = max_distance - small
    if max_distance == 0:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    near = materialize(_may_meet(fps, max_distance), "simhash-near")
    masks, n_small = _ball(large), len(_ball(small))

    def emit(batches):
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False)
            odd = np.bitwise_count(fps.view(np.uint64)) & 1 == 1
            for some, ball, even in ((fps[odd], masks, False), (fps[~odd], masks[:n_small], True)):
                for i in range(0, len(some), 64):   # balls of some fingerprints at a time
                    fp = some[i:i + 64]
                    v = (fp.view(np.uint64)[:, None] ^ ball).view(np.int64).ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v), pa.array(np.repeat(fp, len(ball))), pa.array(np.tile(np.arange(len(ball)) < n_small, len(fp))),
                         pa.array(np.full(len(v), even))], names=["variant", "fp", "inner", "even"])

    # A stated number of partitions: a few fingerprints make many variants, so their size says nothing.
    spread = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    balls = near.repartition(spread, "fp").mapInArrow(emit, "variant bigint, fp bigint, inner boolean, even boolean")
    bucket = (balls.groupBy("variant")
              .agg(F.min(F.when(F.col("even"), F.col("fp"))).alias("even_c"),
                   F.min(F.when(F.col("inner"), F.col("fp"))).alias("inner_c"),
                   F.collect_list(F.struct("fp", "inner")).alias("all"))
              .where(F.size("all") > 1)
              .select("variant", F.col("even_c").isNotNull().alias("any"),
                      F.coalesce("even_c", "inner_c").alias("v"), F.explode("all").alias("x")))
    return (bucket.where("v is not null and x.fp <> v and (any or x.inner)")
            .select(F.col("x.fp").alias("u"), "v").distinct()
            .where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_distance))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle_words: int = 3, max_distance: int = 3) -> DataFrame:
    """One row for each row: ``id_col``, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id that links of at most ``max_distance``
    bits reach.  Equal fingerprints are one node, so copies cost one row each
    and are never paired.  Repeated rows give repeated results; a null id takes
    part, but is no component's name unless there is no other (then null).
    """
    doc = materialize(fingerprints(docs, id_col, text_col, shingle_words)
                      .withColumnRenamed(id_col, "id"), "simhash-docs")
    nodes = materialize(doc.groupBy("fp").agg(F.min("id").alias("least")), "simhash-nodes")
    stars = connected_components(links(nodes.select("fp"), max_distance), "simhash-components")
    # Only fingerprints with a link need the roots' minimum.
    linked = (nodes.join(stars.select(F.col("u").alias("fp"), F.col("v").alias("root"))
                         .unionByName(stars.select(F.col("v").alias("fp"), F.col("v").alias("root")).distinct()),
                         "fp"))
    linked = materialize(linked, "simhash-linked")
    # What is joined to a hot component or a hot fingerprint is written first, so that AQE can split the other side.
    least = materialize(linked.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-least")
    comp = linked.select("fp", "root").join(least, "root").select("fp", "component_id")
    named = materialize(nodes.join(comp, "fp", "left").select(
        "fp", F.coalesce("component_id", "least").alias("component_id")), "simhash-named")
    return doc.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
