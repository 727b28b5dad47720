"""Exact dedup by deterministic block naming (DataFrame functions only).

A text is cut into blocks of a fixed number of bytes.  The distinct blocks are
sorted and numbered, so a block's integer name stands for its bytes; then each
adjacent pair of names is named the same way, level by level, until one name is
left for each document.  Two texts are equal exactly when they end at the same level with
the same name: names are handed out to distinct contents, so they can't collide.

Only the numbering of the first blocks moves text, once, and hot blocks are folded
map-side before that shuffle.  Occurrences then look their name up by a
128-bit key of the block; the key is first *proven* to be one-to-one on the
blocks at hand, and where it is not the lookup is by the block's bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eligo.llm.common import is_empty, materialize, pick


def _md5(block: Column) -> Column:
    return F.unhex(F.md5(block))


def _numbered(distinct: DataFrame, cols: list[str]) -> DataFrame:
    """Integers for distinct rows: sorted within each partition, numbered in that order."""
    return distinct.sortWithinPartitions(*cols).withColumn("name", F.monotonically_increasing_id())


def _blocks(body: Column, size: int) -> Column:
    """The text's blocks, in order; an empty text is one empty block."""
    n = F.greatest(F.ceil(F.octet_length(body) / size), F.lit(1))
    return F.transform(F.sequence(F.lit(0), (n - 1).cast("int")),
                       lambda i: F.substring(body, i * size + 1, F.lit(size)))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = 4096, key=_md5) -> DataFrame:
    """One row for each row of ``docs``: ``id_col, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are; null counts as empty.  Of equal texts the row with
    the largest id stays (nulls last; of repeated rows exactly one).
    ``key`` maps a block to its lookup key (tests pass a colliding one).
    """
    src = pick(docs, id=id_col, text=text_col).select(
        "id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body"))
    first = src.select(F.explode(_blocks(F.col("body"), block_bytes)).alias("block")).distinct()
    first = materialize(_numbered(first.withColumn("key", key(F.col("block"))), ["block"]).select("key", "name"),
                        "blocks")
    if not is_empty(first.groupBy("key").count().where("count > 1")):
        return exact_dedup(docs, id_col, text_col, block_bytes, key=lambda b: b)

    # Row numbers are made here once and read from the written table from now on.
    rows = materialize(src.select(
        F.monotonically_increasing_id().alias("row"), "id", F.sha2("body", 256).alias("sha"),
        F.transform(_blocks(F.col("body"), block_bytes), key).alias("keys")), "block-rows")
    state = (rows.select("row", F.posexplode("keys").alias("pos", "key"))
             .join(first, "key").select("row", F.col("pos").cast("long").alias("pos"), "name"))
    longest = rows.agg(F.max(F.size("keys"))).first()[0] or 0

    # `size` names are left of a row at `level`; rows of one name are done.
    sizes = rows.select("row", F.size("keys").cast("long").alias("left"))
    done = None
    for level in range(max(longest - 1, 0).bit_length() + 1):
        state = materialize(state.join(sizes, "row") if level == 0 else state, f"names-{level}")
        one = state.where("left = 1").select("row", F.lit(level).alias("level"), "name")
        done = one if done is None else done.unionByName(one)
        more = state.where("left > 1")
        pairs = materialize(
            more.groupBy("row", F.floor(F.col("pos") / 2).alias("pos"))
            .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                 F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"),
                 F.max(F.floor((F.col("left") + 1) / 2)).alias("left")), f"pairs-{level}") \
            if (longest - 1) >> level else None
        if pairs is None:
            break
        names = materialize(_numbered(pairs.select("a", "b").distinct(), ["a", "b"]), f"pair-names-{level}")
        state = pairs.join(names, ["a", "b"]).select("row", "pos", "name", "left")

    named = materialize(rows.select("row", "id", "sha").join(done, "row"), "named")
    best = F.struct(F.col("id"), F.col("row"))
    # Written first: a join with a grouping of its own rows would reuse the grouping's shuffle, which AQE can't split.
    groups = materialize(named.groupBy("level", "name").agg(
        F.max(best).alias("best"), F.count("*").alias("group_size")), "groups")
    return named.join(groups, ["level", "name"]).select(
        F.col("id").alias(id_col), F.col("best.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha").alias("text_sha256"))
