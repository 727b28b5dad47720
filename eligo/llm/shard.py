"""Sharding by a hierarchical weighted hash tree.

A row descends from regions to racks to shards.  At each level every child draws
``-ln(u) / weight`` with a hash of the row's key and the child's name for ``u``; the
smallest draw wins, so a child wins in proportion to its weight.  A draw depends on that child alone, so
changing a weight moves rows only into or out of the subtree that changed.

A shard that is added later (:func:`grow`) comes as a region of its own: its draw
is the only new one at the root, so rows move only into it.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eligo.llm.common import materialize, pick, type_of


@dataclass(frozen=True)
class Leaf:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def layout(shards: int, racks_per_region: int = 3, shards_per_rack: int = 4) -> list[Leaf]:
    """A regular tree with shards 0 .. shards - 1."""
    per = racks_per_region * shards_per_rack
    return [Leaf(f"g{i // per}", f"r{i % per // shards_per_rack}", i) for i in range(shards)]


def grow(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, in a region of its own."""
    new = max(x.shard for x in tree) + 1
    return [*tree, Leaf(f"grown{new}", "r0", new, weight)]


def _draw(key: Column, name: str, weight: float) -> Column:
    if weight <= 0:
        raise ValueError(f"{name}: weight must be above 0")
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 12)
    return -F.ln((bits + F.lit(0.5)) / F.lit(float(1 << 52))) / F.lit(weight)


def _winner(key: Column, children: list[tuple[str, float]]) -> Column:
    """The name of the child with the smallest draw (a tie goes to the first by name)."""
    if len(children) == 1:
        return F.lit(children[0][0])
    return F.array_min(F.array(*[F.struct(_draw(key, name, w).alias("draw"), F.lit(name).alias("name"))
                                 for name, w in children]))["name"]


def descend(df: DataFrame, key: str, tree: list[Leaf], out: str) -> DataFrame:
    """``df`` with the shard of column ``key`` (no nulls) as ``out``; only the chosen branch is drawn at each level."""
    at = f"_{out}_at"
    df = df.withColumn(at, F.lit(""))
    for level in range(3):
        below: dict[str, dict[str, float]] = {}
        for x in tree:
            path = ["", f"/{x.region}", f"/{x.region}/{x.rack}", f"/{x.region}/{x.rack}/{x.shard}"]
            children = below.setdefault(path[level], {})
            children[path[level + 1]] = children.get(path[level + 1], 0.0) + x.weight
        step = None
        for path, children in below.items():
            hit = _winner(F.col(key), sorted(children.items()))
            step = F.when(F.col(at) == path, hit) if step is None else step.when(F.col(at) == path, hit)
        df = df.withColumn(at, step)
    return df.withColumn(out, F.substring_index(at, "/", -1).cast("int")).drop(at)


def assign_shards(docs: DataFrame, tree: list[Leaf], grown: list[Leaf] | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row: ``id_col, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``key``: id and tree alone decide (a null id is the empty string).
    ``size`` is the text's UTF-8 bytes plus 8, a null text has none.  ``slot``
    counts from 0 without gaps in each shard: places within a partition are
    counted where the rows are read, and the partitions' counts (24 numbers each)
    are summed up, so no shard is gathered in one task.
    """
    body = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    key = F.coalesce(F.col("id").cast("string"), F.lit(""))
    src = pick(docs, id=id_col, text=text_col).select(
        "id", (F.octet_length(body) + 8).cast("bigint").alias("size"), F.crc32(body).alias("text_crc32"),
        key.alias("key"))
    src = descend(src, "key", tree, "shard")
    src = descend(src, "key", grown, "grown_shard") if grown else src.withColumn("grown_shard", F.lit(None).cast("int"))
    src = src.select("id", "size", "text_crc32", "shard", "grown_shard")

    def number(batches):
        part, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            r = []
            for s in b.column("shard").to_pylist():
                r.append(seen.get(s, 0))
                seen[s] = r[-1] + 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([part] * len(r), pa.int32()), pa.array(r, pa.int64())],
                names=[*b.schema.names, "part", "r"])

    rows = materialize(src.mapInArrow(
        number, f"id {type_of(src, 'id')}, size bigint, text_crc32 bigint, shard int, grown_shard int, "
                "part int, r bigint"), "shard-rows")
    counts = rows.groupBy("part", "shard").agg(F.count("*").alias("n"))
    order = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    before = counts.select("part", "shard", (F.sum("n").over(order) - F.col("n")).alias("before"))
    return rows.join(before, ["part", "shard"]).select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("r") + F.col("before")).alias("slot"), "grown_shard")
