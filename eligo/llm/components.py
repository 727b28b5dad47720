"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eligo.llm.common import materialize


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(u, v)`` rows, u > v: every node but the smallest of its component, with that smallest.

    Large-star hangs a node's larger neighbours on the smallest node it sees;
    small-star does the same for its smaller ones.  Both are a grouped minimum
    and a join back, so a node with many neighbours is pre-aggregated and its
    join can be split.  Each round is written to the shared folder; rounds grow
    with the logarithm of the nodes, and no round makes more edges than
    it was given plus one for each node.
    """
    e = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .where("u <> v").distinct(), name)
    mark = _mark(e)
    while mark[0]:
        both = e.select(F.col("u").alias("n"), F.col("v").alias("m")).unionByName(
            e.select(F.col("v").alias("n"), F.col("u").alias("m")))
        # Both minima are written before their join, so that its other side is a plain shuffle, which AQE can split.
        lo = materialize(both.groupBy("n").agg(F.min("m").alias("lo")).select("n", F.least("n", "lo").alias("lo")), name)
        large = (both.join(lo, "n").where("m > n")
                 .select(F.col("m").alias("u"), F.col("lo").alias("v")).distinct())
        large = materialize(large, name)
        lo = materialize(large.groupBy("u").agg(F.min("v").alias("lo")), name)
        small = (large.join(lo, "u").where("v <> lo").select(F.col("v").alias("u"), F.col("lo").alias("v"))
                 .unionByName(lo.select("u", F.col("lo").alias("v"))).distinct())
        e = materialize(small, name)
        new = _mark(e)
        if new == mark:
            break
        mark = new
    return e
