"""Compaction keeps its clustering; the audit keeps NULL keys out of the shuffle."""

import os

from pyspark.sql import functions as F

from eligo.operators.joins import key_set
from eligo.schemas import KEY_COLS
from eligo.sinks import publish
from tests.helpers import state, state_df


def ranges(spark, path):
    files = (spark.read.parquet(path).groupBy("p", F.col("_metadata.file_path").alias("f"))
             .agg(F.min("k").alias("lo"), F.max("k").alias("hi")).collect())
    return {p: sorted((r.lo, r.hi) for r in files if r.p == p) for p in {r.p for r in files}}


def test_compaction_leaves_fewer_files_with_disjoint_ranges(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.range(6000).selectExpr("id % 2 AS p", "(id * 7919) % 6000 AS k")
    df.repartition(12).write.partitionBy("p").parquet(path)
    before = ranges(spark, path)
    assert all(len(v) == 12 for v in before.values())
    assert publish.compact(spark, path, ["p"], ["k"], rows_per_file=1000) == 6000
    after = ranges(spark, path)
    assert set(after) == {0, 1}
    for spans in after.values():
        assert len(spans) < 12 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    back = spark.read.parquet(path).select("p", "k")
    assert back.exceptAll(df).count() == 0 and back.count() == 6000


def test_key_profile_counts_null_keys_outside_the_join(spark):
    rows = [state("u1"), state("u2"), state(None), state("u1", None), state(None, None)]
    for limit in (0, 1 << 26):
        ks = key_set(state_df(spark, [state("u1"), state(None)]), KEY_COLS, limit)
        assert publish._key_profile(state_df(spark, rows), ks) == (5, 1, 3)
