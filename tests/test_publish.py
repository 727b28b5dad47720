"""Dynamic overwrite, write-audit-publish, compaction."""

import os

import pytest
from pyspark.sql import functions as F

from eligo.sinks import publish, write


def test_dynamic_overwrite_keeps_other_partitions(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    df = spark.createDataFrame([(1, 1), (2, 2)], "v int, hour int")
    write.overwrite_partitions(df, p, ["hour"])
    write.overwrite_partitions(spark.createDataFrame([(9, 2)], "v int, hour int"), p, ["hour"])
    got = sorted(map(tuple, spark.read.parquet(p).select("v", "hour").collect()))
    assert got == [(1, 1), (9, 2)]


def test_ddl_quotes_names():
    from pyspark.sql import types as T
    ddl = write.create_table_ddl("db.t", T.StructType([T.StructField("a b", T.LongType())]), ["a b"])
    assert "`a b` bigint" in ddl and "PARTITIONED BY (`a b`)" in ddl


def test_failed_audit_publishes_nothing(spark, tmp_dir):
    log = os.path.join(tmp_dir, "log")
    audit = publish.BatchAudit(batch_id=5, rows=10, update_rows=3, carried_rows=7,
                               previous_rows=9, previous_rows_replaced=1,
                               written_rows_of_updated_keys=4, null_key_rows=0)
    with pytest.raises(publish.AuditError):
        publish.publish(spark, log, audit, 4)
    assert publish.last_logged_batch(spark, log) is None
    ok = publish.BatchAudit(5, 10, 3, 7, 8, 1, 3, 0)
    publish.publish(spark, log, ok, 4)
    assert publish.last_logged_batch(spark, log) == 5


def test_compaction_keeps_rows_and_reduces_files(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    df = spark.range(0, 2000).select(F.col("id"), (F.col("id") % 3).alias("part"))
    df.repartition(20).write.partitionBy("part").parquet(p)
    before = sorted(r.id for r in spark.read.parquet(p).collect())
    n = publish.compact(spark, p, ["part"], ["id"], rows_per_file=1000,
                        where=F.col("part").isin(0, 1))
    assert n == sum(1 for i in before if i % 3 in (0, 1))
    after = sorted(r.id for r in spark.read.parquet(p).collect())
    assert after == before
    files = [f for f in os.listdir(os.path.join(p, "part=0")) if f.endswith(".parquet")]
    assert len(files) <= 2
    untouched = [f for f in os.listdir(os.path.join(p, "part=2")) if f.endswith(".parquet")]
    assert len(untouched) > 2


def test_table_routing():
    from eligo.schemas import Tables
    leg = Tables.for_raw_path("/wh", "s3://landing/legacy/")
    kaf = Tables.for_raw_path("/wh", "s3://landing/kafka-stream/")
    assert leg.origin == "legacy" and kaf.origin == "kafka"
    assert kaf.cs_active == "/wh/offer_eligibility_snapshots_current_state_active_kafka"
    assert kaf.saved_offers == leg.saved_offers == "/wh/saved_offers"
    assert leg.batch_log.endswith("_batches")


def test_create_table_in_catalog(spark, tmp_dir):
    from pyspark.sql import types as T
    sch = T.StructType([T.StructField("v", T.LongType()), T.StructField("hour", T.IntegerType())])
    write.create_table(spark, "eligo_t1", sch, ["hour"], os.path.join(tmp_dir, "t1"))
    write.create_table(spark, "eligo_t1", sch, ["hour"], os.path.join(tmp_dir, "t1"))  # idempotent
    assert [f.name for f in spark.table("eligo_t1").schema.fields] == ["v", "hour"]
    spark.sql("DROP TABLE eligo_t1")


def test_audit_counts_and_tied_keys(spark, tmp_dir):
    from tests.helpers import state, state_df
    state_path = os.path.join(tmp_dir, "state")
    prev = state_df(spark, [state("u1"), state("u2"), state(None, "o1")])
    updates = state_df(spark, [state("u1", pct=0.5, batch_id=7), state("u1", pct=None, batch_id=7),
                               state("u3", batch_id=7)])
    carried = state_df(spark, [state("u2", batch_id=7), state(None, "o1", batch_id=7)])
    publish.write_batch(updates.unionByName(carried), state_path, 7)
    a = publish.audit_batch(spark, state_path, 7, updates, prev)
    assert (a.rows, a.update_rows, a.carried_rows) == (5, 3, 2)
    assert (a.previous_rows, a.previous_rows_replaced, a.written_rows_of_updated_keys) == (3, 1, 3)
    assert a.null_key_rows == 1 and a.updated_keys_with_several_rows == 1
    assert a.problems() == []


def test_each_audit_check_can_fail(spark, tmp_dir):
    """One fault at a time in a written batch, and the check that finds it."""
    from tests.helpers import state, state_df
    prev = state_df(spark, [state("u1"), state("u2"), state("u4")])
    updates = state_df(spark, [state("u1", pct=0.5, batch_id=7), state("u3", batch_id=7)])

    def problems(rows, name):
        path = os.path.join(tmp_dir, name)
        publish.write_batch(state_df(spark, rows), path, 7)
        return publish.audit_batch(spark, path, 7, updates, prev, 0).problems()

    new = [state("u1", pct=0.5, batch_id=7), state("u3", batch_id=7)]
    kept = [state("u2", batch_id=7), state("u4", batch_id=7)]
    assert problems(new + kept, "good") == []
    assert any("carried rows" in p for p in problems(new + kept[:1], "lost"))
    assert problems([*new, kept[0], state("u1", batch_id=7)], "swapped") == [
        "carried rows do not equal previous rows minus replaced ones", "an updated key also has carried rows"]
    assert problems([*new, *kept, kept[0]], "twice") == [
        "rows != updates + previous rows that were not replaced",
        "carried rows do not equal previous rows minus replaced ones"]
    assert "an updated key also has carried rows" in problems([new[0], *kept], "update lost")


def test_audit_counts_copies_of_updates(spark, tmp_dir):
    from tests.helpers import state, state_df
    path = os.path.join(tmp_dir, "copies")
    updates = state_df(spark, [state("u1", batch_id=7)] * 3 + [state("u2", batch_id=7)])
    publish.write_batch(updates, path, 7)
    a = publish.audit_batch(spark, path, 7, updates, None)
    assert (a.update_rows, a.update_row_copies, a.updated_keys_with_several_rows) == (4, 2, 1)
    assert a.problems() == []
