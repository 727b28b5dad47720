"""Key sets past the broadcast limit stay off the driver; the audit compares whole rows only where keys repeat."""

from datetime import datetime, timedelta

from eligo.operators import classify
from eligo.operators.joins import MAX_BITMAP_BYTES, key_set, semi_join
from eligo.operators.latest import latest_per_key
from eligo.plans import standins as S
from eligo.schemas import KEY_COLS
from eligo.sinks.publish import _repeats


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def some_keys(spark, n):
    return spark.range(n).selectExpr("concat('u', id % 97) AS user_id", "concat('o', id % 11) AS offer_id", "id AS v")


def test_a_key_set_past_the_limit_is_never_broadcast(spark):
    """However small the planner takes it to be."""
    ks = key_set(some_keys(spark, 50), KEY_COLS, 0, 0)
    joined = plan(semi_join(some_keys(spark, 500), ks, KEY_COLS))
    assert "SortMergeJoin" in joined and "Broadcast" not in joined
    assert MAX_BITMAP_BYTES <= 16 * 1024 * 1024


def test_touched_rows_past_the_limit_are_not_broadcast(spark):
    events = spark.createDataFrame(
        [(i, datetime(2024, 1, 10) + timedelta(hours=i), i % 7, "view", 1.5, '{"k": 3}') for i in range(200)],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    hist, incr = (latest_per_key(x) for x in S.split_history(S.snapshot_flat(events)))
    prev = classify.next_batch(hist, None, 1).rows()
    joined = plan(classify.next_batch(incr, prev, 2, max_broadcast_bytes=0, max_bitmap_bytes=0).pairs)
    assert "BroadcastHashJoin" not in joined and joined.count("SortMergeJoin") == 2


def test_both_sides_of_a_bitmap_share_its_broadcast(spark):
    ks = key_set(some_keys(spark, 50), KEY_COLS, 0)
    maybe, surely_not = ks.bitmap.split(some_keys(spark, 500))
    both = maybe.unionByName(surely_not)
    both.collect()
    final = plan(both)
    assert final.count("ReusedExchange") >= 1 and both.count() == 500


def test_repeats_compare_whole_rows_only_among_repeated_keys(spark):
    cols = "user_id string, offer_id string, v int"
    assert _repeats(spark.createDataFrame([("a", "1", 1), ("b", "1", 1), (None, "1", 1)], cols)) == (0, 0)
    rows = [("a", "1", 1), ("a", "1", 1), ("a", "1", 2), ("b", "1", None), ("b", "1", None), ("c", "1", 1),
            (None, "1", 7), (None, "1", 7), (None, None, 7), ("d", None, 1), ("d", None, 2)]
    assert _repeats(spark.createDataFrame(rows, cols)) == (4, 3)
