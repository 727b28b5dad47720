"""Saved-offer staging, MERGE upsert, expiry status and split."""

from datetime import date, datetime

import pytest

from eligo.operators import expiry, merge, offers
from eligo.schemas import SAVED_OFFER_COLS, SAVED_OFFER_SCHEMA

H = 3_600_000
MS = 1_705_363_200_000      # 2024-01-16 00:00 UTC


def raw(spark, rows):
    return spark.createDataFrame(rows, "id string, latestEndTime bigint, startTime bigint, "
                                       "endTime bigint, year int, month int, day int, hour int")


def test_stage_filters_null_and_nonpositive(spark):
    df = raw(spark, [("a", MS, None, MS, 2024, 1, 16, 1), ("b", MS, 0, 0, 2024, 1, 16, 1),
                     ("c", MS, -5, 10, 2024, 1, 16, 1), ("d", MS, MS, MS, 2024, 1, 16, 1)])
    got = {r["offer_id"] for r in offers.stage_saved_offers(df).collect()}
    assert got == {"c", "d"}


def test_stage_latest_hour_per_column_max(spark):
    df = raw(spark, [("a", MS, MS, MS + 5 * H, 2024, 1, 16, 2),
                     ("a", MS + H, MS - H, MS + 2 * H, 2024, 1, 16, 2),
                     ("a", MS + 9 * H, MS + 9 * H, MS + 9 * H, 2024, 1, 16, 1)])
    rows = offers.stage_saved_offers(df).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["hour"] == 2
    # times are wall clock in America/Chicago (UTC-6 in January)
    assert r["start_time"] == datetime(2024, 1, 15, 18)
    assert r["end_time"] == datetime(2024, 1, 15, 23)
    assert r["latest_end_time"] == datetime(2024, 1, 15, 19)


def so(spark, rows):
    return spark.createDataFrame(rows, SAVED_OFFER_SCHEMA)


def d(h):
    return datetime(2024, 1, 1, h)


def test_merge_cases(spark):
    t = so(spark, [("same", d(1), d(2), d(3), 2024, 1, 1, 1),
                   ("chg", d(1), d(2), d(3), 2024, 1, 1, 1),
                   ("nul", d(1), d(2), None, 2024, 1, 1, 1),
                   ("old", d(1), d(2), d(3), 2024, 1, 1, 1)])
    s = so(spark, [("same", d(1), d(2), d(3), 2024, 1, 2, 5),
                   ("chg", d(1), d(9), d(3), 2024, 1, 2, 5),
                   ("nul", d(1), d(2), d(4), 2024, 1, 2, 5),
                   ("new", d(1), d(2), d(3), 2024, 1, 2, 5)])
    cmp = ["start_time", "end_time", "latest_end_time"]
    out = {r["offer_id"]: r for r in merge.merge_upsert(t, s, "offer_id", cmp).collect()}
    assert out["same"]["hour"] == 1                      # unchanged -> target kept
    assert out["chg"]["end_time"] == d(9) and out["chg"]["hour"] == 5
    assert out["nul"]["latest_end_time"] is None         # NULL -> value alone: no update
    assert out["new"]["hour"] == 5 and out["old"]["hour"] == 1
    safe = {r["offer_id"]: r for r in merge.merge_upsert(t, s, "offer_id", cmp, null_safe=True).collect()}
    assert safe["nul"]["latest_end_time"] == d(4)


def test_merge_twice_is_once(spark):
    t = so(spark, [("a", d(1), d(2), d(3), 2024, 1, 1, 1)])
    s = so(spark, [("a", d(1), d(5), d(3), 2024, 1, 2, 1), ("b", d(1), d(2), d(3), 2024, 1, 2, 1)])
    cmp = ["start_time", "end_time", "latest_end_time"]
    once = merge.merge_upsert(t, s, "offer_id", cmp)
    twice = merge.merge_upsert(once, s, "offer_id", cmp)
    key = lambda df: sorted(map(tuple, df.select(*SAVED_OFFER_COLS).collect()))
    assert key(once) == key(twice)


def state_rows(spark, ids):
    return spark.createDataFrame([(i, "u") for i in ids], "offer_id string, user_id string")


def test_expiry_boundaries(spark):
    as_of = date(2024, 6, 1)
    dim = spark.createDataFrame(
        [("on_edge", datetime(2024, 3, 2, 12)),      # + 91 days = 2024-06-01: not before as_of
         ("day_less", datetime(2024, 3, 1, 23)),     # + 91 days = 2024-05-31: expired
         ("no_end", None)],
        "offer_id string, latest_end_time timestamp_ntz")
    st = state_rows(spark, ["on_edge", "day_less", "no_end", "absent"])
    out = {r["offer_id"]: r["expiry_status"] for r in
           expiry.with_expiry_status(st, dim, as_of).collect()}
    assert out == {"on_edge": "active", "day_less": "expired", "no_end": "active",
                   "absent": "active"}


def test_expiry_duplicate_dimension_rows_do_not_fan_out(spark):
    dim = spark.createDataFrame([("a", datetime(2020, 1, 1)), ("a", datetime(2024, 5, 1))],
                                "offer_id string, latest_end_time timestamp_ntz")
    out = expiry.with_expiry_status(state_rows(spark, ["a"]), dim, date(2024, 6, 1)).collect()
    assert [r["expiry_status"] for r in out] == ["active"]


@pytest.mark.parametrize("rows_per_task", [1, 1000])
def test_expiry_shuffle_path_with_salted_hot_key(spark, rows_per_task):
    dim = spark.createDataFrame([("hot", datetime(2020, 1, 1)), ("cold", datetime(2024, 5, 1))],
                                "offer_id string, latest_end_time timestamp_ntz")
    st = spark.createDataFrame([("hot", f"u{i}") for i in range(50)] + [("cold", "u"), (None, "x")],
                               "offer_id string, user_id string")
    out = expiry.with_expiry_status(st, dim, date(2024, 6, 1), max_broadcast_bytes=0,
                                    rows_per_task=rows_per_task)
    got = sorted((r["offer_id"] or "", r["expiry_status"]) for r in out.collect())
    assert got.count(("hot", "expired")) == 50
    assert ("cold", "active") in got and ("", "active") in got and len(got) == 52


def test_split(spark):
    df = spark.createDataFrame([("a", "active"), ("b", "expired"), ("c", None)],
                               "offer_id string, expiry_status string")
    act, ina = expiry.split_by_expiry(df)
    assert [r[0] for r in act.collect()] == ["a"] and [r[0] for r in ina.collect()] == ["b"]


def test_merge_null_keys_kept_and_inserted(spark):
    t = so(spark, [(None, d(1), d(2), d(3), 2024, 1, 1, 1), ("a", d(1), d(2), d(3), 2024, 1, 1, 1)])
    s = so(spark, [(None, d(5), d(6), d(7), 2024, 1, 2, 1)])
    out = merge.merge_upsert(t, s, "offer_id", ["start_time", "end_time", "latest_end_time"])
    got = sorted((r["offer_id"] or "", r["start_time"]) for r in out.collect())
    assert got == [("", d(1)), ("", d(5)), ("a", d(1))]


def test_lookup_salts_hot_keys(spark):
    from eligo.operators.joins import lookup_join
    from tests.helpers import explain
    dim = spark.createDataFrame([("hot", 1), ("cold", 2)], "offer_id string, v int")
    fact = spark.createDataFrame([("hot", i) for i in range(40)] + [("cold", 0), (None, 1)],
                                 "offer_id string, u int")
    out = lookup_join(fact, dim, "offer_id", "left", max_broadcast_bytes=0, rows_per_task=10)
    assert "_salt" in explain(out, "simple")          # the salted join ran
    got = sorted((r.offer_id or "", r.u, r.v) for r in out.collect())
    assert got == sorted([("hot", i, 1) for i in range(40)] + [("cold", 0, 2), ("", 1, None)])


def test_lookup_still_salts_when_hot_keys_do_not_fit(spark):
    """Too long a hot list is cut to the hottest keys; copies of one row spread over the buckets."""
    from eligo.operators.joins import lookup_join
    dim = spark.range(400).selectExpr("CAST(id AS string) AS offer_id", "id AS v")
    fact = spark.range(4000).selectExpr("CAST(id % 400 AS string) AS offer_id", "1 AS u").unionAll(
        spark.range(3000).selectExpr("'7'", "1")).repartition(16)
    out = lookup_join(fact, dim, "offer_id", "left", max_broadcast_bytes=0, rows_per_task=5,
                      hot_keys_broadcast_bytes=0)
    got = {r.offer_id: r for r in out.groupBy("offer_id").agg({"u": "count", "v": "max"}).collect()}
    assert len(got) == 400 and all(int(k) == r["max(v)"] for k, r in got.items())
    assert {k: r["count(u)"] for k, r in got.items()} == {str(i): 3010 if i == 7 else 10 for i in range(400)}
