"""C02-C04 edge cases: flatten both payload formats, then stage."""

import json
from decimal import Decimal


from eligo.functions.time import epoch_ms_to_ts, epoch_ms_to_ts_sql
from eligo.operators import flatten
from eligo.operators.latest import latest_per_key
from eligo.schemas import FLAT_COLS, STAGE_COLS

MS = 1_705_363_200_000      # 2024-01-16 00:00:00 UTC


def legacy_df(spark, payloads):
    return spark.createDataFrame([(p,) for p in payloads], flatten.LEGACY_SCHEMA)


def offer(oid="o1", updated_progress=None, **kw):
    o = {"offerId": oid, "creationTime": MS, "audience": True, "banditStatus": "b",
         "experimentStatus": "e", "holdout": False, "invalidationTime": MS,
         "startTime": MS, "endTime": MS + 1000, "potentiallyEligibleInFuture": False,
         "progress": {"type": "uses", "uses": 3, "percentage": 0.5, "quantity": "12.5"}}
    o.update(kw)
    return o


def payload(user="u1", updated=MS, offers=None):
    return json.dumps({"userId": user, "updated": str(updated),
                       "offers": [offer()] if offers is None else offers})


def test_legacy_flatten_fields(spark):
    rows = flatten.legacy(legacy_df(spark, [payload()])).collect()
    assert len(rows) == 1 and list(rows[0].asDict()) == FLAT_COLS
    r = rows[0]
    assert r["user_id"] == "u1" and r["offer_id"] == "o1"
    assert str(r["updated_ts"]) == "2024-01-16 00:00:00"
    assert r["audience"] == "true" and r["progress_uses"] == "3"
    assert r["progress_dollars"] is None          # absent key -> NULL


def test_offers_missing_empty_malformed_non_array(spark):
    bad = [json.dumps({"userId": "u", "updated": str(MS)}),
           json.dumps({"userId": "u", "updated": str(MS), "offers": None}),
           json.dumps({"userId": "u", "updated": str(MS), "offers": []}),
           json.dumps({"userId": "u", "updated": str(MS), "offers": {"offerId": "x"}}),
           '{"userId": "u", "offers": [{"offerId": "x"',
           "not json", None]
    assert flatten.legacy(legacy_df(spark, bad)).count() == 0


def test_progress_as_text_and_missing(spark):
    p1 = payload(offers=[offer(progress=json.dumps({"uses": 4, "quantity": 2}))])
    o = offer()
    del o["progress"]
    p2 = payload(user="u2", offers=[o])
    flat = flatten.legacy(legacy_df(spark, [p1, p2]))
    st = {r["user_id"]: r for r in latest_per_key(flat).collect()}
    assert st["u1"]["uses"] == Decimal(4) and st["u1"]["quantity"] == Decimal(2)
    assert st["u2"]["uses"] is None and st["u2"]["quantity"] == Decimal(0)   # NVL -> 0


def test_quantity_text_is_typed_safely(spark):
    ps = [payload(user=f"u{i}", offers=[offer(progress={"quantity": q})])
          for i, q in enumerate(["12.5", "abc", "11.5"])]
    st = {r["user_id"]: r["quantity"] for r in
          latest_per_key(flatten.legacy(legacy_df(spark, ps))).collect()}
    assert st == {"u0": Decimal(13), "u1": None, "u2": Decimal(12)}


def test_kafka_status_placeholder(spark):
    row = ("u1", MS, [("o1", MS, None, MS, MS, True, False, False,
                       ("uses", 2, 1.5, 3.0, 4, 0.5, 7, 8))])
    df = spark.createDataFrame([row], flatten.KAFKA_SCHEMA)
    r = flatten.kafka(df).collect()[0]
    assert r["bandit_status"] == "NULL" and r["experiment_status"] == "NULL"
    assert r["progress_quantity"] == 7 and r["invalidation_time"] is None


def _flat_rows(spark, rows):
    # rows: (user, offer, updated_ms, uses, pct)
    ps = [payload(user=u, updated=ms, offers=[offer(oid=o, progress={"uses": n, "percentage": p})])
          for u, o, ms, n, p in rows]
    return flatten.legacy(legacy_df(spark, ps))


def test_same_second_uses_collapse_to_max(spark):
    st = latest_per_key(_flat_rows(spark, [("u", "o", MS, 1, 0.5), ("u", "o", MS, 3, 0.5)]))
    rows = st.collect()
    assert len(rows) == 1 and rows[0]["uses"] == Decimal(3)
    assert st.columns == STAGE_COLS


def test_same_second_percentage_differs_keeps_two(spark):
    st = latest_per_key(_flat_rows(spark, [("u", "o", MS, 1, 0.5), ("u", "o", MS, 1, 0.7)]))
    assert st.count() == 2


def test_milliseconds_dropped_so_versions_tie(spark):
    st = latest_per_key(_flat_rows(spark, [("u", "o", MS + 100, 1, 0.5),
                                           ("u", "o", MS + 300, 5, 0.5)]))
    assert [r["uses"] for r in st.collect()] == [Decimal(5)]


def test_latest_wins(spark):
    st = latest_per_key(_flat_rows(spark, [("u", "o", MS, 9, 0.5), ("u", "o", MS + 5000, 1, 0.5)]))
    assert [r["uses"] for r in st.collect()] == [Decimal(1)]


def test_latest_plan_limits_before_each_shuffle(spark):
    st = latest_per_key(_flat_rows(spark, [("u", "o", MS, 1, 0.5)]))
    from tests.helpers import explain
    lines = [ln.strip() for ln in explain(st, "simple").splitlines()]
    ex = [i for i, ln in enumerate(lines) if "Exchange hashpartitioning" in ln]
    assert len(ex) == 2
    # below each exchange a partial window limit; copies collapse between the two
    assert any("WindowGroupLimit" in ln for ln in lines[ex[0]:ex[1]])
    assert any("WindowGroupLimit" in ln for ln in lines[ex[1]:])
    assert any("HashAggregate" in ln and "max(uses" in ln for ln in lines[ex[0]:ex[1]])
    assert "_task" in lines[ex[1]] and "_task" not in lines[ex[0]]


def test_hot_key_with_copies_and_ties_over_many_tasks(spark):
    rows = ([("u", "o", MS, n % 7, 0.5) for n in range(300)] + [("u", "o", MS, n % 5, 0.7) for n in range(200)]
            + [("u", "o", MS - 1000 * n, 9, 0.9) for n in range(1, 300)] + [("v", "o", MS, 1, 0.1)])
    flat = _flat_rows(spark, rows).repartition(13)
    got = sorted((r["user_id"], r["percentage"], int(r["uses"])) for r in latest_per_key(flat).collect())
    assert got == [("u", 0.5, 6), ("u", 0.7, 4), ("v", 0.1, 1)]
    one = latest_per_key(flat, tiebreak=True).where("user_id = 'u'").collect()
    assert [(r["percentage"], int(r["uses"])) for r in one] == [(0.7, 4)]


def test_copies_of_one_snapshot_collapse(spark):
    rows = [("u", "o", MS, 2, 0.5)] * 50 + [("u", "o", MS - 1000, 9, 0.5)] * 20
    st = latest_per_key(_flat_rows(spark, rows)).collect()
    assert len(st) == 1 and st[0]["uses"] == Decimal(2)


def test_tiebreak_keeps_one_row_deterministically(spark):
    rows = [("u", "o", MS, 1, 0.5), ("u", "o", MS, 1, 0.7), ("u", "o", MS, 1, None)]
    a = latest_per_key(_flat_rows(spark, rows), tiebreak=True).collect()
    b = latest_per_key(_flat_rows(spark, list(reversed(rows))), tiebreak=True).collect()
    assert len(a) == 1 and a == b and a[0]["percentage"] == 0.7


def test_sentinel_epochs_give_null(spark):
    """Numbers beyond the years 1 to 9999 are NULL, with ANSI on and off, and stop nothing."""
    values = ["9223372036854775807", "-9223372036854775808", "1e300", "253402300799999", "253402300800000",
              "-62135596800000", "NaN", "abc", None, "0"]
    df = spark.createDataFrame([(v,) for v in values], "ms string")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            a = [r[0] for r in df.select(epoch_ms_to_ts("ms")).collect()]
            b = [r[0] for r in df.selectExpr(epoch_ms_to_ts_sql("ms")).collect()]
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
        assert a == b
        assert [x is None for x in a] == [True, True, True, False, True, False, True, True, True, False]
