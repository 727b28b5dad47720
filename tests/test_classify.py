"""One fixture per rule of the classification table, plus invariants."""

from decimal import Decimal

import pytest

from eligo.operators import classify
from eligo.schemas import STAGE_COLS, STATE_COLS
from tests.helpers import rows_by_key, stage, stage_df, state, state_df, ts

BATCH = 2


def run(spark, incr_rows, prev_rows, max_broadcast_bytes=64 << 20):
    incr = stage_df(spark, incr_rows)
    prev = state_df(spark, prev_rows) if prev_rows is not None else None
    nb = classify.next_batch(incr, prev, BATCH, max_broadcast_bytes)
    return nb, rows_by_key(nb.updates), rows_by_key(nb.carried)


def test_n1_n2_new_mappings(spark):
    nb, upd, car = run(spark, [stage("u1", "o1", pef=False, start=ts(9)),
                               stage("u2", "o1", pef=True)], [])
    n1, n2 = upd[("u1", "o1")][0], upd[("u2", "o1")][0]
    assert n1["start_time_first_observed"] == ts(9)
    assert n1["start_time_recently_observed"] is None and n1["uses_recently_observed"] is None
    assert n2["start_time_first_observed"] is None
    assert n1["expiry_status"] == "active" and n1["batch_id"] == BATCH
    assert car == {}


def test_no_earlier_batch_all_new(spark):
    nb, upd, car = run(spark, [stage("u1"), stage("u2", pef=True)], None)
    assert set(upd) == {("u1", "o1"), ("u2", "o1")} and car == {}


def test_m1(spark):
    prev = [state(fo=None, sr=ts(2), pr=0.1, ur=7)]
    _, upd, car = run(spark, [stage(start=ts(9))], prev)
    r = upd[("u1", "o1")][0]
    assert r["start_time_first_observed"] == ts(9)
    assert (r["start_time_recently_observed"], r["percentage_recently_observed"],
            r["uses_recently_observed"]) == (ts(2), 0.1, Decimal(7))
    assert car == {}


def test_m2(spark):
    prev = [state(fo=ts(1), sr=ts(2), pr=0.1, ur=7, start=ts(4), pct=0.3, uses=5)]
    _, upd, _ = run(spark, [stage(start=ts(9), pct=0.9, uses=8)], prev)
    r = upd[("u1", "o1")][0]
    assert r["start_time_first_observed"] == ts(1)
    assert (r["start_time_recently_observed"], r["percentage_recently_observed"],
            r["uses_recently_observed"]) == (ts(4), 0.3, Decimal(5))
    assert (r["start_time"], r["percentage"], r["uses"]) == (ts(9), 0.9, Decimal(8))


def test_m3(spark):
    prev = [state(fo=ts(1), sr=ts(2), pr=0.1, ur=7, start=ts(4), pct=0.3, uses=5)]
    _, upd, _ = run(spark, [stage(start=ts(9), pct=None)], prev)
    r = upd[("u1", "o1")][0]
    assert (r["start_time_first_observed"], r["start_time_recently_observed"],
            r["percentage_recently_observed"], r["uses_recently_observed"]) == \
        (ts(1), ts(4), 0.1, Decimal(5))


def test_m4(spark):
    prev = [state(fo=None, sr=ts(2), pr=0.1, ur=7)]
    _, upd, _ = run(spark, [stage(pef=True)], prev)
    r = upd[("u1", "o1")][0]
    assert (r["start_time_first_observed"], r["start_time_recently_observed"],
            r["percentage_recently_observed"], r["uses_recently_observed"]) == \
        (None, ts(2), 0.1, Decimal(7))


def test_gap_and_stale_carry_previous_row(spark):
    prev = [state("u1", fo=ts(1)), state("u2", updated=ts(20))]
    nb, upd, car = run(spark, [stage("u1", pef=True), stage("u2", updated=ts(10))], prev)
    assert upd == {}
    assert set(car) == {("u1", "o1"), ("u2", "o1")}
    assert all(r[0]["batch_id"] == BATCH for r in car.values())
    labels = {r["rule"] for r in nb.pairs.collect()}
    assert labels == {"gap", "stale"}


def test_pef_null(spark):
    prev = [state("u1")]
    nb, upd, car = run(spark, [stage("u1", pef=None), stage("u9", pef=None)], prev)
    assert upd == {}
    assert set(car) == {("u1", "o1")}      # known key carried, new key lost


def test_ties_keep_all_pairs(spark):
    # two increment rows for one key (differ in percentage) x one previous row
    prev = [state(fo=ts(1))]
    _, upd, _ = run(spark, [stage(pct=0.5), stage(pct=None)], prev)
    assert sorted(r["percentage"] is None for r in upd[("u1", "o1")]) == [False, True]


def test_null_keys_never_match(spark):
    prev = [state(None, "o1"), state("u1", None)]
    _, upd, car = run(spark, [stage(None, "o1"), stage("u2", None)], prev)
    assert len(upd[(None, "o1")]) == 1 and len(upd[("u2", None)]) == 1
    assert len(car[(None, "o1")]) == 1 and len(car[("u1", None)]) == 1


def _scenario():
    incr = [stage("u1", start=ts(9)), stage("u2", pef=True), stage("u3", pct=None),
            stage("u4", pef=True), stage("u5", updated=ts(3)), stage("u6", pef=None),
            stage("u7"), stage("u7", pct=None), stage("u8", uses=None)]
    prev = [state("u1"), state("u2", fo=ts(1)), state("u3", fo=ts(1)), state("u4"),
            state("u5"), state("u6"), state("u7", fo=ts(1)), state("u7", fo=ts(1), pct=0.2),
            state("u10"), state("u11", pef=True)]
    return incr, prev


def test_broadcast_and_shuffle_paths_agree(spark):
    incr, prev = _scenario()
    a, _, _ = run(spark, incr, prev)
    b, _, _ = run(spark, incr, prev, max_broadcast_bytes=0)
    def norm(df):
        return sorted(tuple(str(v) for v in r) for r in df.collect())
    assert norm(a.rows()) == norm(b.rows())


def update_for(new, old):
    """The state columns a rule sets for an increment row and a previous row of its key (or None):
    (first observed, start, percentage, uses recently observed), or None if there is no update."""
    soon = new["potentiallyeligibleinfuture"]
    if soon is None:
        return None
    if old is None:
        return (None if soon else new["start_time"], None, None, None)
    if new["updated"] is None or old["updated"] is None or new["updated"] <= old["updated"]:
        return None
    seen = old["start_time_first_observed"]
    kept = [old[f"{c}_recently_observed"] for c in ("start_time", "percentage", "uses")]
    if seen is None:
        return (None if soon else new["start_time"], *kept)
    if soon:
        return None
    pct = kept[1] if new["percentage"] is None else old["percentage"]
    return (seen, old["start_time"], pct, old["uses"])


def next_state(incr, prev, batch_id):
    """The next batch row by row, from the rule table: rows as tuples of text, sorted."""
    def key(r):
        return None if None in (r["user_id"], r["offer_id"]) else (r["user_id"], r["offer_id"])

    pairs = {}
    for new in incr:
        olds = [h for h in prev if key(h) is not None and key(h) == key(new)] or [None]
        for old in olds:
            got = update_for(new, old)
            if got is None:
                continue
            row = dict(new, expiry_status="active", batch_id=batch_id, **dict(zip(
                ("start_time_first_observed", "start_time_recently_observed",
                 "percentage_recently_observed", "uses_recently_observed"), got)))
            seen = None if old is None else tuple(str(old[c]) for c in (
                "start_time_first_observed", "start_time_recently_observed", "percentage_recently_observed",
                "uses_recently_observed", "start_time", "percentage", "uses"))
            at = len(pairs) if old is None else (tuple(str(new[c]) for c in STAGE_COLS), seen)
            pairs[at] = row                    # a matched pair counts once
    updated = {key(r) for r in pairs.values()} - {None}
    carried = [dict(h, batch_id=batch_id) for h in prev if key(h) not in updated]
    return sorted(tuple(str(r[c]) for c in STATE_COLS) for r in [*pairs.values(), *carried])


def test_plan_equals_the_rule_table(spark):
    incr, prev = _scenario()
    ours = classify.next_batch(stage_df(spark, incr), state_df(spark, prev), BATCH).rows()
    assert sorted(tuple(str(v) for v in r) for r in ours.select(*STATE_COLS).collect()) \
        == next_state(incr, prev, BATCH)


def test_invariants(spark):
    incr, prev = _scenario()
    nb, upd, car = run(spark, incr, prev)
    assert not set(upd) & set(car)                       # no key both updated and carried
    hist_keys = {(r["user_id"], r["offer_id"]) for r in prev}
    new_keys = {(r["user_id"], r["offer_id"]) for r in incr
                if r["potentiallyeligibleinfuture"] is not None}
    assert set(upd) | set(car) == hist_keys | new_keys


@pytest.mark.parametrize("max_bytes", [64 << 20, 0])
def test_plan_keeps_state_unshuffled_when_small(spark, max_bytes):
    incr, prev = _scenario()
    nb = classify.next_batch(stage_df(spark, incr), state_df(spark, prev), BATCH, max_bytes)
    plan = nb.carried._jdf.queryExecution().executedPlan().toString()
    if max_bytes:
        assert "BroadcastHashJoin" in plan
    else:
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
