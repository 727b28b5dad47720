"""Randomised equivalence: the classification plan and the rule table, row by row."""

import random

import pytest

from eligo.operators import classify
from eligo.schemas import STATE_COLS
from tests.helpers import stage, stage_df, state, state_df, ts
from tests.test_classify import next_state


def scenario(seed):
    rnd = random.Random(seed)
    users = ["u1", "u2", "u3", None]
    offers = ["o1", "o2", None]

    def pick(xs, p_none=0.1):
        return None if rnd.random() < p_none else rnd.choice([x for x in xs if x is not None])

    incr = [stage(pick(users), pick(offers), updated=ts(rnd.randint(8, 10)),
                  start=ts(rnd.randint(1, 9)), pct=rnd.choice([0.5, 0.7, None]),
                  uses=rnd.randint(0, 3), pef=rnd.choice([True, False, False, None]))
            for _ in range(rnd.randint(3, 12))]
    prev = [state(pick(users), pick(offers), updated=ts(rnd.randint(7, 9)),
                  start=ts(rnd.randint(1, 6)), pct=rnd.choice([0.2, None]), uses=rnd.randint(0, 3),
                  pef=rnd.choice([True, False]), fo=rnd.choice([None, ts(1), ts(2)]),
                  sr=rnd.choice([None, ts(3)]), pr=rnd.choice([None, 0.1]), ur=rnd.choice([None, 4]))
            for _ in range(rnd.randint(0, 10))]
    return incr, prev


def norm(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*STATE_COLS).collect())


@pytest.mark.parametrize("seed", range(8))
def test_random_equivalence(spark, seed):
    incr, prev = scenario(seed)
    i, p = stage_df(spark, incr), state_df(spark, prev)
    # staging leaves no two equal rows
    incr = list({str(r): r for r in incr}.values())
    i, ref = stage_df(spark, incr), next_state(incr, prev, 2)
    assert norm(classify.next_batch(i, p, 2).rows()) == ref
    assert norm(classify.next_batch(i, p, 2, max_broadcast_bytes=0).rows()) == ref
