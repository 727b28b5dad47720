"""Small hand-made rows in the staging and state layouts."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from eligo.schemas import STAGE_SCHEMA, STATE_SCHEMA

T0 = datetime(2024, 1, 1, 0, 0, 0)


def ts(day: int, hour: int = 0, sec: int = 0) -> datetime:
    return datetime(2024, 1, day, hour, 0, sec)


def stage(user="u1", offer="o1", updated=None, start=None, pct=0.5, uses=1, pef=False, **kw):
    row = {
        "user_id": user, "updated": updated or ts(10), "offer_id": offer,
        "start_time": start or ts(10), "end_time": ts(30), "creation_time": ts(1),
        "invalidation_time": None, "dollars": 1.0, "percentage": pct,
        "quantity": Decimal(0), "holdout": False, "meta": "NA", "ranking": Decimal("0.0"),
        "potentiallyeligibleinfuture": pef, "audience": True,
        "uses": None if uses is None else Decimal(uses),
        "bandit_status": "b", "experiment_status": "e",
    }
    row.update(kw)
    return row


def state(user="u1", offer="o1", updated=None, start=None, pct=0.5, uses=1, pef=False,
          fo=None, sr=None, pr=None, ur=None, batch_id=1, expiry="active", **kw):
    row = stage(user, offer, updated or ts(5), start or ts(5), pct, uses, pef, **kw)
    row.update({
        "start_time_first_observed": fo, "start_time_recently_observed": sr,
        "percentage_recently_observed": pr,
        "uses_recently_observed": None if ur is None else Decimal(ur),
        "expiry_status": expiry, "batch_id": batch_id,
    })
    return row


def stage_df(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in STAGE_SCHEMA.fieldNames()) for r in rows],
                                 STAGE_SCHEMA)


def state_df(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in STATE_SCHEMA.fieldNames()) for r in rows],
                                 STATE_SCHEMA)


def rows_by_key(df):
    out = {}
    for r in df.collect():
        out.setdefault((r["user_id"], r["offer_id"]), []).append(r.asDict())
    return out


def explain(df, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)
