"""Classify the staged increment against the last state batch and
assemble the next full batch.

Rules (pef = potentiallyeligibleinfuture, "h" = the previous state row):

  rule  key in h?  condition                          first_obs  start_rec  pct_rec  uses_rec
  N1    no         pef false                          start      NULL       NULL     NULL
  N2    no         pef true                           NULL       NULL       NULL     NULL
  M1    fresher    h.first_obs NULL, pef false        start      h          h        h
  M2    fresher    h.first_obs set, pef false, pct    h          h.start    h.pct    h.uses
  M3    fresher    h.first_obs set, pef false, !pct   h          h.start    h        h.uses
  M4    fresher    h.first_obs NULL, pef true         h          h          h        h
  gap   fresher    h.first_obs set, pef true          no update: previous row carried
  stale key in h, not fresher (updated <= h.updated)  no update: previous row carried
  pef NULL                                            no update (carried when known)

"fresher" means ``incr.updated > h.updated``.  All other output columns are the
increment's.  A key gets the update rows of all its (increment row, previous
row) pairs; a previous row is carried into the new batch only when its key got
no update row at all.

Plan for the hourly shape (small increment, large state):

* the increment's distinct keys are measured once and, when small, broadcast;
* a map-only semi join picks the few previous rows that share a key with the
  increment (ten columns of them), and the rules evaluate in one left join of
  the increment with those rows, one CASE per column;
* the carried rows are one map-only anti join of the state against the
  updated keys (a subset of the measured keys, so equally bounded).
  The state is scanned, never shuffled.
* when the key set is too large to broadcast, the same joins run as shuffle joins on (user_id, offer_id) of the few
  state rows whose key meets a bitmap of the increment's keys; all others pass map-only;
* of a state that lies in directories by offer (``offer_buckets``) the touched rows are read from the increment's directories only;
* a state table bucketed by the key (``buckets``) is not moved at all: the keys are dealt out like its buckets.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eligo.operators.joins import (
    DEFAULT_BROADCAST_BYTES, KeySet, anti_join, bucketed_anti_join, key_set, pruned_semi_join, semi_join,
    split_null_keys,
)
from eligo.schemas import EXPIRY_ACTIVE, KEY_COLS, OFFER_BUCKET, STAGE_COLS, STATE_COLS, STATE_SCHEMA

UPDATE_RULES = ["N1", "N2", "M1", "M2", "M3", "M4"]
# Pairs whose increment row is fresher than the previous row ("matches").
MATCH_LABELS = ["M1", "M2", "M3", "M4", "gap", "pef_null"]
# Labels of pairs that produce no update row.
NO_UPDATE_LABELS = ["gap", "pef_null", "stale", "new_pef_null"]

# Previous-state columns the rules read, renamed so they sit beside the
# increment's own columns.
_H = {
    "updated": "h_updated",
    "start_time_first_observed": "h_first_observed",
    "start_time_recently_observed": "h_start_recent",
    "percentage_recently_observed": "h_pct_recent",
    "uses_recently_observed": "h_uses_recent",
    "start_time": "h_start",
    "percentage": "h_pct",
    "uses": "h_uses",
}
# Columns the reference de-duplicates a matched pair on (besides the increment's).
_PAIR_HIST_COLS = ["h_first_observed", "h_start_recent", "h_pct_recent", "h_uses_recent",
                   "h_start", "h_pct", "h_uses"]


def label_pairs(incr: DataFrame, prev: DataFrame | None) -> DataFrame:
    """Every (increment row, previous row of its key) pair with its rule label.

    Increment rows without a previous row appear once with NULL ``h_*``.
    Pairs identical in the increment's columns, the seven previous-state
    columns and the label are kept once (only matched pairs can repeat: staged
    rows are distinct, so without a previous batch there is nothing to drop and
    no shuffle is spent on it).
    """
    incr = incr.select(*STAGE_COLS)
    nothing = ["*", "CAST(NULL AS boolean) AS _h",
               *[f"CAST(NULL AS {STATE_SCHEMA[k].dataType.simpleString()}) AS {v}" for k, v in _H.items()]]
    if prev is None:
        joined = incr.selectExpr(*nothing)
    else:
        h = prev.selectExpr(*KEY_COLS, "true AS _h", *[f"{k} AS {v}" for k, v in _H.items()])
        # a NULL key matches nothing: those rows stay out of the join, where they would share one task
        keyed, unkeyed = split_null_keys(incr, KEY_COLS)
        joined = keyed.join(h, KEY_COLS, "left").unionByName(unkeyed.selectExpr(*nothing))
    out = joined.selectExpr(*STAGE_COLS, *_PAIR_HIST_COLS, f"{_LABEL_SQL} AS rule")
    return out if prev is None else out.dropDuplicates()


# The label of a pair, in the order the rules are tested.
_LABEL_SQL = """CASE
  WHEN _h IS NULL AND NOT potentiallyeligibleinfuture THEN 'N1'
  WHEN _h IS NULL AND potentiallyeligibleinfuture THEN 'N2'
  WHEN _h IS NULL THEN 'new_pef_null'
  WHEN NOT coalesce(updated > h_updated, false) THEN 'stale'
  WHEN potentiallyeligibleinfuture IS NULL THEN 'pef_null'
  WHEN h_first_observed IS NULL AND NOT potentiallyeligibleinfuture THEN 'M1'
  WHEN NOT potentiallyeligibleinfuture AND percentage IS NOT NULL THEN 'M2'
  WHEN NOT potentiallyeligibleinfuture THEN 'M3'
  WHEN h_first_observed IS NULL THEN 'M4'
  ELSE 'gap'
END"""

# Output columns the rules set; every other column is the increment's.
_RULE_SQL = {
    "start_time_first_observed": """CASE WHEN rule IN ('N1', 'M1') THEN start_time
        WHEN rule = 'N2' THEN NULL ELSE h_first_observed END""",
    "start_time_recently_observed": """CASE WHEN rule IN ('N1', 'N2') THEN NULL
        WHEN rule IN ('M2', 'M3') THEN h_start ELSE h_start_recent END""",
    "percentage_recently_observed": """CASE WHEN rule IN ('N1', 'N2') THEN NULL
        WHEN rule = 'M2' THEN h_pct ELSE h_pct_recent END""",
    "uses_recently_observed": """CASE WHEN rule IN ('N1', 'N2') THEN NULL
        WHEN rule IN ('M2', 'M3') THEN h_uses ELSE h_uses_recent END""",
    "expiry_status": f"'{EXPIRY_ACTIVE}'",
}


def updates_from_pairs(pairs: DataFrame, batch_id: int) -> DataFrame:
    """Update rows (rules N1-M4) in the state layout under ``batch_id``."""
    derived = dict(_RULE_SQL, batch_id=str(int(batch_id)))
    exprs = [f"CAST({derived.get(c, c)} AS {STATE_SCHEMA[c].dataType.simpleString()}) AS {c}"
             for c in STATE_COLS]
    return pairs.where(F.col("rule").isin(*UPDATE_RULES)).selectExpr(*exprs)


@dataclass
class NextBatch:
    """The pieces of the next state batch; ``rows()`` is their union."""

    updates: DataFrame       # N1-M4 rows
    carried: DataFrame       # previous rows whose key got no update
    pairs: DataFrame         # labelled pairs (for audit and counts)
    touched: DataFrame | None = None   # previous rows that share a key with the increment

    def rows(self) -> DataFrame:
        return self.updates.unionByName(self.carried)


def next_batch(incr: DataFrame, prev: DataFrame | None, batch_id: int,
               max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
               materialize: Callable[[DataFrame, str], DataFrame] | None = None,
               max_bitmap_bytes: int | None = None, buckets: int = 0,
               keep_touched: bool = False, offer_buckets: int = 0) -> NextBatch:
    """Classify ``incr`` (staged rows) against ``prev`` (one full state batch, in ``buckets`` buckets by key if any).

    ``prev`` of ``None`` is the first batch: every row is a new mapping.
    ``materialize`` (e.g. ``session.materialize``) stores the labelled pairs
    once; they feed both the update rows and the keys the carry-forward
    excludes, and would otherwise be computed twice; ``keep_touched`` stores the touched rows too, for an audit.
    """
    keep = materialize or (lambda df, _name: df)
    if prev is None:
        pairs = keep(label_pairs(incr, None), "pairs")
        updates = updates_from_pairs(pairs, batch_id)
        carried = updates.limit(0)
        return NextBatch(updates, carried, pairs)

    lies = prev if offer_buckets and OFFER_BUCKET in prev.columns else None   # in directories by offer
    prev = prev.select(*STATE_COLS)
    # measured once; a bucketed state needs no filter before its joins
    incr_keys = key_set(incr, KEY_COLS, max_broadcast_bytes, 0 if buckets else max_bitmap_bytes)
    if buckets and not incr_keys.broadcast:
        incr_keys = KeySet(incr_keys.frame.repartition(buckets, *KEY_COLS).hint("merge"), tuple(KEY_COLS), False)
    # The rules read ten columns of the few previous rows that share a key
    # with the increment; column pruning keeps the scan to those columns.
    found = semi_join(prev, incr_keys, KEY_COLS) if lies is None else pruned_semi_join(
        lies, incr, KEY_COLS, offer_buckets, max_broadcast_bytes, OFFER_BUCKET)
    touched = found.select(*dict.fromkeys([*KEY_COLS, *_H]))
    if keep_touched:
        touched = keep(touched, "touched")
    # A key set past the broadcast limit is no bound on the rows that share its keys either.
    pairs = keep(label_pairs(incr, touched if incr_keys.broadcast else touched.hint("merge")), "pairs")
    updates = updates_from_pairs(pairs, batch_id)
    # Updated keys are a subset of the increment's keys, so the size bound
    # measured above holds for them too: no second measurement.
    update_keys = updates.select(*KEY_COLS).dropDuplicates()
    if buckets and not incr_keys.broadcast:
        left = bucketed_anti_join(prev, update_keys, KEY_COLS, buckets)
    else:
        # The increment's bitmap holds for them as well.
        left = anti_join(prev, KeySet(F.broadcast(update_keys) if incr_keys.broadcast else update_keys.hint("merge"),
                                      tuple(KEY_COLS), incr_keys.broadcast, incr_keys.bitmap), KEY_COLS)
    carried = (left.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
               .select(*STATE_COLS))
    return NextBatch(updates, carried, pairs, touched)
