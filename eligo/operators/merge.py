"""MERGE-style upsert of a keyed source into a keyed target, as a join.

Parquet has no row-level MERGE, so the merged table is computed as a full
outer join and written as a whole:

* key only in the target           -> target row
* key only in the source           -> source row (inserted)
* key in both, a compared column changed -> source row (updated)
* key in both, nothing changed     -> target row

"Changed" is ``s.c != t.c`` OR-ed over the compared columns, with SQL's
three-valued logic: a comparison with NULL is not TRUE, so a NULL -> value
change alone does not update.  ``null_safe=True`` counts it as a change.
A NULL key never matches: such source rows are inserted on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_upsert(target: DataFrame, source: DataFrame, key: str,
                 compare: list[str], null_safe: bool = False) -> DataFrame:
    cols = target.columns
    if sorted(cols) != sorted(source.columns):
        raise ValueError("target and source need the same columns")
    # NULL keys match nothing: those target rows stay and those source rows are
    # inserted without going through the join (where they would all share one task).
    null_target = target.where(F.col(key).isNull()).select(*cols)
    null_source = source.where(F.col(key).isNull()).select(*cols)
    target = target.where(F.col(key).isNotNull())
    source = source.where(F.col(key).isNotNull())
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in cols], F.lit(True).alias("_t"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in cols], F.lit(True).alias("_s"))
    j = t.join(s, F.col(f"t_{key}") == F.col(f"s_{key}"), "full_outer")

    changed = F.lit(False)
    for c in compare:
        if null_safe:
            diff = ~F.col(f"s_{c}").eqNullSafe(F.col(f"t_{c}"))
        else:
            diff = F.col(f"s_{c}") != F.col(f"t_{c}")
        changed = changed | diff
    take_source = F.col("_t").isNull() | (F.col("_s").isNotNull() & F.coalesce(changed, F.lit(False)))
    merged = j.select(*[F.when(take_source, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c)
                        for c in cols])
    return merged.unionByName(null_target).unionByName(null_source)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once (a MERGE source must have none)."""
    return df.groupBy(key).count().where(F.col("count") > 1)
