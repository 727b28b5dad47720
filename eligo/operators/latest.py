"""Latest version of each (user_id, offer_id), typed to the staging layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eligo.functions.casts import nvl_decimal_sql, typed_sql
from eligo.schemas import META_DEFAULT, STAGE_COLS


def typed_stage_columns() -> list[str]:
    """FLAT_COLS -> STAGE_COLS as SQL expressions (``uses`` last but one, as staged).

    Landed text is typed with ``try_cast``: a value that does not parse is
    NULL, never a failed job.
    """
    return [
        "CAST(user_id AS string) AS user_id",
        f"{typed_sql('updated_ts', 'timestamp_ntz')} AS updated",
        "CAST(offer_id AS string) AS offer_id",
        f"{typed_sql('start_time', 'timestamp_ntz')} AS start_time",
        f"{typed_sql('end_time', 'timestamp_ntz')} AS end_time",
        f"{typed_sql('creation_time', 'timestamp_ntz')} AS creation_time",
        f"{typed_sql('invalidation_time', 'timestamp_ntz')} AS invalidation_time",
        f"{typed_sql('progress_dollars', 'double')} AS dollars",
        f"{typed_sql('progress_percentage', 'double')} AS percentage",
        f"{nvl_decimal_sql('progress_quantity')} AS quantity",
        f"{typed_sql('holdout', 'boolean')} AS holdout",
        f"'{META_DEFAULT}' AS meta",
        "CAST(0 AS decimal(1,1)) AS ranking",
        f"{typed_sql('potentially_eligible_in_future', 'boolean')} AS potentiallyeligibleinfuture",
        f"{typed_sql('audience', 'boolean')} AS audience",
        f"{typed_sql('progress_uses', 'decimal(38,0)')} AS uses",
        "CAST(bandit_status AS string) AS bandit_status",
        "CAST(experiment_status AS string) AS experiment_status",
    ]


def latest_per_key(flat: DataFrame, tiebreak: bool = False) -> DataFrame:
    """Keep the rows at the latest ``updated_ts`` of each key, all ties included,
    then collapse ties that differ only in ``uses`` to their largest ``uses``.

    Order of work, chosen so that old versions never cross the network and no key can
    pile up in one task:

    1. ``rank() = 1`` by ``updated`` over (user_id, offer_id, input task).  Its map-side
       ``WindowGroupLimit`` drops older versions before the shuffle, and the task in
       the key spreads a busy key over as many tasks as it came from.
    2. On that partitioning, copies collapse: one row for each distinct staged row
       (but ``uses``: MAX) and input task.
    3. ``rank() = 1`` over (user_id, offer_id), again limited map-side: a key's task
       receives at most its distinct latest rows from each input task.  The final
       MAX(uses) uses this partitioning, so there is no third shuffle.

    A row that is not the latest of its task is not the latest of its key, and ties
    that differ in more than ``uses`` stay separate rows, as staged.

    ``tiebreak=True`` (off by default) keeps one row per key instead: the
    largest in a fixed order of all columns, so re-runs pick the same row.
    """
    staged = flat.selectExpr(*typed_stage_columns())
    group_cols = [c for c in STAGE_COLS if c != "uses"]
    keys = ["user_id", "offer_id"]
    by_task = Window.partitionBy(*keys, "_task").orderBy(F.col("updated").desc())
    collapsed = (staged.withColumn("_task", F.spark_partition_id())
                 .withColumn("_rank", F.rank().over(by_task)).where(F.col("_rank") == 1)
                 .groupBy(*group_cols, "_task").agg(F.max("uses").alias("uses")))
    over_key = Window.partitionBy(*keys).orderBy(F.col("updated").desc())
    latest = (collapsed.withColumn("_rank", F.rank().over(over_key)).where(F.col("_rank") == 1)
              .groupBy(*group_cols).agg(F.max("uses").alias("uses")))
    if not tiebreak:
        return latest.select(*STAGE_COLS)
    order = [F.col(c).desc_nulls_last() for c in STAGE_COLS if c not in (*keys, "updated")]
    return (latest.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
            .where(F.col("_rank") == 1).select(*STAGE_COLS))
