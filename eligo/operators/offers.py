"""Stage saved offers: per offer, its latest landing hour, MAX of each time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eligo.functions.casts import typed_sql
from eligo.functions.time import epoch_ms_to_ts_sql, landing_hour_ts, utc_to_zone_sql
from eligo.schemas import OFFER_TIME_ZONE, SAVED_OFFER_COLS


def stage_saved_offers(raw: DataFrame, zone: str = OFFER_TIME_ZONE) -> DataFrame:
    """Raw saved offers (``id, latestEndTime, startTime, endTime, year..hour``)
    -> one row per offer: the rows of its latest landing hour (rows with
    ``startTime + endTime > 0`` only; a NULL term drops the row), reduced by MAX.

    Epoch times become wall clock in ``zone`` before the MAX, as staged.

    Plan, built to hold when one offer owns a large share of the rows:
    1. group by (offer, landing hour) with partial aggregation, so each map task
       ships at most one row per offer and hour;
    2. ``dense_rank`` over the offer on those per-hour rows (at most one per hour
       of history) keeps the latest hour; the final group-by reuses that
       partitioning.
    """
    return latest_hour(offer_hours(raw, zone))


def restage_saved_offers(stage: DataFrame, window: DataFrame, zone: str = OFFER_TIME_ZONE) -> DataFrame:
    """The stage after one more window of raw rows: an offer's latest hour is the later of its
    staged hour and its latest hour in the window.  Equal to staging all of raw as long as no
    staged hour was replaced."""
    return latest_hour(stage.select(*SAVED_OFFER_COLS).unionByName(offer_hours(window, zone)))


def offer_hours(raw: DataFrame, zone: str = OFFER_TIME_ZONE) -> DataFrame:
    """One row per offer and landing hour with the MAX of each time; values may be text."""
    def number(c):   # text through decimal, so "10" and 10.0 count as 10
        return F.expr(typed_sql(c, "bigint"))
    kept = raw.where(F.try_add(number("startTime"), number("endTime")) > 0)

    def wall(c):
        return utc_to_zone_sql(epoch_ms_to_ts_sql(c), zone)
    conv = kept.selectExpr(
        "CAST(id AS string) AS offer_id",
        f"{wall('startTime')} AS start_time",
        f"{wall('endTime')} AS end_time",
        f"{wall('latestEndTime')} AS latest_end_time",
        "year", "month", "day", "hour",
    )
    return conv.groupBy("offer_id", "year", "month", "day", "hour").agg(
        F.max("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.max("latest_end_time").alias("latest_end_time"),
    )


def latest_hour(per_hour: DataFrame) -> DataFrame:
    """Per offer, the row of its latest landing hour."""
    w = Window.partitionBy("offer_id").orderBy(landing_hour_ts().desc())
    latest = per_hour.withColumn("_rank", F.dense_rank().over(w)).where(F.col("_rank") == 1)
    return (latest.groupBy("offer_id", "year", "month", "day")
            .agg(F.max("start_time").alias("start_time"),
                 F.max("end_time").alias("end_time"),
                 F.max("latest_end_time").alias("latest_end_time"),
                 F.max("hour").alias("hour"))
            .select(*SAVED_OFFER_COLS))
