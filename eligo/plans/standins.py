"""Map the shared test tables onto the eligibility feed.

The test tables carry no offer snapshots, so each query derives them:

* ``events`` -> snapshot rows: ``user_id``, offer = ``props.k`` (0..99),
  version time = the event's day (day grain makes ties), ``pef`` = signup,
  ``percentage`` NULL for errors, ``uses`` = floor(value).  Every other column
  is a function of (user, offer, day), so tied rows differ only where the
  staging rules care.
* ``events`` -> raw saved offers: id = user_id * 1000 + k, start = ts,
  landing hour = hour of ts.
* ``part`` + ``lineitem`` -> state rows and an offer dimension for expiry.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eligo.functions.time import ts_to_epoch_ms
from eligo.schemas import FLAT_COLS, KAFKA_STATUS_PLACEHOLDER

# Fixed values of the stand-in mapping (the oracle SQL uses the same ones).
CUT = "2024-01-16 00:00:00"          # history before, increment from
HIST_BATCH_ID = 1
NEXT_BATCH_ID = 2
DAY_MS = 86_400_000
END_OFFSET_MS = 30 * DAY_MS
WINDOW_START = "2024-01-15 20"
WINDOW_END = "2024-01-16 03"
EXPIRY_AS_OF = "2001-08-01"
INIT_AS_OF = "2024-06-01"
PATH_ROOT = "s3://landing/offers/"


def data_span(events: DataFrame) -> tuple[datetime, datetime]:
    """Whole days from the first event to past the last; the job queries land it in two windows."""
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    day = {"hour": 0, "minute": 0, "second": 0, "microsecond": 0}
    cut = datetime.strptime(CUT, "%Y-%m-%d %H:%M:%S")
    return (min(first.replace(**day), cut - timedelta(days=1)),
            max(last.replace(**day), cut) + timedelta(days=1))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def offer_k(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k")


def event_day(ts: str = "ts") -> Column:
    return F.col(ts).cast("date").cast("timestamp_ntz")


def snapshot_flat(events: DataFrame) -> DataFrame:
    """events -> FLAT_COLS (kafka-typed values), one row per event."""
    k = "CAST(get_json_object(props, '$.k') AS int)"
    day = "CAST(CAST(ts AS date) AS timestamp_ntz)"
    return events.selectExpr(
        "CAST(user_id AS string) AS user_id",
        f"{day} AS updated_ts",
        "get_json_object(props, '$.k') AS offer_id",
        f"{day} AS creation_time",
        "user_id % 3 != 0 AS audience",
        f"CASE WHEN {k} % 2 = 0 THEN 'explore' ELSE 'exploit' END AS bandit_status",
        f"'{KAFKA_STATUS_PLACEHOLDER}' AS experiment_status",
        f"{k} % 10 = 0 AS holdout",
        "CAST(NULL AS timestamp_ntz) AS invalidation_time",
        f"{day} AS start_time",
        f"{day} + INTERVAL 30 DAYS AS end_time",
        "event_type = 'signup' AS potentially_eligible_in_future",
        "'uses' AS progress_type",
        "CAST(floor(value) AS bigint) AS progress_uses",
        f"CAST({k} AS double) AS progress_dollars",
        "CAST(100.0 AS double) AS progress_dollars_required",
        "CAST(10 AS bigint) AS progress_max_uses",
        "CASE WHEN event_type = 'error' THEN CAST(NULL AS double) ELSE 0.5 END AS progress_percentage",
        f"CAST(CASE WHEN {k} % 4 = 0 THEN NULL ELSE {k} % 7 END AS bigint) AS progress_quantity",
        "CAST(7 AS bigint) AS progress_quantity_required",
    ).select(*FLAT_COLS)


def split_history(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    cut = F.lit(CUT).cast("timestamp_ntz")
    return flat.where(F.col("updated_ts") < cut), flat.where(F.col("updated_ts") >= cut)


def with_landing_parts(events: DataFrame) -> DataFrame:
    return events.withColumns({
        "year": F.year("ts"), "month": F.month("ts"),
        "day": F.dayofmonth("ts"), "hour": F.hour("ts"),
    })


def by_landing_hour(events: DataFrame) -> DataFrame:
    """``events`` dealt out by landing hour, so that one task writes an hour's one file.  The lines are made after this
    shuffle: the events' few columns cross it, not their JSON, and all tasks make lines, however few splits the table has."""
    return events.repartition(F.year("ts"), F.month("ts"), F.dayofmonth("ts"), F.hour("ts"))


def landing_path(events: DataFrame) -> Column:
    """A landing file path per event; error events lack the hour segment."""
    def two(c):
        return F.lpad(F.col(c).cast("string"), 2, "0")
    hour_seg = F.when(F.col("event_type") == "error", F.lit("")) \
        .otherwise(F.concat(F.lit("/hour="), two("hour")))
    return F.concat(F.lit(PATH_ROOT), F.lit("year="), F.col("year").cast("string"),
                    F.lit("/month="), two("month"), F.lit("/day="), two("day"),
                    hour_seg, F.lit("/part-"), F.col("event_id").cast("string"), F.lit(".json"))


def raw_saved_offers(events: DataFrame) -> DataFrame:
    """events -> raw saved offers (``id, latestEndTime, startTime, endTime, year..hour``)."""
    ms = ts_to_epoch_ms("ts")
    ev = with_landing_parts(events)
    return ev.select(
        (F.col("user_id") * 1000 + offer_k().cast("bigint")).cast("string").alias("id"),
        (ms + F.floor("value").cast("bigint") * DAY_MS).alias("latestEndTime"),
        ms.alias("startTime"),
        (ms + END_OFFSET_MS).alias("endTime"),
        "year", "month", "day", "hour",
    )


def legacy_payloads(events: DataFrame) -> DataFrame:
    """events -> legacy landing rows: one ``payload`` JSON text per event with
    two offers (k and (k + 1) mod 100)."""
    ms = ts_to_epoch_ms("ts")
    k = offer_k().cast("int")

    def offer(kc: Column) -> Column:
        return F.struct(
            kc.cast("string").alias("offerId"),
            (ms - DAY_MS).alias("creationTime"),
            (F.col("user_id") % 3 != 0).alias("audience"),
            F.when(kc % 2 == 0, "explore").otherwise("exploit").alias("banditStatus"),
            F.col("event_type").alias("experimentStatus"),
            (kc % 10 == 0).alias("holdout"),
            ms.alias("startTime"),
            (ms + END_OFFSET_MS).alias("endTime"),
            (F.col("event_type") == "signup").alias("potentiallyEligibleInFuture"),
            F.struct(
                F.lit("uses").alias("type"),
                F.floor("value").cast("bigint").alias("uses"),
                F.col("value").cast("decimal(10,2)").cast("string").alias("dollars"),
                F.lit(100).alias("dollarsRequired"),
                F.lit(10).alias("maxUses"),
                F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
                 .otherwise(F.lit(0.5)).alias("percentage"),
                F.when(kc % 4 == 0, F.lit(None).cast("int")).otherwise(kc % 7).alias("quantity"),
                F.lit(7).alias("quantityRequired"),
            ).alias("progress"),
        )

    payload = F.to_json(F.struct(
        F.col("user_id").cast("string").alias("userId"),
        ms.cast("string").alias("updated"),
        F.array(offer(k), offer((k + 1) % 100)).alias("offers"),
    ))
    return events.select(payload.alias("payload"), *_landing_hour_text())


def _landing_hour_text() -> list:
    """Landing partition values of ``ts`` as the paths spell them (``month=01``)."""
    return [F.year("ts").cast("string").alias("year"),
            F.lpad(F.month("ts").cast("string"), 2, "0").alias("month"),
            F.lpad(F.dayofmonth("ts").cast("string"), 2, "0").alias("day"),
            F.lpad(F.hour("ts").cast("string"), 2, "0").alias("hour")]


def kafka_snapshots(events: DataFrame) -> DataFrame:
    """events -> typed kafka landing rows, two offers per event."""
    return events.select(*_kafka_columns())


def _kafka_columns() -> list[Column]:
    ms = ts_to_epoch_ms("ts")
    k = offer_k().cast("int")

    def offer(kc: Column) -> Column:
        return F.struct(
            kc.cast("string").alias("offer_id"),
            (ms - DAY_MS).alias("creation_timestamp_ms"),
            F.lit(None).cast("bigint").alias("invalidation_timestamp_ms"),
            ms.alias("start_timestamp_ms"),
            (ms + END_OFFSET_MS).alias("end_timestamp_ms"),
            (F.col("user_id") % 3 != 0).alias("audience"),
            (kc % 10 == 0).alias("holdout"),
            (F.col("event_type") == "signup").alias("potentially_eligible_in_future"),
            F.struct(
                F.lit("uses").alias("type"),
                F.floor("value").cast("bigint").alias("uses"),
                F.col("value").alias("dollars"),
                F.lit(100.0).alias("dollars_required"),
                F.lit(10).cast("bigint").alias("max_uses"),
                F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
                 .otherwise(F.lit(0.5)).alias("percentage"),
                F.when(kc % 4 == 0, F.lit(None).cast("bigint"))
                 .otherwise((kc % 7).cast("bigint")).alias("quantity"),
                F.lit(7).cast("bigint").alias("quantity_required"),
            ).alias("progress"),
        )

    return [
        F.col("user_id").cast("string").alias("user_id"),
        ms.alias("updated_timestamp_ms"),
        F.array(offer(k), offer((k + 1) % 100)).alias("offers"),
    ]


def kafka_landing(events: DataFrame) -> DataFrame:
    """events -> kafka landing lines (``value``) as an untidy feed sends them: quantities with a
    decimal (k mod 7 and a half), epochs as text for views, a field no schema names, and for every
    error event a second line that breaks off."""
    typed = events.select("event_type", *_landing_hour_text(), F.struct(*_kafka_columns()).alias("s"))
    halves = F.transform("s.offers", lambda o: o.withField(
        "progress", o["progress"].withField("quantity", o["progress"]["quantity"] + F.lit(0.5))))

    def line(updated):
        return F.to_json(F.struct(F.col("s.user_id").alias("user_id"), updated.alias("updated_timestamp_ms"),
                                  halves.alias("offers"), F.lit("h1").alias("source_host")))
    ms = F.col("s.updated_timestamp_ms")
    whole = F.when(F.col("event_type") == "view", line(ms.cast("string"))).otherwise(line(ms))
    lines = F.when(F.col("event_type") == "error", F.array(whole, F.substring(whole, 1, 40))).otherwise(F.array(whole))
    return typed.select(F.explode(lines).alias("value"), "year", "month", "day", "hour")


def saved_offer_landing(events: DataFrame) -> DataFrame:
    """events -> saved-offer landing rows as the JSON feed carries them, with
    zero-padded text partition values (``month=01``) like the landing paths."""
    raw = raw_saved_offers(events)
    return raw.selectExpr(
        "id", "startTime", "endTime",
        "named_struct('latestEndTime', latestEndTime) AS eligibilityRequirement",
        "CAST(year AS string) AS year",
        "lpad(CAST(month AS string), 2, '0') AS month",
        "lpad(CAST(day AS string), 2, '0') AS day",
        "lpad(CAST(hour AS string), 2, '0') AS hour",
    )
