"""Flatten the two landed snapshot formats into one row per (snapshot, offer).

JSON text is parsed once, into a VARIANT; the fields of all levels come out of it in one struct.  (Fields taken
one by one cost a walk each; fields taken off one ``from_json`` are split by the optimizer into a parse each.)

Both return ``schemas.FLAT_COLS``.  Time columns become timestamp_ntz at
seconds grain; everything else keeps the landed type and is typed later by
``latest.latest_per_key``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eligo.functions.time import epoch_ms_to_ts_sql as _ts
from eligo.schemas import FLAT_COLS, KAFKA_STATUS_PLACEHOLDER
from eligo.sources.landing import fields

_S = T.StringType()

# Legacy payload: every field is read as text, as a map<string,string> would.
LEGACY_OFFER_FIELDS = [
    "offerId", "creationTime", "audience", "banditStatus", "experimentStatus",
    "holdout", "invalidationTime", "startTime", "endTime",
    "potentiallyEligibleInFuture", "progress",
]
LEGACY_PROGRESS_FIELDS = [
    "type", "uses", "dollars", "dollarsRequired", "maxUses", "percentage",
    "quantity", "quantityRequired",
]
LEGACY_PROGRESS = T.StructType([T.StructField(n, _S) for n in LEGACY_PROGRESS_FIELDS])
# ``progress`` stays a VARIANT: it is an object, or an object's JSON text.
LEGACY_PAYLOAD = T.StructType([
    T.StructField("userId", _S), T.StructField("updated", _S),
    T.StructField("offers", T.ArrayType(T.StructType([
        T.StructField(n, T.VariantType() if n == "progress" else _S) for n in LEGACY_OFFER_FIELDS]))),
])

# Kafka snapshots as typed frames; landed JSON is read with the same names as text.
KAFKA_PROGRESS = T.StructType([
    T.StructField("type", _S),
    T.StructField("uses", T.LongType()),
    T.StructField("dollars", T.DoubleType()),
    T.StructField("dollars_required", T.DoubleType()),
    T.StructField("max_uses", T.LongType()),
    T.StructField("percentage", T.DoubleType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("quantity_required", T.LongType()),
])
KAFKA_OFFER = T.StructType([
    T.StructField("offer_id", _S),
    T.StructField("creation_timestamp_ms", T.LongType()),
    T.StructField("invalidation_timestamp_ms", T.LongType()),
    T.StructField("start_timestamp_ms", T.LongType()),
    T.StructField("end_timestamp_ms", T.LongType()),
    T.StructField("audience", T.BooleanType()),
    T.StructField("holdout", T.BooleanType()),
    T.StructField("potentially_eligible_in_future", T.BooleanType()),
    T.StructField("progress", KAFKA_PROGRESS),
])
KAFKA_SCHEMA = T.StructType([
    T.StructField("user_id", _S),
    T.StructField("updated_timestamp_ms", T.LongType()),
    T.StructField("offers", T.ArrayType(KAFKA_OFFER)),
])
LEGACY_SCHEMA = T.StructType([T.StructField("payload", _S)])


def as_text(dtype: T.DataType) -> T.DataType:
    """The same nesting with every scalar as text: a landed ``12.5`` or ``"10"`` then reaches the
    ``try_cast`` of staging instead of failing a typed JSON parse."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, as_text(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(as_text(dtype.elementType))
    return _S


KAFKA_TEXT = as_text(KAFKA_SCHEMA)


def landed_fields(landed: DataFrame, origin: str) -> DataFrame:
    """Landed lines (``data``, ``corrupt``) -> the feed's columns: scalars as text, the legacy payload as VARIANT.  Corrupt
    lines stay behind in raw, where the job counts them."""
    lines = landed.where(~F.col("corrupt"))
    if origin == "legacy":
        return lines.select(F.try_parse_json(F.try_variant_get("data", "$.payload", "string")).alias("payload"))
    return lines.select(fields("data", KAFKA_TEXT).alias("f")).select("f.*")


def legacy(df: DataFrame) -> DataFrame:
    """``payload`` (JSON text or VARIANT) -> FLAT_COLS.

    ``offers`` must be a JSON array: a missing, NULL, empty, malformed or
    non-array value yields no row for that snapshot.
    """
    if isinstance(df.schema["payload"].dataType, T.VariantType):
        parsed = df.select(fields("payload", LEGACY_PAYLOAD).alias("e"))
    else:
        parsed = df.select(F.try_parse_json("payload").alias("payload")).select(fields("payload", LEGACY_PAYLOAD).alias("e"))
    # ``explode`` would make the optimizer infer ``size(offers) > 0`` and push it
    # below, evaluating the parse once more per row; ``posexplode_outer`` then
    # dropping its NULL position keeps the same rows (none for a NULL or empty
    # array) with a single parse.
    exploded = (parsed.select(F.col("e.userId").alias("user_id"), F.col("e.updated").alias("updated_ms"),
                              F.posexplode_outer("e.offers").alias("pos", "o"))
                .where(F.col("pos").isNotNull()).drop("pos"))
    text = F.try_variant_get("o.progress", "$", "string")
    exploded = exploded.select("*", F.coalesce(
        fields("o.progress", LEGACY_PROGRESS),
        F.try_variant_get(F.try_parse_json(text), "$", LEGACY_PROGRESS.simpleString())).alias("p"))
    return exploded.selectExpr(
        "user_id",
        f"{_ts('updated_ms')} AS updated_ts",
        "o.offerId AS offer_id",
        f"{_ts('o.creationTime')} AS creation_time",
        "o.audience AS audience",
        "o.banditStatus AS bandit_status",
        "o.experimentStatus AS experiment_status",
        "o.holdout AS holdout",
        f"{_ts('o.invalidationTime')} AS invalidation_time",
        f"{_ts('o.startTime')} AS start_time",
        f"{_ts('o.endTime')} AS end_time",
        "o.potentiallyEligibleInFuture AS potentially_eligible_in_future",
        "p.type AS progress_type",
        "p.uses AS progress_uses",
        "p.dollars AS progress_dollars",
        "p.dollarsRequired AS progress_dollars_required",
        "p.maxUses AS progress_max_uses",
        "p.percentage AS progress_percentage",
        "p.quantity AS progress_quantity",
        "p.quantityRequired AS progress_quantity_required",
    )


def kafka(df: DataFrame) -> DataFrame:
    """Kafka snapshot (``user_id, updated_timestamp_ms, offers``; typed or text) -> FLAT_COLS.

    Kafka rows carry no bandit or experiment status; both are the text
    ``'NULL'`` so the two origins share one layout.
    """
    # As in ``legacy``: no inferred ``size(offers) > 0`` filter that would
    # evaluate ``offers`` a second time when it is an expression.
    exploded = (df.select(
        F.col("user_id"),
        F.col("updated_timestamp_ms").alias("updated_ms"),
        F.posexplode_outer("offers").alias("pos", "o"),
    ).where(F.col("pos").isNotNull()).drop("pos"))
    return exploded.selectExpr(
        "user_id",
        f"{_ts('updated_ms')} AS updated_ts",
        "o.offer_id AS offer_id",
        f"{_ts('o.creation_timestamp_ms')} AS creation_time",
        "o.audience AS audience",
        f"'{KAFKA_STATUS_PLACEHOLDER}' AS bandit_status",
        f"'{KAFKA_STATUS_PLACEHOLDER}' AS experiment_status",
        "o.holdout AS holdout",
        f"{_ts('o.invalidation_timestamp_ms')} AS invalidation_time",
        f"{_ts('o.start_timestamp_ms')} AS start_time",
        f"{_ts('o.end_timestamp_ms')} AS end_time",
        "o.potentially_eligible_in_future AS potentially_eligible_in_future",
        "o.progress.type AS progress_type",
        "o.progress.uses AS progress_uses",
        "o.progress.dollars AS progress_dollars",
        "o.progress.dollars_required AS progress_dollars_required",
        "o.progress.max_uses AS progress_max_uses",
        "o.progress.percentage AS progress_percentage",
        "o.progress.quantity AS progress_quantity",
        "o.progress.quantity_required AS progress_quantity_required",
    )


def by_origin(df: DataFrame, origin: str) -> DataFrame:
    if origin == "legacy":
        out = legacy(df)
    elif origin == "kafka":
        out = kafka(df)
    else:
        raise ValueError(f"unknown origin {origin!r}")
    assert out.columns == FLAT_COLS
    return out
