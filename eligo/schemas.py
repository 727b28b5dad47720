"""Column layouts and table routing for the eligibility data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Output of the two flatteners (legacy / kafka), before typing: one row per
# (snapshot, offer).  Time columns are already timestamp_ntz at seconds grain.
FLAT_COLS = [
    "user_id", "updated_ts", "offer_id", "creation_time", "audience",
    "bandit_status", "experiment_status", "holdout", "invalidation_time",
    "start_time", "end_time", "potentially_eligible_in_future",
    "progress_type", "progress_uses", "progress_dollars",
    "progress_dollars_required", "progress_max_uses", "progress_percentage",
    "progress_quantity", "progress_quantity_required",
]

# Staged eligibility: latest version per (user_id, offer_id), typed.
STAGE_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("updated", T.TimestampNTZType()),
    T.StructField("offer_id", T.StringType()),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("creation_time", T.TimestampNTZType()),
    T.StructField("invalidation_time", T.TimestampNTZType()),
    T.StructField("dollars", T.DoubleType()),
    T.StructField("percentage", T.DoubleType()),
    T.StructField("quantity", T.DecimalType(38, 0)),
    T.StructField("holdout", T.BooleanType()),
    T.StructField("meta", T.StringType()),
    T.StructField("ranking", T.DecimalType(1, 1)),
    T.StructField("potentiallyeligibleinfuture", T.BooleanType()),
    T.StructField("audience", T.BooleanType()),
    T.StructField("uses", T.DecimalType(38, 0)),
    T.StructField("bandit_status", T.StringType()),
    T.StructField("experiment_status", T.StringType()),
])
STAGE_COLS = STAGE_SCHEMA.fieldNames()

# Current state: one full batch per batch_id, in this column order.
STATE_SCHEMA = T.StructType([
    STAGE_SCHEMA["user_id"],
    STAGE_SCHEMA["updated"],
    STAGE_SCHEMA["offer_id"],
    STAGE_SCHEMA["start_time"],
    STAGE_SCHEMA["end_time"],
    STAGE_SCHEMA["creation_time"],
    STAGE_SCHEMA["invalidation_time"],
    STAGE_SCHEMA["dollars"],
    STAGE_SCHEMA["percentage"],
    STAGE_SCHEMA["quantity"],
    STAGE_SCHEMA["holdout"],
    STAGE_SCHEMA["meta"],
    STAGE_SCHEMA["ranking"],
    STAGE_SCHEMA["potentiallyeligibleinfuture"],
    T.StructField("start_time_first_observed", T.TimestampNTZType()),
    T.StructField("start_time_recently_observed", T.TimestampNTZType()),
    STAGE_SCHEMA["audience"],
    T.StructField("percentage_recently_observed", T.DoubleType()),
    STAGE_SCHEMA["uses"],
    T.StructField("uses_recently_observed", T.DecimalType(38, 0)),
    STAGE_SCHEMA["bandit_status"],
    STAGE_SCHEMA["experiment_status"],
    T.StructField("expiry_status", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])
STATE_COLS = STATE_SCHEMA.fieldNames()
KEY_COLS = ["user_id", "offer_id"]

# Raw saved offers, as landed (plus landing hour) and as staged / merged.
SAVED_OFFER_RAW_COLS = ["id", "latestEndTime", "startTime", "endTime",
                        "year", "month", "day", "hour"]
SAVED_OFFER_SCHEMA = T.StructType([
    T.StructField("offer_id", T.StringType()),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("latest_end_time", T.TimestampNTZType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("hour", T.IntegerType()),
])
SAVED_OFFER_COLS = SAVED_OFFER_SCHEMA.fieldNames()

# Fixed values of the data model.
KAFKA_STATUS_PLACEHOLDER = "NULL"   # a string, not SQL NULL: kafka rows lack both statuses
META_DEFAULT = "NA"
EXPIRY_ACTIVE = "active"
EXPIRY_EXPIRED = "expired"
EXPIRY_GRACE_DAYS = 91
OFFER_TIME_ZONE = "America/Chicago"
KAFKA_PATH_MARKER = "kafka-stream"
PARTITION_COLS = ["year", "month", "day", "hour"]


# Table names, as users of the existing jobs know them.  The
# kafka origin appends "_kafka" to the eligibility tables; the saved-offer
# tables are shared by both origins.
ELIGIBILITY_TABLES = {
    "raw": "raw_offer_eligibility_snapshots",
    "stg": "stg_offer_eligibility_snapshots",
    "cs_active": "offer_eligibility_snapshots_current_state_active",
    "cs_inactive": "offer_eligibility_snapshots_current_state_inactive",
    "dump": "sf_offer_eligibility_cs_dump",
    "dump_with_expiry": "sf_offer_eligibility_cs_dump_w_expiry",
}
SAVED_OFFER_TABLES = {
    "raw_saved_offers": "raw_saved_offers",
    "stg_saved_offers": "stg_saved_offers",
    "saved_offers": "saved_offers",
}
KAFKA_SUFFIX = "_kafka"
# Our own additions: the publish logs that make a batch / version current.
BATCH_LOG_SUFFIX = "_batches"
FILE_LEDGER_SUFFIX = "_files"
OFFER_BUCKET = "offer_bucket"


@dataclass(frozen=True)
class Tables:
    """Table locations for one origin; each name is a directory under ``root``.

    With a ``database`` the versioned tables are catalog tables over the same directories, in ``buckets`` buckets
    by their key if that is given.
    """

    root: str
    origin: str = "legacy"
    database: str | None = None
    buckets: int = 0
    offer_buckets: int = 0   # directories by a hash of the offer below a state batch (not in a database)

    @classmethod
    def for_raw_path(cls, root: str, raw_path: str, database: str | None = None, buckets: int = 0) -> "Tables":
        return cls(root, "kafka" if KAFKA_PATH_MARKER in raw_path else "legacy", database, buckets)

    def _path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _elig(self, key: str) -> str:
        suffix = KAFKA_SUFFIX if self.origin == "kafka" else ""
        return self._path(ELIGIBILITY_TABLES[key] + suffix)

    raw = property(lambda self: self._elig("raw"))
    stg = property(lambda self: self._elig("stg"))
    cs_active = property(lambda self: self._elig("cs_active"))
    cs_inactive = property(lambda self: self._elig("cs_inactive"))
    dump = property(lambda self: self._elig("dump"))
    dump_with_expiry = property(lambda self: self._elig("dump_with_expiry"))
    batch_log = property(lambda self: self._elig("cs_active") + BATCH_LOG_SUFFIX)
    raw_files = property(lambda self: self._elig("raw") + FILE_LEDGER_SUFFIX)
    raw_saved_offers = property(lambda self: self._path(SAVED_OFFER_TABLES["raw_saved_offers"]))
    stg_saved_offers = property(lambda self: self._path(SAVED_OFFER_TABLES["stg_saved_offers"]))
    saved_offers = property(lambda self: self._path(SAVED_OFFER_TABLES["saved_offers"]))
    saved_offers_log = property(
        lambda self: self._path(SAVED_OFFER_TABLES["saved_offers"]) + BATCH_LOG_SUFFIX)
