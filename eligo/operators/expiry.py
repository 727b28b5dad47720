"""C11: expiry status of state rows from the offer dimension, and the split."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eligo.functions.time import date_plus_days
from eligo.operators.joins import DEFAULT_BROADCAST_BYTES, DEFAULT_ROWS_PER_TASK, lookup_join
from eligo.schemas import EXPIRY_ACTIVE, EXPIRY_EXPIRED, EXPIRY_GRACE_DAYS


def offer_end_times(offers: DataFrame, key: str = "offer_id",
                    end_col: str = "latest_end_time") -> DataFrame:
    """One row per offer (latest end time), so the lookup cannot fan out."""
    return offers.groupBy(key).agg(F.max(end_col).alias("_latest_end"))


def with_expiry_status(state: DataFrame, offers: DataFrame, as_of: date,
                       key: str = "offer_id", end_col: str = "latest_end_time",
                       grace_days: int = EXPIRY_GRACE_DAYS,
                       max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                       rows_per_task: int = DEFAULT_ROWS_PER_TASK) -> DataFrame:
    """``state`` plus ``expiry_status``: 'expired' when end date + ``grace_days``
    is before ``as_of``; 'active' otherwise, including offers missing from the
    dimension and offers without an end time.

    ``as_of`` is a parameter (not ``current_date()``) so a re-run repeats.
    The lookup broadcasts the dimension after measuring it; a larger dimension
    is joined by shuffle with hot offers salted.
    """
    dim = offer_end_times(offers, key, end_col)
    joined = lookup_join(state, dim, key, "left", max_broadcast_bytes, rows_per_task)
    expired = date_plus_days("_latest_end", grace_days) < F.lit(as_of.isoformat()).cast("date")
    status = F.when(expired, F.lit(EXPIRY_EXPIRED)).otherwise(F.lit(EXPIRY_ACTIVE))
    return joined.select(*state.columns, status.alias("expiry_status"))


def split_by_expiry(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(active, inactive); rows with a NULL status belong to neither, as in SQL."""
    return (df.where(F.col("expiry_status") != EXPIRY_EXPIRED),
            df.where(F.col("expiry_status") == EXPIRY_EXPIRED))
