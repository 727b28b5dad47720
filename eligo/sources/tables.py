"""Reading the versioned state: last batch id, one batch slice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def last_batch_value(df: DataFrame, col: str = "batch_id"):
    """MAX(``col``) as a Python value (``None`` when empty).

    One scalar to the driver; used as a literal, it lets the scan of a
    ``batch_id``-partitioned table prune to one partition.
    """
    return df.agg(F.max(col).alias("m")).first()["m"]


def batch_slice(df: DataFrame, batch_id, col: str = "batch_id") -> DataFrame:
    """Rows of one batch; an empty frame when there is no batch."""
    if batch_id is None:
        return df.limit(0)
    return df.where(F.col(col) == F.lit(batch_id))


def read_parquet_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:   # path does not exist yet
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise
