"""A ledger of landed files: which files of the landing a raw table holds, and which hours got files later.

The landing's listing (path, size, modification time; no content is read) of a landed window is added to the ledger. A later listing
that is not in it names the hours to land again: hours are replaced whole, so running just those brings the late rows in.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eligo.schemas import PARTITION_COLS
from eligo.sources.landing import read_hours
from eligo.sources.tables import read_parquet_or_none

FILE_COLS = ["path", "length", "modified"]


def listed_files(spark: SparkSession, base: str, start: datetime, end: datetime) -> DataFrame | None:
    """``path, length, modified, year..hour`` of every file in the window's hours; ``None`` when none of its days exists."""
    files = read_hours(spark, base, start, end, "binaryFile")
    if files is None:
        return None
    return files.select("path", "length", F.unix_micros("modificationTime").alias("modified"), *PARTITION_COLS)


def record_files(files: DataFrame, ledger_path: str) -> None:
    """Add a listing to the ledger.  Take it before the window is landed: a file that arrives in between is then late, not lost."""
    files.select(*FILE_COLS).write.mode("append").parquet(ledger_path)


def late_files(spark: SparkSession, base: str, start: datetime, end: datetime, ledger_path: str) -> DataFrame | None:
    """The files of the window that the ledger does not have as they are: new, or written again."""
    files, known = listed_files(spark, base, start, end), read_parquet_or_none(spark, ledger_path)
    if files is None or known is None:
        return files
    return files.join(known.select(*FILE_COLS).dropDuplicates(), FILE_COLS, "left_anti")


def late_hours(spark: SparkSession, base: str, start: datetime, end: datetime, ledger_path: str) -> DataFrame | None:
    """``year, month, day, hour, n_files``: hours of the window with files the ledger does not have."""
    files = late_files(spark, base, start, end, ledger_path)
    return None if files is None else files.groupBy(*PARTITION_COLS).agg(F.count(F.lit(1)).alias("n_files"))


def windows(hours: DataFrame) -> list[tuple[datetime, datetime]]:
    """The hours of a (small) frame as windows, neighbouring hours together."""
    found = sorted(datetime(*r) for r in hours.select(*PARTITION_COLS).collect())
    out: list[tuple[datetime, datetime]] = []
    for h in found:
        if out and out[-1][1] == h:
            out[-1] = (out[-1][0], h + timedelta(hours=1))
        else:
            out.append((h, h + timedelta(hours=1)))
    return out
