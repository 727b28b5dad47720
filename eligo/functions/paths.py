"""Landing-path helpers: partition values and the hour window predicate."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# How each partition value is written in a landing path.
PATH_PART_PATTERNS = {
    "year": r"year=(\d{4})",
    "month": r"month=(\d{2})",
    "day": r"day=(\d{2})",
    "hour": r"hour=(\d{2})",
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def path_part(path, part: str) -> Column:
    """Integer partition value parsed from a file path; NULL when the segment is absent."""
    extracted = F.regexp_extract(_col(path), PATH_PART_PATTERNS[part], 1)
    return F.nullif(extracted, F.lit("")).try_cast("int")


def path_parts(path) -> dict[str, Column]:
    return {p: path_part(path, p) for p in PATH_PART_PATTERNS}


def hour_window(start: datetime, end: datetime) -> Column:
    """Half-open landing window ``start <= hour < end`` over year/month/day/hour.

    The predicate compares hour numbers (``yyyymmddhh``), so an invalid date in a
    directory name is outside or inside like any number and never an error.
    It reads partition columns only, so on a partitioned landing it
    is applied as a partition filter: only the hours inside the window are listed
    and read, across midnight, month and year ends, and a missing hour is simply
    empty instead of an error.
    """
    if not start < end:
        raise ValueError(f"empty window: start {start} is not before end {end}")
    year, month, day, hour = (F.col(c).cast("bigint") for c in PATH_PART_PATTERNS)
    number = year * 1_000_000 + month * 10_000 + day * 100 + hour
    return (number >= int(start.strftime("%Y%m%d%H"))) & (number < int(end.strftime("%Y%m%d%H")))
