"""Time conversions that give the same value under every session time zone.

Epoch numbers are turned into ``timestamp_ntz`` wall-clock values in UTC at
seconds grain: milliseconds are dropped (truncated toward zero, as the
integer cast of ``ms / 1000`` does), so two versions within one second tie.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
# 0001-01-01 00:00:00 and 9999-12-31 23:59:59.999 in epoch milliseconds.
MIN_EPOCH_MS, MAX_EPOCH_MS = -62_135_596_800_000, 253_402_300_799_999


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms_to_ts(ms) -> Column:
    """Epoch milliseconds (number or numeric text) -> timestamp_ntz, seconds grain.

    Text that is not a number, and a number outside the years 1 to 9999, give
    NULL instead of failing under ANSI mode.
    """
    ms_num = _col(ms).try_cast("double")
    in_range = F.when(ms_num.between(MIN_EPOCH_MS, MAX_EPOCH_MS), ms_num)
    whole_secs = (in_range / F.lit(1000)).try_cast("bigint")
    return F.expr(_EPOCH) + F.make_dt_interval(secs=whole_secs)


def ts_to_epoch_ms(ts) -> Column:
    """timestamp_ntz (read as UTC wall clock) -> epoch milliseconds (floor).

    Subtracting two ``timestamp_ntz`` values gives a day-time interval without
    consulting the session time zone (``timestampdiff`` would cast to a zoned
    timestamp first).
    """
    secs = (_col(ts) - F.expr(_EPOCH)).cast("interval second").cast("decimal(20,6)")
    return F.floor(secs * 1000).cast("bigint")


def utc_to_zone(ts, zone: str) -> Column:
    """UTC wall clock (timestamp_ntz) -> wall clock in ``zone`` (timestamp_ntz)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(ts))


def landing_hour_ts(year="year", month="month", day="day", hour="hour") -> Column:
    """Start of a landing hour from its partition values, as timestamp_ntz; NULL for an invalid date."""
    return F.try_make_timestamp_ntz(_col(year), _col(month), _col(day), _col(hour),
                                    F.lit(0), F.lit(0))


def date_plus_days(ts, days: int) -> Column:
    """Calendar date of ``ts`` plus ``days`` days."""
    return F.date_add(_col(ts).cast("date"), days)


# SQL-text forms of the same conversions, for projections with many columns
# (one JVM parse per expression instead of a chain of Column calls).

def epoch_ms_to_ts_sql(ms: str) -> str:
    num = f"try_cast({ms} AS double)"
    return (f"{_EPOCH} + make_dt_interval(0, 0, 0, try_cast("
            f"CASE WHEN {num} BETWEEN {MIN_EPOCH_MS} AND {MAX_EPOCH_MS} THEN {num} END / 1000 AS bigint))")


def utc_to_zone_sql(ts: str, zone: str) -> str:
    return f"convert_timezone('UTC', '{zone}', {ts})"
