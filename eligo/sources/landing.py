"""C01 sources: read one half-open hour window of a partitioned JSON landing.

Layout: ``<base>/year=YYYY/month=MM/day=DD/hour=HH/*.json``.  Only the
window's days are listed, and the window is a predicate on the discovered
partition columns, so only the hours inside the window are read; hours that
are missing are simply empty.  Lines are read as text and kept whole, so no field
is cut and no broken line is lost; nothing is inferred (an extra pass over the JSON).  Each line is
parsed once, into a VARIANT that holds all its fields, named by a schema or not; everything after reads that.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from eligo.functions.paths import hour_window
from eligo.schemas import PARTITION_COLS

# The saved-offer feed's columns, as text: staging types them.
SAVED_OFFER_LANDING_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("startTime", T.StringType()),
    T.StructField("endTime", T.StringType()),
    T.StructField("eligibilityRequirement", T.StructType([
        T.StructField("latestEndTime", T.StringType()),
    ])),
])


def parsed(line: str = "line") -> Column:
    """A landed line as VARIANT, or NULL where it is no JSON object (broken, or an array, a number, ...).

    An object that repeats a key is broken as well, unless the session sets ``spark.sql.variant.allowDuplicateKeys`` (the jobs
    do; the last one counts, as in Spark's JSON reader).
    """
    return F.when(F.ltrim(line, F.lit(" \t\r")).startswith("{"), F.try_parse_json(line))


def fields(data: str, schema: T.StructType) -> Column:
    """The schema's fields of a VARIANT as one struct; a field that is missing or does not fit is NULL."""
    return F.try_variant_get(F.col(data), "$", schema.simpleString())


def window_days(start: datetime, end: datetime) -> list[str]:
    """Directory paths (``year=YYYY/month=MM/day=DD``) of every day the window
    ``[start, end)`` touches, in both spellings of month and day: zero-padded as
    in the landing, and plain as Spark writes integer partition values.  The
    alternatives are distinct, so no directory can match twice."""
    first = start.replace(hour=0, minute=0, second=0, microsecond=0)
    last = (end - timedelta(hours=1)).replace(hour=0, minute=0, second=0, microsecond=0)
    days, d = [], first
    while d <= last:
        for m in dict.fromkeys([f"{d.month:02d}", str(d.month)]):
            for dd in dict.fromkeys([f"{d.day:02d}", str(d.day)]):
                days.append(f"year={d:%Y}/month={m}/day={dd}")
        d += timedelta(days=1)
    return days


def read_window(spark: SparkSession, base: str, start: datetime, end: datetime,
                schema: T.StructType | None = None) -> DataFrame:
    """Everything landed in hours ``start <= hour < end``: one row per line, with ``line`` (the
    text as landed), ``data`` (the same as VARIANT, unknown fields included; NULL for a corrupt line),
    ``corrupt``, ``file_path`` and year..hour.  With a ``schema`` its columns come first (NULL for a corrupt line).
    Blank lines are no rows.

    Only the window's day directories are listed (one glob with an alternative
    per day), so the cost of listing does not grow with the landing's history;
    the hour predicate then prunes to the window's hours.  Missing hours or
    days are simply empty; a window with no data at all gives an empty frame.
    Windows of any length are read this way, so other directories beside the
    landing's years never matter.
    """
    df = read_hours(spark, base, start, end, "text")
    if df is None:
        parts = [T.StructField(c, T.IntegerType()) for c in PARTITION_COLS]
        df = spark.createDataFrame([], T.StructType([T.StructField("value", T.StringType()), *parts]))
        file_path = F.lit(None).cast("string")
    else:
        file_path = F.col("_metadata.file_path")
    lines = (df.where(F.trim("value") != "")
             .select(F.col("value").alias("line"), parsed("value").alias("data"), file_path.alias("file_path"), *PARTITION_COLS)
             .select("line", "data", F.col("data").isNull().alias("corrupt"), "file_path", *PARTITION_COLS))
    if schema is None:
        return lines
    return lines.withColumn("_f", fields("data", schema)).select("_f.*", *lines.columns)


def read_hours(spark: SparkSession, base: str, start: datetime, end: datetime,
               fmt: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The hour partitions ``[start, end)`` of a year/month/day/hour table in
    ``fmt``; ``None`` when none of the window's days exists."""
    base = base.rstrip("/")
    path = f"{base}/{{{','.join(window_days(start, end))}}}/hour=*"
    reader = spark.read.format(fmt).option("basePath", base)
    try:
        df = reader.load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        return None
    return df.where(hour_window(start, end))
