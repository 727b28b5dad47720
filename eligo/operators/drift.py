"""Schema drift of landed lines (S02, P04): which fields came, of which type, on how many lines.

Nothing is inferred from a sample and no schema is assumed: every level of the landed VARIANTs is opened, all
fields and all elements, so a field that one line in a billion has is in the report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eligo.session import materialize


def json_type(data: Column) -> Column:
    """``object``, ``array``, ``string``, ``boolean``, ``null`` or ``number`` of a VARIANT."""
    name = F.schema_of_variant(data)
    return (F.when(name.startswith("OBJECT"), "object").when(name.startswith("ARRAY"), "array")
            .when(name == "STRING", "string").when(name == "BOOLEAN", "boolean").when(name == "VOID", "null")
            .when(name.isNotNull(), "number"))


def field_types(landed: DataFrame, data: str = "data") -> DataFrame:
    """``(path, type, n_lines)`` over the VARIANTs of ``landed``; rows without one (corrupt lines) count nowhere.

    Paths are spelled ``$.offers[*].offer_id``: elements of an array share one path.  ``n_lines`` counts lines, however
    often a path is on a line.  Levels are opened one after the other (as many as the deepest line has), each written once; a line
    is never gathered in one place, and all but the distinct (line, path, type) of a level is gone before its shuffle.
    """
    spark = landed.sparkSession
    level = landed.where(F.col(data).isNotNull()).select(
        F.monotonically_increasing_id().alias("line"), F.lit("$").alias("path"), F.col(data).alias("v"))
    found = None
    while True:
        level = materialize(level.withColumn("type", json_type(F.col("v"))), "drift-level")
        seen = level.groupBy("path", "type", "line").agg(F.lit(1)).groupBy("path", "type").agg(F.count("*").alias("n_lines"))
        found = seen if found is None else found.unionByName(seen)
        nested = level.where(F.col("type").isin("object", "array"))
        if nested.limit(1).count() == 0:
            return found
        opened = nested.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        level = opened.select("line", F.when(F.col("type") == "array", F.concat("path", F.lit("[*]")))
                              .otherwise(F.concat("path", F.lit("."), "key")).alias("path"), F.col("value").alias("v"))


def schema_paths(dtype: T.DataType, path: str = "$") -> list[str]:
    """Every path of a schema, spelled as ``field_types`` spells them."""
    if isinstance(dtype, T.StructType):
        return [path, *(p for f in dtype.fields for p in schema_paths(f.dataType, f"{path}.{f.name}"))]
    if isinstance(dtype, T.ArrayType):
        return [path, *schema_paths(dtype.elementType, f"{path}[*]")]
    return [path]


def drift(landed: DataFrame, schema: T.StructType, data: str = "data") -> DataFrame:
    """``field_types`` plus ``known``: whether the feed's schema names the path.  Unknown ones stay in raw, field and all,
    and are read from there (``try_variant_get``) once a schema names them."""
    return field_types(landed, data).withColumn("known", F.col("path").isin(*schema_paths(schema)))
