"""Typing of landed text values.

Spark 4 runs with ANSI mode on, where a plain CAST of bad text fails the job.
Landed payloads are not trusted, so every cast here is a ``try_cast``: a value
that does not parse becomes NULL and the row survives.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_field(text, path: str) -> Column:
    """``get_json_object``: the value at ``path`` as text, NULL when absent."""
    return F.get_json_object(_col(text), path)


def typed_sql(name: str, type_name: str) -> str:
    """SQL text of ``typed`` for a column name (one JVM parse instead of a
    chain of Column calls, which matters when a projection has many)."""
    q = f"`{name}`"
    if type_name in ("int", "bigint", "smallint", "tinyint"):
        return f"try_cast(try_cast({q} AS decimal(38,0)) AS {type_name})"
    return f"try_cast({q} AS {type_name})"


def nvl_decimal_sql(name: str, default: int = 0) -> str:
    """SQL text of ``nvl_decimal`` for a column name."""
    q = f"`{name}`"
    return (f"CASE WHEN {q} IS NULL THEN CAST({int(default)} AS decimal(38,0)) "
            f"ELSE try_cast({q} AS decimal(38,0)) END")


def typed(c, type_name: str) -> Column:
    """Cast that yields NULL on bad input, under ANSI mode or not.

    Text to an integral type goes through decimal, so ``'12.5'`` rounds
    (half up) instead of failing the integral parse.
    """
    col = _col(c)
    if type_name in ("int", "bigint", "smallint", "tinyint"):
        return col.try_cast("decimal(38,0)").try_cast(type_name)
    return col.try_cast(type_name)


def nvl_decimal(c, default: int = 0) -> Column:
    """``NVL(x, default)`` then decimal(38,0): missing -> default, bad text -> NULL."""
    col = _col(c)
    return F.when(col.isNull(), F.lit(default).cast("decimal(38,0)")) \
        .otherwise(col.try_cast("decimal(38,0)"))
