"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eligo.session import materialize, scratch_path

__all__ = ["is_empty", "materialize", "pick", "read_table", "scratch_path",
           "slices", "type_of", "worker_state"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, under the operator's own names.

    Every operator starts here, so extra columns of the input can neither
    clash with its working columns nor reach a shuffle.
    """
    return df.select(*[df[f"`{src}`"].alias(name) for name, src in cols.items()])


def type_of(df: DataFrame, col: str) -> str:
    return df.schema[col].dataType.simpleString()


def is_empty(df: DataFrame) -> bool:
    return df.limit(1).count() == 0


def content_key(text: Column) -> list[Column]:
    """128 bits that name a text in joins that never compare texts of equal keys."""
    b = F.coalesce(text.cast("binary"), F.lit(b""))
    return [F.xxhash64(b), F.xxhash64(F.lit(17), b)]


def worker_state(name: str, make):
    """An object of this Python worker process, kept from task to task (workers are reused)."""
    state = sys.modules.setdefault("_eligo_worker_state", types.ModuleType("_eligo_worker_state"))
    if not hasattr(state, name):
        setattr(state, name, make())
    return getattr(state, name)


def slices(batches, rows: int = 256):
    """Arrow batches cut small (no copy), so that what Python makes of one stays small beside it."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
