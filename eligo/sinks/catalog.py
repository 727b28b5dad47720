"""Versioned tables in Spark's catalog, bucketed by their key.

A table is partitioned by ``batch_id`` and, with ``buckets``, bucketed and sorted by its key: rows of a key are
in the bucket its hash names, in every version.  A join on the key then reads the table as it lies: only the small side is
shuffled, into as many partitions as there are buckets (MERGE, carry-forward).

The folders are those of the path-based tables (``<path>/batch_id=N``), so both ways of reading see the same rows, and a
version still becomes current by its row in the batch log.  A session's in-process catalog forgets its tables; creating
one again over its folder and adding the logged versions is what ``attach`` does.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eligo.operators.joins import bucketed_anti_join
from eligo.operators.merge import merge_upsert
from eligo.sinks import write

VERSION = "batch_id"
_BUCKET_FILE = re.compile(r"_(\d{5})(?:\.c\d+)?\.[^/]*$")


@dataclass(frozen=True)
class VersionedTable:
    """``name`` (``database.table``) over ``path``; ``columns`` without the version, in the table's order."""

    spark: SparkSession
    name: str
    path: str
    columns: T.StructType
    keys: tuple[str, ...] = ()
    buckets: int = 0

    def create(self) -> "VersionedTable":
        """``CREATE TABLE IF NOT EXISTS`` over the folder; an existing table must have the same buckets."""
        database = self.name.rpartition(".")[0]
        if database:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        schema = T.StructType([*self.columns.fields, T.StructField(VERSION, T.LongType())])
        write.create_table(self.spark, self.name, schema, [VERSION], self.path, self.keys, self.buckets)
        has = {r["col_name"]: r["data_type"] for r in self.spark.sql(f"DESCRIBE EXTENDED {self.name}").collect()}
        buckets = int(has.get("Num Buckets", 0))
        if buckets != self.buckets:
            raise ValueError(f"{self.name} has {buckets} buckets, not {self.buckets}: copy it into a new table to change them")
        return self

    def attach(self, versions) -> "VersionedTable":
        """The table with these versions known to the catalog; every file of theirs has to be in a bucket."""
        self.create()
        versions = sorted(set(versions))
        write.add_partitions(self.spark, self.name, [{VERSION: v} for v in versions])
        self.spark.catalog.refreshTable(self.name)
        if self.buckets:
            for v in versions:   # names only; one file for each bucket
                names = self.spark.read.schema(self.columns).parquet(f"{self.path.rstrip('/')}/{VERSION}={v}").inputFiles()
                found = [_BUCKET_FILE.search(n) for n in names]
                if not all(m and int(m[1]) < self.buckets for m in found):
                    raise ValueError(f"version {v} of {self.name} was not written in {self.buckets} buckets")
        return self

    def write(self, rows: DataFrame, version: int, watch=None, dealt: bool = False) -> None:
        """Replace one version (``INSERT INTO ... PARTITION`` of an emptied one, columns by position); all others stay,
        and ``rows`` may read them (which ``INSERT OVERWRITE`` of the table would refuse).

        Bucketed rows are dealt out by key first, so a bucket is one file, unless they are ``dealt`` out already, as
        ``merged`` and ``untouched`` leave them.  ``watch`` gets the rows after
        that (and columns beside the table's own) and returns them observed.
        """
        if self.buckets and not dealt:
            rows = rows.repartition(self.buckets, *self.keys)
        rows = (watch(rows) if watch else rows).select(*self.columns.fieldNames())
        self.drop(version)
        view = f"_rows_{self.name.replace('.', '_').replace('`', '')}"
        rows.createOrReplaceTempView(view)
        try:
            self.spark.sql(f"INSERT INTO {self.name} PARTITION ({VERSION} = {int(version)}) SELECT * FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)

    def drop(self, version: int) -> None:
        """Forget a version and delete its files (those of a run that stopped before it was published)."""
        self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({VERSION} = {int(version)})")
        write.drop_partitions(self.spark, self.path, [f"{VERSION}={int(version)}"])

    def create_as(self, rows: DataFrame, version: int, watch=None) -> bool:
        """CTAS IF NOT EXISTS for one version: writes it only where the catalog has none.  Returns whether it was written."""
        self.create()
        if version in self.versions():
            return False
        self.write(rows, version, watch)
        return True

    def versions(self) -> list[int]:
        """Versions the catalog knows (its partitions: one for each run)."""
        return sorted(int(r[0].split("=")[1]) for r in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect())

    def read(self, version: int) -> DataFrame:
        """One version with its ``batch_id``; the catalog prunes to its folder."""
        return self.spark.table(self.name).where(F.col(VERSION) == F.lit(int(version)))

    def merged(self, previous: int | None, source: DataFrame, compare: list[str], null_safe: bool = False) -> DataFrame:
        """``source`` (one row for each key) merged into a version (C09); the version's rows stay where they are."""
        if len(self.keys) != 1:
            raise ValueError("MERGE takes one key column")
        target = self.spark.createDataFrame([], self.columns) if previous is None else self.read(previous).drop(VERSION)
        source = source.select(*self.columns.fieldNames())
        if self.buckets:
            source = source.repartition(self.buckets, *self.keys)
        return merge_upsert(target, source, self.keys[0], compare, null_safe)

    def untouched(self, previous: int, keys: DataFrame) -> DataFrame:
        """Rows of a version whose key is not in ``keys`` (C08 past the broadcast limit), not shuffled if bucketed."""
        return bucketed_anti_join(self.read(previous), keys, list(self.keys), self.buckets)
