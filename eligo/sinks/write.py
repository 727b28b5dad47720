"""Table writes on path-based Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def create_table_ddl(name: str, schema: T.StructType, partition_cols=None,
                     location: str | None = None, bucket_cols=(), buckets: int = 0) -> str:
    """``CREATE TABLE IF NOT EXISTS`` text for a schema (names quoted); with ``buckets``, bucketed and sorted by ``bucket_cols``."""
    cols = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {name} (\n  {cols}\n) USING parquet"
    if partition_cols:
        ddl += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_cols) + ")"
    if buckets:
        keys = ", ".join(f"`{c}`" for c in bucket_cols)
        ddl += f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {int(buckets)} BUCKETS"
    if location:
        ddl += " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return ddl


def create_table(spark: SparkSession, name: str, schema: T.StructType,
                 partition_cols=None, location: str | None = None, bucket_cols=(), buckets: int = 0) -> None:
    spark.sql(create_table_ddl(name, schema, partition_cols, location, bucket_cols, buckets))


def add_partitions(spark: SparkSession, name: str, specs: list[dict]) -> None:
    """Make partitions of a catalog table known (integer values); known ones are passed over."""
    for i in range(0, len(specs), 100):
        parts = " ".join("PARTITION (" + ", ".join(f"`{k}`={int(v)}" for k, v in x.items()) + ")"
                         for x in specs[i:i + 100])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")


def overwrite_partitions(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    """Replace only the partitions present in ``df``; all others stay.

    Rows are grouped by partition inside each task (no shuffle), so a task
    writes one file per partition it holds.
    """
    (df.sortWithinPartitions(*partition_cols)
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols)
     .parquet(path))


def overwrite(df: DataFrame, path: str, partition_cols=None) -> None:
    """Replace the whole table."""
    w = df.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def drop_partitions(spark: SparkSession, path: str, specs: list[str]) -> None:
    """Delete partition directories (``a=1/b=2``) of a table; missing ones are passed over."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for spec in specs:
        p = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{spec}")
        p.getFileSystem(conf).delete(p, True)
