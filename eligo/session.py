"""Session-level settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job session should carry; the library never requires them.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and is visible to every
    executor; a cluster session without it is an error, since a local folder
    would differ per machine.  Only a local-mode session (tests) gets a fresh
    local folder when the setting is unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="eligo-scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared scratch folder."""
    return f"{scratch_root(spark)}/eligo/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared scratch folder and read it back.

    Cuts the lineage of a frame that several branches read (each would
    otherwise recompute it) and keeps it safe from executor loss: the copy
    lives in the shared folder, not on executor disks.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
