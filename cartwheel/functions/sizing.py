"""Lineage cuts and the folder for intermediate tables.

A large intermediate table that is read more than once is written as Parquet
into the folder the cluster names in ``spark.checkpoint.dir`` (never a
machine-local folder of a cluster) and read back.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; set one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # One process is driver and executor: a temporary folder is shared.
        configured = tempfile.mkdtemp(prefix="cartwheel-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet into the shared checkpoint folder
    and read it back. Unlike an RDD checkpoint the data is computed once,
    stored columnar, and later readers get column pruning and filter
    pushdown; the files survive the loss of any executor."""
    return materialize_at(df)[0]


def materialize_at(df: DataFrame) -> tuple[DataFrame, str]:
    """``materialize`` that also returns the folder written."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a folder written by ``materialize_at`` once nothing reads it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))
