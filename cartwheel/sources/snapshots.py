"""Run-stamped tables.

Each run writes ``<base>/<name>/snapshot=YYYYMMDD_HHMMSS``. Readers either
see all runs with the ``snapshot`` partition column (S2 — the original read
a glob over all runs, so a second run doubled every row) or only the newest
run (S3). Finding the newest run lists directory names through the Hadoop
file-system API, so it works on HDFS/object stores, and reads only that
folder.
"""

from __future__ import annotations

import re
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT_FORMAT = "%Y%m%d_%H%M%S"
_STAMP = re.compile(r"^snapshot=(\d{8}_\d{6})$")


def snapshot_stamp(now: datetime | None = None) -> str:
    return (now or datetime.now(timezone.utc)).strftime(SNAPSHOT_FORMAT)


def write_snapshot(df: DataFrame, base: str, name: str, stamp: str | None = None) -> str:
    """Write one run of a table; returns the stamp used."""
    stamp = stamp or snapshot_stamp()
    df.write.mode("overwrite").parquet(f"{base.rstrip('/')}/{name}/snapshot={stamp}")
    return stamp


def scan_snapshots(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    """Every committed run, with its ``snapshot`` column (None: no run)."""
    root = f"{base.rstrip('/')}/{name}"
    stamps = list_snapshots(spark, base, name)
    if not stamps:
        return None
    return (spark.read.option("basePath", root).parquet(*[f"{root}/snapshot={s}" for s in stamps])
            .withColumn("snapshot", F.col("snapshot").cast("string")))


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    p, fs = _file_system(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def list_snapshots(spark: SparkSession, base: str, name: str) -> list[str]:
    """Stamps of the committed runs of a table, oldest first. A run is committed
    when its writer has put ``_SUCCESS`` into its folder; others are invisible."""
    root = f"{base.rstrip('/')}/{name}"
    stamps = [m.group(1) for m in map(_STAMP.match, names_in(spark, root)) if m]
    return sorted(s for s in stamps if "_SUCCESS" in names_in(spark, f"{root}/snapshot={s}"))


def latest_snapshot(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    """S3: the newest committed run only (None when there is no run)."""
    stamps = list_snapshots(spark, base, name)
    return read_snapshot(spark, base, name, stamps[-1]) if stamps else None


def read_snapshot(spark: SparkSession, base: str, name: str, stamp: str) -> DataFrame:
    """One run of a table."""
    root = f"{base.rstrip('/')}/{name}"
    return (spark.read.option("basePath", root).parquet(f"{root}/snapshot={stamp}")
            .withColumn("snapshot", F.col("snapshot").cast("string")))


# A run of several tables is one manifest, written last: a text file naming
# them, made under another name and renamed into place. A run that was killed
# between two tables has no manifest and is never read.
MANIFESTS = "_runs"


def write_run(tables: dict[str, DataFrame], base: str, stamp: str | None = None) -> str:
    """Write all tables of a run, then commit them together; returns the stamp."""
    stamp = stamp or snapshot_stamp()
    for name, df in tables.items():
        write_snapshot(df, base, name, stamp)
    commit_run(next(iter(tables.values())).sparkSession, base, stamp, list(tables))
    return stamp


def commit_run(spark: SparkSession, base: str, stamp: str, names: list[str]) -> None:
    folder = f"{base.rstrip('/')}/{MANIFESTS}"
    made, fs = _file_system(spark, f"{folder}/.{stamp}.{uuid.uuid4().hex}")
    out = fs.create(made)
    out.write(bytearray("\n".join(names).encode()))
    out.close()
    final, _ = _file_system(spark, f"{folder}/{stamp}")
    if fs.exists(final):
        fs.delete(final, False)
    if not fs.rename(made, final):
        raise OSError(f"cannot commit run {stamp} in {base}")


def list_runs(spark: SparkSession, base: str) -> list[str]:
    """Stamps of the committed runs, oldest first."""
    return sorted(n for n in names_in(spark, f"{base.rstrip('/')}/{MANIFESTS}") if re.fullmatch(r"\d{8}_\d{6}", n))


def latest_run(spark: SparkSession, base: str) -> dict[str, DataFrame] | None:
    """All tables of the newest committed run, by name (None: no run)."""
    stamps = list_runs(spark, base)
    if not stamps:
        return None
    lines = spark.read.text(f"{base.rstrip('/')}/{MANIFESTS}/{stamps[-1]}").collect()  # names of tables
    return {r.value: read_snapshot(spark, base, r.value, stamps[-1]) for r in lines}
