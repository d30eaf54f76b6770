"""Stage a table as an ordered series of files for a file-stream source.

The table is range-partitioned by event time, so file ``i`` holds only
events later than every event of file ``i-1``; each file then gets a
strictly increasing modification time, which is the order in which the
file source picks them up (one per trigger). File moves and time stamps go
through the Hadoop file-system API (metadata operations only).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.sizing import ensure_checkpoint_dir
from cartwheel.schema import EVENT_COLUMNS
from cartwheel.sources.files import CSV_NULL


def scratch_dir(spark: SparkSession, tag: str) -> str:
    """A fresh folder inside the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def publish_ordered(spark: SparkSession, staging: str, target: str, prefix: str,
                    start_mtime_ms: int) -> int:
    """Move the data files of ``staging`` into ``target`` in name order with
    increasing modification times; returns the next free time stamp."""
    fs, jvm = _fs(spark, target)
    Path = jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(Path(target))
    names = sorted(st.getPath().getName() for st in fs.listStatus(Path(staging))
                   if st.getPath().getName().startswith("part-"))
    t = start_mtime_ms
    for i, name in enumerate(names):
        dst = Path(f"{target}/{prefix}-{i:05d}-{name}")
        fs.rename(Path(f"{staging}/{name}"), dst)
        fs.setTimes(dst, t, -1)
        t += 1000
    return t


def stage_event_files(events: DataFrame, target: str, files: int, fmt: str = "csv",
                      prefix: str = "events", start_mtime_ms: int = 1_000_000_000_000,
                      columns=EVENT_COLUMNS) -> int:
    """Write ``events`` as ``files`` time-ordered files into ``target``."""
    spark = events.sparkSession
    staging = scratch_dir(spark, "staging")
    ordered = (events.repartitionByRange(files, "event_time", "event_id")
               .sortWithinPartitions("event_time", "event_id").select(*columns))
    w = ordered.write.mode("overwrite")
    if fmt == "csv":
        (w.option("header", True).option("nullValue", CSV_NULL)
         .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(staging))
    else:
        w.format(fmt).save(staging)
    return publish_ordered(spark, staging, target, prefix, start_mtime_ms)


def day_filter(lo: int, hi: int, ts: str = "event_time"):
    """Rows whose day of month is in [lo, hi] (false without a time)."""
    d = F.dayofmonth(ts)
    return F.coalesce((d >= lo) & (d <= hi), F.lit(False))
