"""File sources and sinks.

Writers never go through the driver: every sink is a distributed
``DataFrameWriter`` call. Partitioned writes sort inside each task instead
of repartitioning by the partition column (one task per day would be one
task per ~1/30 of the data) and bound file sizes with
``maxRecordsPerFile``; overwrites replace only the partitions written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions.ranking import first_rows_per_group
from cartwheel.schema import EVENT_SCHEMA

MAX_RECORDS_PER_FILE = 5_000_000
# NULL marker for CSV files written here, so NULL and '' survive a round trip
# (files from elsewhere keep the default: an empty field is NULL).
CSV_NULL = "\\N"


def read_clickstream_csv(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA,
                         **options) -> DataFrame:
    """CSV with header and the declared schema; bad cells become NULL
    (PERMISSIVE), ``... UTC`` timestamps parse."""
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", null_value: str = CSV_NULL) -> None:
    """CSV with header; timestamps with microseconds; NULL as ``null_value``."""
    (df.write.mode(mode).option("header", True).option("nullValue", null_value)
     .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(path))


def head_sample_by_month(df: DataFrame, n: int = 1_000_000, ts: str = "event_time",
                         key: str = "event_id") -> DataFrame:
    """The first ``n`` events of every month (by time, then event key).

    Exact and without one task per month: see ``functions.ranking``.
    """
    month = F.date_format(ts, "yyyy-MM")
    with_month = df.withColumn("_month", month)
    out = first_rows_per_group(with_month, ["_month"], [F.col(ts), F.col(key)], n)
    return out.drop("_month")


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite",
                      max_records: int = MAX_RECORDS_PER_FILE) -> None:
    """Parquet partitioned by ``by``; dynamic partition overwrite.

    NULL partition values land in ``__HIVE_DEFAULT_PARTITION__``.
    """
    # rebalanced by the partition columns: few files a folder, and a skewed
    # folder is split over several tasks
    (df.hint("rebalance", *[F.col(c) for c in by]).sortWithinPartitions(*by).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records)
     .partitionBy(*by).parquet(path))


def write_cleaned(cleaned: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The cleaned events by ``date, event_type``."""
    write_partitioned(cleaned, path, ["date", "event_type"], mode)


def write_user_behavior(users: DataFrame, path: str, mode: str = "overwrite") -> None:
    """User behaviour by ``main_category`` when present, else plain."""
    if "main_category" in users.columns:
        write_partitioned(users, path, ["main_category"], mode)
    else:
        write_table(users, path, mode)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Plain Parquet."""
    df.write.mode(mode).parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType,
                  fmt: str = "parquet") -> DataFrame:
    """The table, or a typed empty table when the path does not exist
    (only a missing path is tolerated; other errors propagate)."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise


def append_batch_csv(df: DataFrame, path: str, batch_id: int) -> None:
    """One batch of rows as CSV under ``batch_id=<id>``; re-running a
    batch overwrites its own folder only (idempotent replays)."""
    out = df.withColumn("batch_id", F.lit(batch_id).cast("long"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("header", True).partitionBy("batch_id").csv(path))


def merge_recommendations(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All per-batch CSV outputs as one table; rows written twice (a
    batch appended again by a replay) are kept once (hash distinct)."""
    fields = schema.fields + ([] if "batch_id" in schema.fieldNames()
                              else [T.StructField("batch_id", T.LongType())])
    df = spark.read.schema(T.StructType(fields)).option("header", True).csv(path)
    return df.distinct()


def run_metadata(cleaned: DataFrame, segmented: DataFrame, source: str,
                 segment_col: str = "segment_id") -> DataFrame:
    """One row: distinct users, distinct products, rows, segments."""
    seg = segmented.agg(F.count_distinct(segment_col).alias("n")).scalar()
    return cleaned.agg(
        F.count_distinct("user_id").alias("total_users"),
        F.count_distinct("product_id").alias("total_products"),
        F.count(F.lit(1)).alias("total_interactions")).select(
        "*", seg.alias("segments_count"), F.lit(source).alias("data_source"),
        F.current_timestamp().alias("training_date"))
