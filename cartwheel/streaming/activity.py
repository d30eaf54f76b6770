"""Structured Streaming: event file source and windowed aggregations
(S4/R1, R2, R3, R12).

State: the 5-minute window aggregate keeps one row per (window, user,
product, type, category, brand, price); the watermark (10 minutes) lets
Spark drop a window's state once the newest event time seen is more than
10 minutes past its end. Late rows are counted by Spark in
``numRowsDroppedByWatermark``. The RocksDB state store keeps large state
off the JVM heap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions.columns import count_type
from cartwheel.schema import CART, EVENT_SCHEMA, PURCHASE, REMOVE, VIEW

# 10-minute watermark, 5-minute tumbling window, one file per
# trigger, 60-second trigger.
WATERMARK = "10 minutes"
WINDOW = "5 minutes"
MAX_FILES_PER_TRIGGER = 1
TRIGGER = "60 seconds"

ACTIVITY_KEYS = ["user_id", "product_id", "event_type", "category_code", "brand", "price"]
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Select the RocksDB state store (must be set before a query starts)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def read_event_stream(spark: SparkSession, path: str, fmt: str = "csv",
                      schema: T.StructType = EVENT_SCHEMA,
                      max_files_per_trigger: int = MAX_FILES_PER_TRIGGER, **options) -> DataFrame:
    """File stream with the declared schema (CSV with header)."""
    reader = (spark.readStream.format(fmt).schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if fmt == "csv":
        reader = reader.option("header", True)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path).withColumn("event_time", F.col("event_time").cast("timestamp"))


def windowed_activity(stream: DataFrame, watermark: str = WATERMARK, window: str = WINDOW,
                      keys=ACTIVITY_KEYS) -> DataFrame:
    """R2 + R3: rows per (5-minute window, keys) under a 10-minute watermark."""
    return (stream.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", window), *keys)
            .agg(F.count(F.lit(1)).alias("event_count")))


def hourly_activity_stream(stream: DataFrame, watermark: str = WATERMARK, exact: bool = True) -> DataFrame:
    """A16 on a stream. ``exact`` chains two aggregations (append mode): one
    row per (hour, user), then the hour, so unique users are counted exactly and
    an hour is emitted once, when the watermark has passed its end; the state is
    the users of open hours. Otherwise one aggregation with HLL++ users (update
    mode too)."""
    events = stream.withWatermark("event_time", watermark)
    counts = [F.count(F.lit(1)).alias("total_events"), count_type(VIEW).alias("views"),
              count_type(CART).alias("carts"), count_type(PURCHASE).alias("purchases"),
              count_type(REMOVE).alias("removes"), F.sum("price").alias("sum_price"),
              F.count("price").alias("n_priced")]
    hour = F.window("event_time", "1 hour")
    if not exact:
        return events.groupBy(hour).agg(*counts, F.approx_count_distinct("user_id").alias("approx_unique_users"))
    names = ["total_events", "views", "carts", "purchases", "removes", "sum_price", "n_priced"]
    per_user = events.groupBy(hour, "user_id").agg(*counts)
    return per_user.groupBy(F.window("window", "1 hour")).agg(
        *[F.sum(c).alias(c) for c in names], F.count("user_id").alias("unique_users"))


def visits_stream(stream: DataFrame, gap_minutes: int = 30, watermark: str = WATERMARK) -> DataFrame:
    """X2 on a stream (append mode): a user's visit is emitted once, when the
    watermark has passed ``gap_minutes`` after its last event; until then it is
    one row of state, merged with overlapping ones."""
    return (stream.withWatermark("event_time", watermark).filter(F.col("user_id").isNotNull())
            .groupBy("user_id", F.session_window("event_time", f"{gap_minutes} minutes").alias("visit"))
            .agg(F.count(F.lit(1)).alias("events"), count_type(PURCHASE).alias("purchases"))
            .select("user_id", F.col("visit.start").alias("visit_start"), F.col("visit.end").alias("visit_end"),
                    "events", "purchases"))


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """Rows of a stateful operator's state after the last batch, read from the
    query's checkpoint: ``key`` and ``value`` structs."""
    return (spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
            .select("key", "value"))


def flatten_window(df: DataFrame) -> DataFrame:
    """``window`` struct → ``window_start``, ``window_end`` columns."""
    return df.select(F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"),
                     *[c for c in df.columns if c != "window"])
