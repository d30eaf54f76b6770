"""Event schema and the adapter from the driver tables to a clickstream.

The clickstream has the nine columns of the original event export plus
``event_id``, a unique key used as the last tie-break wherever row order
matters (first brand of a category, earliest viewed category, ranks).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The declared nine-column event schema of the source data.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_time", T.TimestampType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("product_id", T.LongType(), True),
        T.StructField("category_id", T.DecimalType(38, 0), True),
        T.StructField("category_code", T.StringType(), True),
        T.StructField("brand", T.StringType(), True),
        T.StructField("price", T.DoubleType(), True),
        T.StructField("user_id", T.StringType(), True),
        T.StructField("user_session", T.StringType(), True),
    ]
)

EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]
KEYED_COLUMNS = ["event_id"] + EVENT_COLUMNS

# The event vocabulary of the source data.
VIEW, CART, PURCHASE, REMOVE = "view", "cart", "purchase", "remove_from_cart"
INTERACTION_TYPES = (VIEW, CART, PURCHASE)

# Base of the synthetic 19-digit category id of the adapter.
CATEGORY_ID_BASE = 2053013500000000000

# Parts up to which Spark may broadcast them. Spark's own limit goes by the size
# of the compressed file: a million parts stay below it, and each reading of the
# clickstream then sends about 30 MB of them through the driver.
BROADCAST_PARTS = 50_000


def ensure_utc(spark: SparkSession) -> None:
    """All time parts are read in UTC (session setting, hazard H1)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _adapter_price(event_id: Column, value: Column) -> Column:
    return (
        F.when(event_id % 101 == 0, F.lit(0.0))
        .when(event_id % 211 == 0, -value)
        .when(event_id % 307 == 0, F.lit(None).cast("double"))
        .when(event_id % 401 == 0, value * 100)
        .otherwise(value)
    )


def clickstream_from(events: DataFrame, part: DataFrame) -> DataFrame:
    """events ⟕ part → clickstream (an event without a product keeps its row).

    A query reads the clickstream many times and ``part`` grows with the scale
    factor: over ``BROADCAST_PARTS`` rows it is shuffled, never broadcast, so
    nothing of it goes through the driver (AQE splits skewed product keys).
    Below that the join is left to Catalyst/AQE.
    """
    ev = events.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
    )
    pt = part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    if part.count() > BROADCAST_PARTS:
        pt = pt.hint("shuffle_hash")
    j = ev.join(pt, ev["k"] == pt["p_partkey"], "left")
    word = F.get(F.split("p_name", " "), 1)
    return j.select(
        F.col("event_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.when(F.col("event_type") == "click", F.lit(CART))
        .when(F.col("event_type") == "error", F.lit(REMOVE))
        .otherwise(F.col("event_type"))
        .alias("event_type"),
        F.col("k").alias("product_id"),
        (F.lit(CATEGORY_ID_BASE).cast("decimal(38,0)") + F.col("p_size"))
        .cast("decimal(38,0)")
        .alias("category_id"),
        F.when(F.col("k") % 3 == 0, F.lit(None).cast("string"))
        .when(F.col("k") % 17 == 0, F.lit(""))
        .otherwise(F.concat(F.lower("p_type"), F.lit("."), word))
        .alias("category_code"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("p_brand"))
        .alias("brand"),
        _adapter_price(F.col("event_id"), F.col("value")).alias("price"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(
            F.col("user_id").cast("string"), F.lit("-"), F.to_date("ts").cast("string")
        ).alias("user_session"),
    )


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read ``events`` and ``part`` from a scale-factor folder as a clickstream."""
    ensure_utc(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return clickstream_from(events, part)


# DuckDB twin of ``clickstream_from`` for the oracle queries (a CTE body).
CLICKSTREAM_SQL = """
SELECT e.event_id,
       e.ts AS event_time,
       CASE e.event_type WHEN 'click' THEN 'cart' WHEN 'error' THEN 'remove_from_cart'
            ELSE e.event_type END AS event_type,
       CAST(json_extract_string(e.props, '$.k') AS BIGINT) AS product_id,
       CAST(2053013500000000000 + p.p_size AS DECIMAL(38,0)) AS category_id,
       CASE WHEN CAST(json_extract_string(e.props, '$.k') AS BIGINT) % 3 = 0 THEN NULL
            WHEN CAST(json_extract_string(e.props, '$.k') AS BIGINT) % 17 = 0 THEN ''
            ELSE lower(p.p_type) || '.' || split_part(p.p_name, ' ', 2) END AS category_code,
       CASE WHEN e.event_id % 7 = 0 THEN NULL ELSE p.p_brand END AS brand,
       CASE WHEN e.event_id % 101 = 0 THEN CAST(0.0 AS DOUBLE)
            WHEN e.event_id % 211 = 0 THEN -e.value
            WHEN e.event_id % 307 = 0 THEN CAST(NULL AS DOUBLE)
            WHEN e.event_id % 401 = 0 THEN e.value * 100
            ELSE e.value END AS price,
       CAST(e.user_id AS VARCHAR) AS user_id,
       CAST(e.user_id AS VARCHAR) || '-' || strftime(e.ts, '%Y-%m-%d') AS user_session
FROM events e
LEFT JOIN part p ON p.p_partkey = CAST(json_extract_string(e.props, '$.k') AS BIGINT)
"""
