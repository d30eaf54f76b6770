"""Cleaning: time parts, top-level category, brand imputation, price repair.

Reference semantics, with the ambiguities fixed (see README):

* category_code → NULL/'' become ``unknown``, otherwise the first level.
* brand NULL/'' → the brand of the category's earliest event (policy
  ``first_row``; a NULL or '' there gives ``generic``) or the earliest known
  brand (policy ``first_known``).
* price NULL or ≤ 0 → category mean; inside [0.1·q1, 10·q3] kept; otherwise
  the category mean. q1/q3 are quartiles of the raw prices, the category
  mean is taken over raw prices (``robust=True``: in-bound prices only).

Scale: a window partitioned by category would put one third of all rows
("unknown") into one task. Here one hash aggregation per (category, brand,
price), combined map-side, is written; quartiles, means and brands follow from
that small table and are written with one row per category, so that however
often a plan uses the cleaned table, each use is one scan and one join left to
Spark's sizes. No value round-trips through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import order_key, top_category
from cartwheel.functions.quantiles import exact_quantiles, quantiles
from cartwheel.functions.sizing import drop_table, materialize, materialize_at

# Price bounds are [0.1 * q1, 10 * q3]; quartile error 0.01.
LOWER_FACTOR = 0.1
UPPER_FACTOR = 10.0
QUARTILES = (0.25, 0.75)
DEFAULT_REL_ERROR = 0.01
UNKNOWN_CATEGORY = "unknown"
GENERIC_BRAND = "generic"

TIME_PART_COLUMNS = ["hour", "minute", "second", "day", "month", "dayofweek", "date", "hour_bucket"]


def day_text(t: Column) -> Column:
    """``yyyy-MM-dd`` (a date cast: cheaper per row than a pattern format)."""
    return F.to_date(t).cast("string")


def hour_bucket_text(t: Column) -> Column:
    """``yyyy-MM-dd HH:00:00``."""
    return F.concat(day_text(t), F.lit(" "), F.lpad(F.hour(t).cast("string"), 2, "0"),
                    F.lit(":00:00"))


def time_parts(df: DataFrame, ts: str = "event_time") -> DataFrame:
    """P1 + P2: integer time parts (Sunday = 1) and the day/hour bucket texts."""
    t = F.col(ts)
    return df.select(
        "*",
        F.hour(t).alias("hour"),
        F.minute(t).alias("minute"),
        F.second(t).alias("second"),
        F.dayofmonth(t).alias("day"),
        F.month(t).alias("month"),
        F.dayofweek(t).alias("dayofweek"),
        day_text(t).alias("date"),
        hour_bucket_text(t).alias("hour_bucket"),
    )


def price_quartiles(df: DataFrame, rel_error: float = DEFAULT_REL_ERROR) -> DataFrame:
    """One row ``q1, q3`` of the raw prices."""
    q = quantiles(df, "price", QUARTILES, rel_error)
    return q.select(F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3"))


def with_top_category(df: DataFrame, col: str = "category_code") -> DataFrame:
    """P3 applied in place, as the reference overwrote the column."""
    return df.withColumn(col, top_category(col, UNKNOWN_CATEGORY))


def price_counts(df: DataFrame) -> DataFrame:
    """Per (category, brand, price): events ``n`` and the earliest event key.
    All statistics of the cleaning follow from this one pass over the events."""
    return df.groupBy("category_code", F.nullif(F.col("brand"), F.lit("")).alias("brand"), "price").agg(
        F.count(F.lit(1)).alias("n"), F.min(order_key()).alias("first_key"))


def category_stats(df: DataFrame, brand_policy: str = "first_row", bounds: Column | None = None,
                   lower_factor: float = LOWER_FACTOR, upper_factor: float = UPPER_FACTOR,
                   counts: DataFrame | None = None) -> DataFrame:
    """A9 + W1: per category the mean raw price and the brand to impute.

    Hash aggregations per (category, brand, price) — or the given ``counts`` —
    and (category, brand), then one row per category. ``bounds`` (array q1, q3)
    restricts the mean to in-bound prices (robust).
    """
    if brand_policy not in ("first_row", "first_known"):
        raise ValueError(f"unknown brand policy {brand_policy!r}")
    price = F.col("price")
    if bounds is not None:
        ok = (price > 0) & (price >= bounds[0] * lower_factor) & (price <= bounds[1] * upper_factor)
        price = F.when(ok, price)
    pairs = (price_counts(df) if counts is None else counts).groupBy("category_code", "brand").agg(
        F.min("first_key").alias("_k"), F.sum(price * F.col("n")).alias("_sum"),
        F.sum(F.when(price.isNotNull(), F.col("n"))).alias("_n"))
    item = F.struct("_k", "brand")
    if brand_policy == "first_known":
        item = F.when(F.col("brand").isNotNull(), item)
    return pairs.groupBy("category_code").agg(
        F.try_divide(F.sum("_sum"), F.sum("_n").cast("double")).alias("avg_cat_price"),
        F.min(item)["brand"].alias("first_brand"))


def cleaning_statistics(df: DataFrame, brand_policy: str = "first_row",
                        rel_error: float = DEFAULT_REL_ERROR, robust: bool = False,
                        lower_factor: float = LOWER_FACTOR, upper_factor: float = UPPER_FACTOR) -> DataFrame:
    """What ``clean_events`` has to know, one row per category: category_code,
    avg_cat_price, first_brand, q1, q3. Written once into the shared folder from
    one pass over the events (a second one with ``rel_error`` > 0), so that each
    use of the cleaned table only scans its events. It can also be stored with
    a run and given to ``clean_events`` for later events."""
    counts, path = materialize_at(price_counts(with_top_category(df)))
    q = (exact_quantiles(counts, "price", QUARTILES, weight="n") if rel_error <= 0
         else quantiles(df, "price", QUARTILES, rel_error))
    bounds = q.scalar()
    stats = category_stats(df, brand_policy, bounds if robust else None, lower_factor, upper_factor, counts)
    out = materialize(stats.select("*", bounds[0].alias("q1"), bounds[1].alias("q3")).coalesce(1))
    drop_table(df.sparkSession, path)
    return out


def repair_price(price: Column, cat_mean: Column, bounds: Column,
                 lower_factor: float = LOWER_FACTOR, upper_factor: float = UPPER_FACTOR) -> Column:
    """The when-chain of the price rule."""
    q1, q3 = bounds[0], bounds[1]
    return (
        F.when(price.isNull() | (price <= 0), cat_mean)
        .when(q1.isNull() | q3.isNull(), price)
        .when((price >= q1 * lower_factor) & (price <= q3 * upper_factor), price)
        .otherwise(cat_mean)
    )


def clean_events(df: DataFrame, brand_policy: str = "first_row",
                 rel_error: float = DEFAULT_REL_ERROR, robust: bool = False,
                 lower_factor: float = LOWER_FACTOR, upper_factor: float = UPPER_FACTOR,
                 stats: DataFrame | None = None) -> DataFrame:
    """The cleaned event table: raw columns (category, brand, price replaced)
    plus hour, minute, second, day, month, dayofweek, date, hour_bucket.

    The statistics (``cleaning_statistics``, one row per category) are computed
    here unless given; the rows themselves are lazy: one scan joined to that
    small table, which Spark broadcasts by its size. With given statistics, a
    category that they lack keeps positive prices and gets ``generic`` brands.
    """
    cols = df.columns
    if stats is None:
        stats = cleaning_statistics(df, brand_policy, rel_error, robust, lower_factor, upper_factor)
    joined = with_top_category(time_parts(df)).join(stats, "category_code", "left")
    brand = F.col("brand")
    bounds = F.array("q1", "q3")
    out = joined.withColumn(
        "brand",
        F.when(brand.isNull() | (brand == F.lit("")),
               F.coalesce(F.col("first_brand"), F.lit(GENERIC_BRAND))).otherwise(brand),
    ).withColumn(
        "price", repair_price(F.col("price"), F.col("avg_cat_price"), bounds, lower_factor, upper_factor)
    )
    return out.select(*cols, *TIME_PART_COLUMNS)


def impute_brand(df: DataFrame, brand_policy: str = "first_row") -> DataFrame:
    """P7 alone: brand filled from the category's first brand (category as given)."""
    stats = category_stats(df, brand_policy).select("category_code", "first_brand")
    joined = df.join(stats, "category_code", "left")
    brand = F.col("brand")
    return joined.withColumn(
        "brand",
        F.when(brand.isNull() | (brand == F.lit("")),
               F.coalesce(F.col("first_brand"), F.lit(GENERIC_BRAND))).otherwise(brand),
    ).drop("first_brand")
