"""Product tables.

The reference built popularity and metadata as two aggregations of the
same table joined on the product key (J2); both group by the same key, so
here they are one ``groupBy``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import (
    WEIGHTS_PREPROCESS,
    count_type,
    earliest_values,
    interaction_score,
    is_type,
    popularity_score,
    top_category,
)
from cartwheel.operators.indexing import attach_index, index_table
from cartwheel.schema import CART, INTERACTION_TYPES, PURCHASE, VIEW


def _popularity_aggs(exact: bool = True):
    cd = F.count_distinct if exact else F.approx_count_distinct
    return [
        F.count(F.lit(1)).alias("total_events"),
        count_type(VIEW).alias("total_views"),
        count_type(CART).alias("total_carts"),
        count_type(PURCHASE).alias("total_purchases"),
        cd("user_id").alias("unique_users"),
        F.avg("price").alias("avg_price"),
    ]


def product_popularity(cleaned: DataFrame, exact: bool = True) -> DataFrame:
    """Per product counts, unique users, mean price; ``total_revenue``
    sums the price of ALL events (views included, as the reference did);
    ``purchase_revenue`` sums purchases only."""
    return cleaned.groupBy("product_id").agg(
        *_popularity_aggs(exact),
        F.sum("price").alias("total_revenue"),
        F.sum(F.when(is_type(PURCHASE), F.col("price"))).alias("purchase_revenue"),
    )


_DIMENSIONS = ("category_id", "category_code", "brand", "user_id")


def _product_parts(cleaned: DataFrame, dimensions=_DIMENSIONS) -> DataFrame:
    """One pass over the events: counts per (product, value) of every
    dimension (GROUPING SETS, combined map-side), with the dimension's number
    as ``_dim``. No value lists, and no distinct buffers, travel with a product."""
    sets = [["product_id", d] for d in dimensions]
    gid = F.grouping_id()
    # In the id, the bits of all dimensions but the set's own are 1.
    full = (1 << len(dimensions)) - 1
    dim = F.lit(None).cast("int")
    for i in range(len(dimensions)):
        dim = F.when(F.col("_gid") == full - (1 << (len(dimensions) - 1 - i)), F.lit(i)).otherwise(dim)
    price = F.col("price")
    return cleaned.groupingSets(sets, "product_id", *dimensions).agg(
        F.count(F.lit(1)).alias("_n"), count_type(VIEW).alias("_views"),
        count_type(CART).alias("_carts"), count_type(PURCHASE).alias("_purchases"),
        F.sum(price).alias("_sum"), F.count(price).alias("_priced"), gid.alias("_gid"),
    ).withColumn("_dim", dim)


def _mode(dimension: str) -> Column:
    """Most frequent non-NULL value of a dimension (ties → smallest value)."""
    i = _DIMENSIONS.index(dimension)
    item = F.struct((-F.col("_n")).alias("n"), F.col(dimension).alias("v"))
    return F.min(F.when((F.col("_dim") == i) & F.col(dimension).isNotNull(), item))["v"]


def _modes() -> list[Column]:
    return [_mode("category_id").alias("main_category_id"),
            _mode("category_code").alias("main_category_code"),
            _mode("brand").alias("main_brand")]


def product_metadata(cleaned: DataFrame) -> DataFrame:
    """Per product the modal category id, category and brand (ties →
    smallest value, NULLs ignored)."""
    return _product_parts(cleaned, _DIMENSIONS[:3]).groupBy("product_id").agg(*_modes())


def product_data(cleaned: DataFrame, exact: bool = True, with_index: bool = True) -> DataFrame:
    """Metadata + popularity from one pass over the events (12 columns);
    ``exact=False`` counts users with HyperLogLog++."""
    if exact:
        first = F.col("_dim") == 0  # every event is in each set once

        def total(col: str) -> Column:
            return F.sum(F.when(first, F.col(col)))

        users = F.count(F.when((F.col("_dim") == 3) & F.col("user_id").isNotNull(), 1))
        g = _product_parts(cleaned).groupBy("product_id").agg(
            *_modes(), F.try_divide(total("_sum"), total("_priced").cast("double")).alias("avg_price"),
            total("_n").alias("total_events"), total("_views").alias("total_views"),
            total("_carts").alias("total_carts"), total("_purchases").alias("total_purchases"),
            users.alias("unique_users"), total("_sum").alias("total_revenue"))
    else:
        popularity = cleaned.groupBy("product_id").agg(*_popularity_aggs(False),
                                                       F.sum("price").alias("total_revenue"))
        g = product_metadata(cleaned).join(popularity, "product_id")
    cols = ["product_id", "main_category_id", "main_category_code", "main_brand", "avg_price",
            "total_events", "total_views", "total_carts", "total_purchases", "unique_users",
            "total_revenue"]
    if with_index:
        idx = index_table(cleaned, "product_id")
        g = g.join(idx.select("product_id", "product_id_idx"), "product_id", "left")
        return g.select(F.col("product_id_idx").alias("product_idx"), *cols)
    return g.select(*cols)


def product_features(cleaned: DataFrame, exact: bool = True) -> DataFrame:
    """Training variant with the earliest event's category (top level)
    and brand, and the popularity score (P13).

    The earliest (category, brand) comes from a hash pre-aggregation per
    (product, category, brand); both tables are aggregated by product id.
    """
    g = cleaned.groupBy("product_id").agg(*_popularity_aggs(exact))
    first = earliest_values(cleaned, ["product_id"],
                            F.struct(F.col("category_code").alias("c"), F.col("brand").alias("b")),
                            "_first").withColumnRenamed("product_id", "_product")
    g = g.join(first, F.col("product_id").eqNullSafe(F.col("_product")), "left")
    return g.select(
        "product_id", "total_events", "total_views", "total_carts", "total_purchases",
        "unique_users", "avg_price", F.col("_first.b").alias("brand"),
        F.when(F.col("_first.c").isNull(), F.lit("unknown"))
        .otherwise(F.substring_index(F.col("_first.c"), ".", 1)).alias("category"),
        popularity_score("total_purchases", "total_carts", "total_views", "unique_users")
        .alias("enhanced_popularity_score"),
    )


def popular_products(products: DataFrame, k: int | None = 10) -> DataFrame:
    """Products by purchases descending (ties by product id); top ``k``."""
    cols = ["product_id", "total_purchases", "avg_price", "main_category_code", "main_brand"]
    out = products.select(*cols).orderBy(F.desc("total_purchases"), F.asc("product_id"))
    return out.limit(k) if k else out


def recommendation_frame(cleaned: DataFrame, weights=WEIGHTS_PREPROCESS,
                         types=INTERACTION_TYPES) -> DataFrame:
    """Interactions with original ids, dense indices and the implicit score."""
    users = index_table(cleaned, "user_id")
    prods = index_table(cleaned, "product_id")
    inter = cleaned.filter(F.col("event_type").isin(*types))
    inter = attach_index(inter, users, "user_id", "user_id_idx")
    inter = attach_index(inter, prods, "product_id", "product_id_idx")
    return inter.select(
        "user_id", F.col("user_id_idx").alias("user_idx"), "product_id",
        F.col("product_id_idx").alias("product_idx"), "event_type", "price", "event_time",
        interaction_score(weights).alias("interaction_score"))
