"""Per-user behaviour tables (A11 user_behavior, A12 user_features, X13).

One ``groupBy(user_id)`` per table. Distinct counts stay built-in
(``count_distinct`` → Expand + two-level aggregation) or, with
``exact=False``, HyperLogLog++ (``approx_count_distinct``), which keeps one
shuffle and a fixed-size buffer per user.

The viewed-category/brand lists of the reference grow with a user's events
(one element per view). Here they are bags: sorted ``array<struct<value,
n>>`` with one element per distinct value and its view count. The bag holds
the same multiset, is bounded by the category/brand domain instead of by
the user's row count, and is built by a pre-aggregation on (user, value)
that is combined map-side, so a hot user is never collected in one task.
The earliest viewed category comes from the same (user, category) table
(min of a fixed-width event-order key), so the main per-user aggregation
keeps only fixed-width buffers and runs as a hash aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import (
    cart_abandonment,
    conversion_rate,
    count_type,
    earliest_values,
    is_type,
    order_key,
    rfm_score,
    safe_ratio,
)
from cartwheel.functions.sizing import materialize
from cartwheel.schema import CART, PURCHASE, REMOVE, VIEW


def max_event_time(df: DataFrame, ts: str = "event_time") -> Column:
    """Newest event of the whole table, as a scalar subquery."""
    return df.agg(F.max(ts).alias("m")).scalar()


def _distinct(exact: bool):
    return F.count_distinct if exact else F.approx_count_distinct


def value_bag(df: DataFrame, value: str, where: Column | None = None, key: str = "user_id",
              name: str | None = None, first: str | None = None,
              distinct: str | None = None) -> DataFrame:
    """Per key: sorted ``array<struct<value, n>>`` of (distinct value, rows
    that match ``where``); NULL for a key without such rows.

    ``first`` also returns the earliest non-NULL value among them, and
    ``distinct`` the number of non-NULL values of ALL rows, from the same
    small (key, value) table.
    """
    hit = F.lit(True) if where is None else where
    pairs = df.groupBy(key, value).agg(F.count_if(hit).alias("n"),
                                       F.min(F.when(hit, order_key())).alias("_k"))
    items = F.collect_list(F.when(F.col("n") > 0, F.struct(
        F.col("_k"), F.col(value).cast("string").alias("value"), F.col("n"))))
    bag = pairs.groupBy(key).agg(items.alias("_items"), F.count(value).alias("_distinct"))
    cols = [F.col(key), F.when(F.size("_items") > 0, F.array_sort(
        F.transform("_items", lambda x: F.struct(x["value"], x["n"])))).alias(name or f"{value}_bag")]
    if first:
        cols.append(F.array_min(F.filter("_items", lambda x: x["value"].isNotNull()))["value"]
                    .alias(first))
    if distinct:
        cols.append(F.col("_distinct").alias(distinct))
    return bag.select(*cols)


def bag_text(col: str | Column) -> Column:
    """``value:n,value:n`` text of a bag (for comparisons and CSV output)."""
    arr = F.col(col) if isinstance(col, str) else col
    return F.array_join(
        F.transform(arr, lambda x: F.concat(F.coalesce(x["value"], F.lit("NULL")), F.lit(":"),
                                            x["n"].cast("string"))), ","
    )


def user_behavior(cleaned: DataFrame, exact: bool = True, with_lists: bool = True) -> DataFrame:
    """One row per user (reference preprocessing variant).

    ``frequency`` counts distinct purchase days; ``main_category`` is the
    category of the earliest view (NULL without views).
    """
    cd = _distinct(exact)
    view, purchase = is_type(VIEW), is_type(PURCHASE)
    price = F.col("price")
    # Four aggregations read the events: they are cleaned and written once.
    cleaned = materialize(cleaned.select("event_id", "event_time", "event_type", "product_id", "category_code",
                                         "brand", "price", "user_id", "user_session", "date"))
    newest = max_event_time(cleaned)
    agg = cleaned.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("nb_events"),
        count_type(VIEW).alias("nb_views"),
        count_type(CART).alias("nb_carts"),
        count_type(PURCHASE).alias("nb_purchases"),
        count_type(REMOVE).alias("nb_removes"),
        F.avg(price).alias("avg_price"),
        F.avg(F.when(purchase, price)).alias("avg_price_purchased"),
        cd("user_session").alias("nb_sessions"),
        F.min("event_time").alias("first_seen"),
        F.max("event_time").alias("last_seen"),
        cd(F.when(purchase, F.col("date"))).alias("frequency"),
        F.sum(F.when(purchase, price).otherwise(F.lit(0.0))).alias("monetary"),
        cd("product_id").alias("unique_products"),
        *([] if exact else [cd("category_code").alias("unique_categories"),
                            cd("brand").alias("unique_brands")]),
    )
    out = agg.select(
        "*",
        F.datediff(newest, F.col("last_seen")).alias("recency"),
        conversion_rate("nb_purchases", "nb_views").alias("conversion_rate"),
        cart_abandonment("nb_carts", "nb_purchases").alias("cart_abandonment"),
        (F.datediff("last_seen", "first_seen") + 1).alias("engagement_days"),
    ).withColumn("rfm_score", rfm_score("recency", "frequency", "monetary"))
    # both tables are aggregated by user_id like ``out``: the joins need no
    # further shuffle (or AQE broadcasts them when they are small). They also
    # give the exact distinct counts of categories and brands, which then need
    # no copy of every row in the main aggregation.
    cats = value_bag(cleaned, "category_code", view, name="viewed_categories",
                     first="main_category", distinct="unique_categories")
    brands = value_bag(cleaned, "brand", view, name="viewed_brands", distinct="unique_brands")
    for table, keep in ((cats, ["viewed_categories", "main_category", "unique_categories"]),
                        (brands, ["viewed_brands", "unique_brands"])):
        keep = [c for c in keep if (with_lists or not c.startswith("viewed"))
                and (exact or not c.startswith("unique"))]
        if keep:
            out = _join_user(out, table.select("user_id", *keep))
    cols = [
        "user_id", "nb_events", "nb_views", "nb_carts", "nb_purchases", "nb_removes",
        "avg_price", "avg_price_purchased", "nb_sessions", "first_seen", "last_seen",
        "recency", "frequency", "monetary", "unique_products", "unique_categories",
        "unique_brands",
    ]
    if with_lists:
        cols += ["viewed_categories", "viewed_brands"]
    cols += ["main_category", "conversion_rate", "cart_abandonment", "engagement_days", "rfm_score"]
    return out.select(*cols)


def _join_user(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on the user that also matches the NULL user."""
    other = right.withColumnRenamed("user_id", "_user")
    return left.join(other, left["user_id"].eqNullSafe(other["_user"]), "left").drop("_user")


def user_features(cleaned: DataFrame, exact: bool = True) -> DataFrame:
    """Training variant; ``frequency`` counts distinct active days."""
    cd = _distinct(exact)
    price = F.col("price")
    newest = max_event_time(cleaned)
    agg = cleaned.groupBy("user_id").agg(
        F.max("event_time").alias("_last"),
        F.min("event_time").alias("_first"),
        cd(F.to_date("event_time")).alias("frequency"),
        F.sum(F.when(is_type(PURCHASE), price).otherwise(F.lit(0.0))).alias("monetary"),
        F.count(F.lit(1)).alias("total_events"),
        count_type(VIEW).alias("views"),
        count_type(CART).alias("carts"),
        count_type(PURCHASE).alias("purchases"),
        count_type(REMOVE).alias("removes"),
        cd("product_id").alias("unique_products"),
        cd("category_code").alias("unique_categories"),
        cd("brand").alias("unique_brands"),
        F.avg(price).alias("avg_price"),
        cd("user_session").alias("unique_sessions"),
    )
    return agg.select(
        "user_id",
        F.datediff(newest, F.col("_last")).alias("recency"),
        "frequency", "monetary", "total_events", "views", "carts", "purchases", "removes",
        "unique_products", "unique_categories", "unique_brands", "avg_price", "unique_sessions",
        (F.datediff("_last", "_first") + 1).alias("engagement_days"),
        conversion_rate("purchases", "views").alias("conversion_rate"),
        cart_abandonment("carts", "purchases").alias("cart_abandonment"),
        safe_ratio(F.col("total_events"), F.col("unique_sessions")).alias("avg_events_per_session"),
    ).withColumn("rfm_score", rfm_score("recency", "frequency", "monetary"))


def first_viewed_category(cleaned: DataFrame) -> DataFrame:
    """Per user, the category of the earliest view (NULL without views)."""
    view = is_type(VIEW)
    return earliest_values(cleaned, ["user_id"], "category_code", "main_category",
                           where=view & F.col("category_code").isNotNull())


def visit_frequency(cleaned: DataFrame, exact: bool = True) -> DataFrame:
    """Per user and ISO week: sessions, active days, events."""
    cd = _distinct(exact)
    week = F.date_trunc("week", F.col("event_time")).cast("date")
    return cleaned.groupBy("user_id", week.alias("week")).agg(
        cd("user_session").alias("sessions"),
        cd(F.to_date("event_time")).alias("active_days"),
        F.count(F.lit(1)).alias("events"),
    )
