"""Recommendation: interactions, category affinity (R9), popular fallback
(R10), and the interaction matrix for ALS (A17).

Category affinity, per user: interest per top-level category → the 3 most
interesting categories → products of those categories that sold at least
once → score = interest · purchases / 100 → the 5 best per user.

Scale notes:
* the product side is cut to the ``k_products`` best sellers of each
  category BEFORE the join. This is exact: inside one category the score is
  interest·purchases with a constant positive interest, so a product outside
  its category's top-k (by purchases desc, product id asc) can never be in a
  user's top-k. The cut table has at most k·#categories rows;
  Spark broadcasts it if its size at run time allows. The ``row_number() <= k`` filter
  is planned as a WindowGroupLimit, so a hot category is cut map-side.
* the fallback gives every user without a match the same 10 popular
  products: the 10 rows are one array (scalar subquery, bounded by the
  limit) exploded per user — no cartesian product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.columns import (
    WEIGHTS_TRAINING,
    interaction_score,
    top_category,
)
from cartwheel.operators.indexing import attach_index, index_table
from cartwheel.schema import CART, INTERACTION_TYPES, PURCHASE, VIEW

# 3 categories and 5 products per user, 10 fallback products
# scored 0.1, score = interest * purchases / 100, rating cap 10.
TOP_CATEGORIES = 3
TOP_PRODUCTS = 5
FALLBACK_PRODUCTS = 10
FALLBACK_SCORE = 0.1
SCORE_DIVISOR = 100
RATING_CAP = 10.0

AFFINITY = "category_affinity"
FALLBACK = "popular_fallback"

REC_COLUMNS = ["user_id", "product_id", "rec_score", "recommended_category_code", "main_brand",
               "avg_price", "recommendation_type"]


def keep_interactions(df: DataFrame, types=INTERACTION_TYPES) -> DataFrame:
    """P5: view, cart and purchase rows only (pushed to the scan)."""
    return df.filter(F.col("event_type").isin(*types))


def interaction_matrix(cleaned: DataFrame, weights=WEIGHTS_TRAINING, cap: float = RATING_CAP,
                       types=INTERACTION_TYPES, users: DataFrame | None = None,
                       prods: DataFrame | None = None, keep_ids: bool = False) -> DataFrame:
    """Per (user_idx, product_idx) the capped sum of weights and the
    interaction count. Indices come from the whole table (M1), or from the
    given index tables; ``keep_ids`` also returns the original ids."""
    users = index_table(cleaned, "user_id", "user_idx") if users is None else users
    prods = index_table(cleaned, "product_id", "product_idx") if prods is None else prods
    pairs = keep_interactions(cleaned, types).groupBy("user_id", "product_id").agg(
        F.sum(interaction_score(weights)).alias("rating"),
        F.count(F.lit(1)).alias("interaction_count"))
    pairs = attach_index(pairs, users, "user_id", "user_idx")
    pairs = attach_index(pairs, prods, "product_id", "product_idx")
    return pairs.select(
        *(["user_id", "product_id"] if keep_ids else []), "user_idx", "product_idx",
        F.least(F.col("rating").cast("double"), F.lit(cap)).alias("rating"),
        "interaction_count")


def _weight(activity: DataFrame):
    """Events behind an activity row: ``event_count`` for windowed activity."""
    return F.col("event_count") if "event_count" in activity.columns else F.lit(1)


def user_product_interactions(activity: DataFrame) -> DataFrame:
    """Per (user, product) interactions and per-type counts."""
    w = _weight(activity)
    t = F.col("event_type")
    return activity.groupBy("user_id", "product_id").agg(
        F.sum(w).cast("long").alias("interaction_count"),
        F.sum(F.when(t == VIEW, w).otherwise(0)).cast("long").alias("views"),
        F.sum(F.when(t == CART, w).otherwise(0)).cast("long").alias("carts"),
        F.sum(F.when(t == PURCHASE, w).otherwise(0)).cast("long").alias("purchases"))


def category_interest(activity: DataFrame) -> DataFrame:
    """Per (user, top category) the events; NULL categories left out
    ('' is kept and becomes ``unknown``)."""
    return (activity.filter(F.col("category_code").isNotNull())
            .groupBy("user_id", top_category("category_code").alias("main_category"))
            .agg(F.sum(_weight(activity)).cast("long").alias("category_interest")))


def top_categories_per_user(interest: DataFrame, k: int = TOP_CATEGORIES) -> DataFrame:
    """The ``k`` categories of highest interest (ties by name)."""
    w = Window.partitionBy("user_id").orderBy(F.desc("category_interest"), F.asc("main_category"))
    return interest.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def best_sellers_per_category(products: DataFrame, k: int = TOP_PRODUCTS) -> DataFrame:
    """Products that sold (purchases > 0), cut to the ``k`` best per category."""
    p = products.filter(F.col("total_purchases") > 0).select(
        "product_id", "total_purchases", "avg_price", "main_category_code", "main_brand")
    w = Window.partitionBy("main_category_code").orderBy(F.desc("total_purchases"),
                                                         F.asc("product_id"))
    return p.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k).drop("_r")


def category_affinity(activity: DataFrame, products: DataFrame, k_categories: int = TOP_CATEGORIES,
                      k_products: int = TOP_PRODUCTS) -> DataFrame:
    """Category-affinity recommendations (J3 + W3), flat schema."""
    top = top_categories_per_user(category_interest(activity), k_categories)
    side = best_sellers_per_category(products, k_products)
    cand = top.join(side, top["main_category"] == side["main_category_code"], "inner").select(
        "user_id", "product_id",
        (F.col("category_interest") * F.col("total_purchases") / F.lit(SCORE_DIVISOR))
        .cast("double").alias("rec_score"),
        F.col("main_category").alias("recommended_category_code"), "main_brand", "avg_price")
    w = Window.partitionBy("user_id").orderBy(F.desc("rec_score"), F.asc("product_id"))
    return (cand.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k_products)
            .drop("_r").withColumn("recommendation_type", F.lit(AFFINITY)))


def popular_list(products: DataFrame, k: int = FALLBACK_PRODUCTS, score: float = FALLBACK_SCORE):
    """Scalar-subquery column: array of the ``k`` most purchased products as
    recommendations (structs of REC_COLUMNS without the user)."""
    top = products.select("product_id", "total_purchases", "avg_price", "main_category_code",
                          "main_brand").orderBy(F.desc("total_purchases"), F.asc("product_id"))
    item = F.struct("product_id", F.lit(score).cast("double").alias("rec_score"),
                    F.col("main_category_code").alias("recommended_category_code"), "main_brand", "avg_price",
                    F.lit(FALLBACK).alias("recommendation_type"))
    rows = F.sort_array(F.collect_list(F.struct((-F.col("total_purchases")).alias("_n"), "product_id",
                                                item.alias("item"))))
    return top.limit(k).agg(F.transform(rows, lambda x: x["item"]).alias("items")).scalar()


def popular_fallback(users: DataFrame, products: DataFrame, k: int = FALLBACK_PRODUCTS,
                     score: float = FALLBACK_SCORE) -> DataFrame:
    """R10 core: every given user gets the ``k`` most purchased products."""
    return users.select("user_id", F.inline(popular_list(products, k, score))).select(*REC_COLUMNS)


def recommend(activity: DataFrame, products: DataFrame, fallback: str = "per_user",
              k_categories: int = TOP_CATEGORIES, k_products: int = TOP_PRODUCTS,
              k_fallback: int = FALLBACK_PRODUCTS) -> DataFrame:
    """R9 + R10: affinity rows, plus popular products for users without any.

    ``fallback="per_user"`` serves every user left without a match;
    ``"all_or_nothing"`` (the original behaviour) serves all users only when
    no user matched; ``"none"`` disables the fallback.
    """
    recs = category_affinity(activity, products, k_categories, k_products)
    if fallback == "none":
        return recs.select(*REC_COLUMNS)
    users = activity.filter(F.col("user_id").isNotNull()).select("user_id").distinct()
    if fallback == "per_user":
        # One join serves both kinds of user, so the matches are computed once;
        # the NULL user, who gets no fallback, keeps own matches (full outer).
        own = F.array(F.struct(*REC_COLUMNS[1:]))
        met = users.join(recs, "user_id", "full_outer").withColumn("_popular", popular_list(products, k_fallback))
        return met.select("user_id", F.inline(F.when(F.col("recommendation_type").isNull(), F.col("_popular"))
                                              .otherwise(own))).select(*REC_COLUMNS)
    if fallback != "all_or_nothing":
        raise ValueError(f"unknown fallback {fallback!r}")
    lonely = users.filter(recs.agg(F.count(F.lit(1))).scalar() == 0)
    fb = popular_fallback(lonely, products, k_fallback)
    return recs.select(*REC_COLUMNS).unionByName(fb.select(*REC_COLUMNS))


def distinct_users(df: DataFrame, key: str = "user_id") -> DataFrame:
    """Distinct user keys."""
    return df.select(key).distinct()
