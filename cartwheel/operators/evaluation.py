"""Ranking quality of recommendations on held-out interactions.

Per user with at least one relevant item: precision@k, recall@k, hit@k and
NDCG@k (binary gains, log2 discount); then their means. Everything is a
join of the ranked list with the relevant set on (user, product) — no
per-user arrays are built. ``cross_validate`` repeats this over rolling time
folds and a grid of recommenders.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.sizing import materialize
from cartwheel.operators import products
from cartwheel.schema import CART, PURCHASE

TOP_K = 5


def rank_recommendations(recs: DataFrame, score: str = "rec_score") -> DataFrame:
    w = Window.partitionBy("user_id").orderBy(F.desc(score), F.asc("product_id"))
    return recs.withColumn("rank", F.row_number().over(w))


def per_user_metrics(recs: DataFrame, relevant: DataFrame, k: int = TOP_K,
                     score: str = "rec_score") -> DataFrame:
    """``user_id, hits, n_relevant, precision, recall, hit, ndcg``."""
    ranked = rank_recommendations(recs.select("user_id", "product_id", score), score).filter(
        F.col("rank") <= k)
    rel = relevant.select("user_id", "product_id").distinct()
    n_rel = rel.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    hits = ranked.join(rel, ["user_id", "product_id"]).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("hits"),
        F.sum(F.lit(1.0) / F.log2(F.col("rank") + 1.0)).alias("dcg"))
    m = F.least(F.col("n_relevant"), F.lit(k))
    idcg = F.aggregate(F.sequence(F.lit(1), m), F.lit(0.0),
                       lambda acc, i: acc + F.lit(1.0) / F.log2(i + 1.0))
    j = n_rel.join(hits, "user_id", "left").fillna({"hits": 0, "dcg": 0.0})
    return j.select(
        "user_id", "hits", "n_relevant",
        (F.col("hits") / F.lit(float(k))).alias("precision"),
        (F.col("hits") / F.col("n_relevant")).alias("recall"),
        (F.col("hits") > 0).cast("double").alias("hit"),
        (F.col("dcg") / idcg).alias("ndcg"))


def precision_at_k(recs: DataFrame, relevant: DataFrame, k: int = TOP_K,
                   score: str = "rec_score") -> DataFrame:
    """Means over users with relevant items."""
    p = per_user_metrics(recs, relevant, k, score)
    return p.agg(F.count(F.lit(1)).alias("users"), F.avg("precision").alias("precision_at_k"),
                  F.avg("recall").alias("recall_at_k"), F.avg("hit").alias("hit_rate"),
                  F.avg("ndcg").alias("ndcg_at_k")).withColumn("k", F.lit(k))


def cross_validate(cleaned: DataFrame, activity: DataFrame, folds: Sequence[tuple[Column, Column]],
                   candidates: Mapping[str, Callable[[DataFrame, DataFrame], DataFrame]],
                   k: int = TOP_K) -> DataFrame:
    """The metrics of every candidate on every fold, and a candidate's mean
    NDCG over its folds.

    A fold is (training rows, test rows) as conditions, so that later days are
    never seen in training. Per fold the product table is built from the training
    rows and written once; a candidate maps (activity, products) to
    recommendations; carts and purchases of the test rows are relevant. The
    loop plans one job per cell of the (literal, small) grid; no row passes the
    driver. A fold without relevant rows has 0 users and NULL metrics, which the
    mean leaves out.
    """
    out = None
    for number, (train, test) in enumerate(folds):
        prods = materialize(products.product_data(cleaned.filter(train), with_index=False))
        relevant = materialize(cleaned.filter(test & F.col("event_type").isin(CART, PURCHASE))
                               .select("user_id", "product_id").distinct())
        for name, recommender in candidates.items():
            cell = precision_at_k(recommender(activity.filter(train), prods), relevant, k).select(
                F.lit(number).alias("fold"), F.lit(name).alias("candidate"), "*")
            out = cell if out is None else out.unionByName(cell)
    return out.withColumn("mean_ndcg", F.avg("ndcg_at_k").over(Window.partitionBy("candidate")))
