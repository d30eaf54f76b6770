"""Collaborative filtering with implicit ALS.

* M8 split: a hash of (seed, user, product) decides train/test, so the split
  does not depend on partitioning or on re-execution after a lost task
  (``randomSplit`` is kept as an option for compatibility).
* M11 top-N: ``recommendForUserSubset`` (blocked cross product of factor
  matrices + per-user top-k inside MLlib) on the active users only, or
  ``top_n_pruned``, which stops each user at the norm where no item can enter.
* M12 maps indices back to the original ids with two joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.ranking import group_row_number
from cartwheel.functions.sizing import materialize

# Rank 50, 15 iterations, regularisation 0.1, alpha 1.0,
# non-negative, implicit preferences, cold-start "drop", seed 42, 80/20 split,
# 10 recommendations per user.
RANK, MAX_ITER, REG, ALPHA, SEED = 50, 15, 0.1, 1.0, 42
TRAIN_FRACTION = 0.8
TOP_N = 10


def hash_fraction(*cols: str, seed: int = SEED):
    """Uniform [0, 1) number from the md5 of the seed and the given columns."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols])
    head = F.substring(F.md5(text), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(4294967296.0)


def train_test_split(df: DataFrame, cols=("user_id", "product_id"),
                     train_fraction: float = TRAIN_FRACTION, seed: int = SEED,
                     method: str = "hash") -> tuple[DataFrame, DataFrame]:
    """80/20 split; ``method="random"`` uses ``randomSplit`` like the original."""
    if method == "random":
        a, b = df.randomSplit([train_fraction, 1 - train_fraction], seed=seed)
        return a, b
    u = hash_fraction(*cols, seed=seed)
    return df.filter(u < train_fraction), df.filter(u >= train_fraction)


def split_flags(df: DataFrame, cols=("user_id", "product_id"),
                train_fraction: float = TRAIN_FRACTION, seed: int = SEED) -> DataFrame:
    """M8 as a column: ``is_train`` for every row."""
    return df.withColumn("is_train", hash_fraction(*cols, seed=seed) < train_fraction)


def als(rank: int = RANK, max_iter: int = MAX_ITER, reg: float = REG, alpha: float = ALPHA,
        seed: int = SEED, user: str = "user_idx", item: str = "product_idx",
        rating: str = "rating") -> ALS:
    return ALS(userCol=user, itemCol=item, ratingCol=rating, nonnegative=True,
               implicitPrefs=True, rank=rank, maxIter=max_iter, regParam=reg, alpha=alpha,
               coldStartStrategy="drop", seed=seed)


def fit_als(train: DataFrame, **params) -> ALSModel:
    """M9: implicit ALS (indices must fit in int)."""
    data = train.select(F.col("user_idx").cast("int").alias("user_idx"),
                        F.col("product_idx").cast("int").alias("product_idx"),
                        F.col("rating").cast("float").alias("rating"))
    return als(**params).fit(data)


def predictions(model: ALSModel, test: DataFrame) -> DataFrame:
    data = test.select(F.col("user_idx").cast("int").alias("user_idx"),
                       F.col("product_idx").cast("int").alias("product_idx"),
                       F.col("rating").cast("double").alias("rating"))
    return model.transform(data).filter(F.col("prediction").isNotNull())


def rmse_frame(pred: DataFrame) -> DataFrame:
    """M10 as a plan: RMSE of prediction against rating (one aggregation)."""
    err = F.col("prediction").cast("double") - F.col("rating").cast("double")
    return pred.agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.count(F.lit(1)).alias("n_test"))


def rmse(pred: DataFrame) -> float:
    """M10 through MLlib's evaluator (an action)."""
    return RegressionEvaluator(metricName="rmse", labelCol="rating",
                               predictionCol="prediction").evaluate(pred)


def top_n(model: ALSModel, interactions: DataFrame, n: int = TOP_N) -> DataFrame:
    """``n`` recommendations for every user with interactions."""
    users = interactions.select(F.col("user_idx").cast("int").alias("user_idx")).distinct()
    return model.recommendForUserSubset(users, n)


def top_n_pruned(model: ALSModel, interactions: DataFrame, n: int = TOP_N, chunk_items: int = 1 << 18,
                 block_items: int = 1024, met=None) -> DataFrame:
    """M11 without the cross product: user_idx, rank, product_idx, score, exact.

    Items are numbered by falling norm. By the Cauchy-Schwarz inequality no item
    of a block scores more than the user's norm times the block's largest, so a
    user stops at the first block for which this lies below the n-th best score.
    Items reach the users' tasks in chunks of ``chunk_items`` (at the default
    rank about 50 MB, whatever the catalog); after each chunk only the users that
    have not stopped go on, and what they hold is written. Ties go to the smaller
    product. ``met``, an accumulator, gets the pairs scored.
    """
    spark = interactions.sparkSession
    users = interactions.select(F.col("user_idx").cast("int").alias("id")).distinct()
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    items = materialize(group_row_number(
        model.itemFactors.withColumn("norm", norm), [], [F.desc("norm"), F.col("id")], "pos")
        .withColumn("chunk", F.floor((F.col("pos") - 1) / chunk_items)))
    chunks = -(-items.count() // chunk_items)
    schema = "id int, features array<float>, best array<int>, scores array<double>, done boolean"
    state = model.userFactors.join(users, "id").select(
        "id", "features", F.array().cast("array<int>").alias("best"), F.array().cast("array<double>").alias("scores"))
    finished = None

    def step(shared):
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, norms, factors = shared.value
            for pdf in frames:
                u = np.array(pdf["features"].tolist(), np.float64).reshape(len(pdf), -1)
                size = np.sqrt((u ** 2).sum(axis=1)) * (1 + 1e-9)
                best = np.full((len(pdf), n), np.iinfo(np.int32).max, np.int64)
                scores = np.full((len(pdf), n), -np.inf)
                for i, (b, s) in enumerate(zip(pdf["best"], pdf["scores"], strict=True)):
                    best[i, :len(b)], scores[i, :len(s)] = b, s
                done = np.zeros(len(pdf), bool)
                for at in range(0, len(ids), block_items):
                    done |= size * norms[at] < scores[:, -1]
                    open_ = np.flatnonzero(~done)
                    if not len(open_):
                        break
                    block = slice(at, at + block_items)
                    got = u[open_] @ factors[block].T
                    if met is not None:
                        met.add(got.size)
                    s = np.concatenate([scores[open_], got], axis=1)
                    b = np.concatenate([best[open_], np.broadcast_to(ids[block], got.shape)], axis=1)
                    order = np.lexsort((b, -s), axis=1)[:, :n]
                    scores[open_] = np.take_along_axis(s, order, axis=1)
                    best[open_] = np.take_along_axis(b, order, axis=1)
                real = np.isfinite(scores)
                yield pd.DataFrame({"id": pdf["id"], "features": pdf["features"],
                                    "best": [list(b[r]) for b, r in zip(best, real, strict=True)],
                                    "scores": [list(s[r]) for s, r in zip(scores, real, strict=True)], "done": done})

        return run

    for chunk in range(chunks):
        part = items.filter(F.col("chunk") == chunk).select("pos", "id", "norm", "features").toPandas().sort_values("pos")
        shared = spark.sparkContext.broadcast((
            part["id"].to_numpy(np.int64), part["norm"].to_numpy(),
            np.array(part["features"].tolist(), np.float64)))  # bounded by chunk_items
        after = materialize(state.mapInPandas(step(shared), schema))
        last = chunk == chunks - 1
        ended = (after if last else after.filter("done")).select("id", "best", "scores")
        finished = ended if finished is None else finished.unionByName(ended)
        state = after.filter("NOT done").select("id", "features", "best", "scores")
        if not last and state.isEmpty():
            break
    if finished is None:
        return spark.createDataFrame([], "user_idx int, rank int, product_idx int, score double")
    return finished.select(F.col("id").alias("user_idx"), F.posexplode(F.arrays_zip("best", "scores")).alias("_p", "_r")).select(
        "user_idx", (F.col("_p") + 1).alias("rank"), F.col("_r.best").alias("product_idx"),
        F.col("_r.scores").alias("score"))


def recs_to_ids(recs: DataFrame, user_index: DataFrame, product_index: DataFrame) -> DataFrame:
    """Flat ``user_id, product_id, rank, score`` from MLlib's nested output."""
    flat = recs.select("user_idx", F.posexplode("recommendations").alias("pos", "r")).select(
        F.col("user_idx").cast("double").alias("user_idx"),
        F.col("r.product_idx").cast("double").alias("product_idx"),
        (F.col("pos") + 1).alias("rank"), F.col("r.rating").cast("double").alias("score"))
    return (flat.join(user_index.select("user_id", "user_idx"), "user_idx", "left")
            .join(product_index.select("product_id", "product_idx"), "product_idx", "left")
            .select("user_id", "product_id", "rank", "score", "user_idx", "product_idx"))


def top_n_properties(recs: DataFrame) -> DataFrame:
    """M11 property columns: at most n items, no repeats, scores descending."""
    items = F.col("recommendations")
    scores = F.transform(items, lambda r: r["rating"])
    ids = F.transform(items, lambda r: r["product_idx"])
    desc = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.size(scores) - 1, F.lit(1))),
        F.lit(True),
        lambda ok, i: ok & ((i >= F.size(scores)) | (F.element_at(scores, i)
                                                    >= F.element_at(scores, i + 1))))
    return recs.select(
        "user_idx", F.size(items).alias("n_items"),
        (F.size(F.array_distinct(ids)) == F.size(ids)).alias("no_repeats"),
        desc.alias("descending"))
