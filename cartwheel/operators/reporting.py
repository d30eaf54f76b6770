"""Summaries of the recommendation output (A29-A37) and catalog coverage.

The original drew eight charts with pandas/seaborn on one machine; these
operators compute the data behind each chart as Spark aggregations.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 50 histogram bins, top-10 lists, a 200-point density grid.
HIST_BINS = 50
TOP_K = 10
KDE_GRID = 200


def _bin_index(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """1..bins equal-width bin; the last bin is closed on the right."""
    raw = F.floor((v - lo) / (hi - lo) * F.lit(float(bins))).cast("long") + 1
    return F.when(hi > lo, F.least(raw, F.lit(bins).cast("long"))).otherwise(F.lit(1).cast("long"))


def histogram(df: DataFrame, col: str, bins: int = HIST_BINS) -> DataFrame:
    """Counts of ``bins`` equal-width bins over [min, max] (NULLs
    ignored); every bin is listed, empty ones with count 0."""
    vals = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    rng = vals.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("r")).scalar()
    lo, hi = rng["lo"], rng["hi"]
    counts = vals.groupBy(_bin_index(F.col("v"), lo, hi, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
    width = (hi - lo) / F.lit(float(bins))
    all_bins = (df.sparkSession.range(1, bins + 1).select(F.col("id").alias("bin"))
                .filter(lo.isNotNull()))
    return all_bins.join(counts, "bin", "left").select(
        "bin", (lo + (F.col("bin") - 1) * width).alias("lower"),
        (lo + F.col("bin") * width).alias("upper"),
        F.coalesce(F.col("count"), F.lit(0).cast("long")).alias("count"))


def score_histogram(recs: DataFrame, bins: int = HIST_BINS) -> DataFrame:
    return histogram(recs, "rec_score", bins)


def price_histogram(recs: DataFrame, bins: int = HIST_BINS) -> DataFrame:
    return histogram(recs, "avg_price", bins)


def density(df: DataFrame, col: str, grid: int = KDE_GRID, cut: float = 0.0,
            bw_adjust: float = 1.0) -> DataFrame:
    """Gaussian kernel density on a ``grid``-point grid over
    [min - cut·h, max + cut·h], Scott bandwidth h = sd · n^(-1/5).

    Values are first reduced to (distinct value, count); the ``grid`` sums of
    kernels are one aggregation, partial in each task: no value is repeated for
    the grid points.
    """
    vals = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    st = vals.agg(F.struct(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"),
                           F.min("v").alias("lo"), F.max("v").alias("hi")).alias("s")).scalar()

    def h_of(s: str) -> Column:
        return F.col(f"{s}.sd") * F.pow(F.col(f"{s}.n").cast("double"), F.lit(-0.2)) * F.lit(bw_adjust)

    distinct = vals.groupBy("v").agg(F.count(F.lit(1)).alias("w"))
    norm = F.lit(1.0 / math.sqrt(2.0 * math.pi))
    known = distinct.withColumn("_s", st).select(
        "v", "w", F.col("_s.n").alias("n"), h_of("_s").alias("h"), F.col("_s.lo").alias("lo"), F.col("_s.hi").alias("hi"))

    def kernel(i: int) -> Column:
        z = (_grid_point(F.col("lo"), F.col("hi"), F.col("h"), cut, grid, F.lit(i)) - F.col("v")) / F.col("h")
        return F.sum(F.col("w") * F.exp(-0.5 * z * z))

    sums = known.agg(F.array(*[kernel(i) for i in range(grid)]).alias("k"), F.first("n").alias("n"),
                     F.first("h").alias("h"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    point = sums.filter(F.col("n").isNotNull()).select("*", F.posexplode("k").alias("point", "s"))
    return point.select("point", _grid_point(F.col("lo"), F.col("hi"), F.col("h"), cut, grid, F.col("point")).alias("x"),
                        (F.col("s") * norm / (F.col("n") * F.col("h"))).alias("density"))


def _grid_point(lo: Column, hi: Column, h: Column, cut: float, grid: int, i: Column) -> Column:
    start = lo - F.lit(cut) * h
    return start + i * ((hi + F.lit(cut) * h - start) / F.lit(float(grid - 1)))


def score_density(recs: DataFrame, grid: int = KDE_GRID) -> DataFrame:
    return density(recs, "rec_score", grid)


def top_counts(df: DataFrame, col: str, k: int = TOP_K, name: str = "count") -> DataFrame:
    """The ``k`` most frequent non-NULL values (ties by value)."""
    g = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
    return g.orderBy(F.desc(name), F.asc(col)).limit(k)


def top_recommended_categories(recs: DataFrame, k: int = TOP_K) -> DataFrame:
    return top_counts(recs, "recommended_category_code", k, "recommendations")


def top_recommended_brands(recs: DataFrame, k: int = TOP_K) -> DataFrame:
    return top_counts(recs, "main_brand", k, "recommendations")


def top_users_by_recs(recs: DataFrame, k: int = TOP_K) -> DataFrame:
    return top_counts(recs, "user_id", k, "recommendations")


def top_mean(df: DataFrame, key: str, value: str, k: int = TOP_K) -> DataFrame:
    """Mean of ``value`` per non-NULL ``key``, the ``k`` highest."""
    g = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.avg(value).alias(f"mean_{value}"))
    return g.orderBy(F.desc(f"mean_{value}"), F.asc(key)).limit(k)


def mean_score_by_category(recs: DataFrame, k: int = TOP_K) -> DataFrame:
    return top_mean(recs, "recommended_category_code", "rec_score", k)


def mean_score_by_brand(recs: DataFrame, k: int = TOP_K) -> DataFrame:
    return top_mean(recs, "main_brand", "rec_score", k)


def score_vs_price(recs: DataFrame) -> DataFrame:
    """Pearson correlation and least-squares line of score on price."""
    pairs = recs.filter(F.col("avg_price").isNotNull() & F.col("rec_score").isNotNull())
    return pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.corr("avg_price", "rec_score").alias("correlation"),
        F.regr_slope("rec_score", "avg_price").alias("slope"),
        F.regr_intercept("rec_score", "avg_price").alias("intercept"))


def catalog_coverage(recs: DataFrame, products: DataFrame) -> DataFrame:
    """Percent of catalog products that appear in the recommendations."""
    n_rec = recs.agg(F.count_distinct("product_id").alias("n")).scalar()
    return products.agg(F.count_distinct("product_id").alias("catalog_products")).select(
        n_rec.alias("recommended_products"), "catalog_products",
        F.try_divide(n_rec * 100.0, F.col("catalog_products")).alias("coverage_pct"))
