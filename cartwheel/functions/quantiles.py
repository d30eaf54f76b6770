"""Exact discrete quantiles without one reducer for all distinct values.

Equal values are counted first (a hash aggregation, combined map-side). An
order-preserving bucket of the value's logarithm — a fixed number of buckets,
about 3 % wide — narrows each quantile down: only the counts per bucket are
accumulated in one task, then the distinct values of the one bucket that
holds the rank are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets per unit of the natural logarithm, and a shift that
# makes the logarithm of every positive double positive.
STEPS = 32
SHIFT = 800


def _bucket(x: Column) -> Column:
    """Bucket number that never falls when ``x`` rises."""
    size = F.floor((F.log(F.abs(x)) + SHIFT) * STEPS)
    return F.when(x > 0, size).when(x < 0, -size).otherwise(F.lit(0)).cast("long")


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], weight: str | None = None) -> DataFrame:
    """One row ``q``: array of the smallest values whose share of rows at or
    below them reaches each probability (NULLs left out; NULLs in the array
    when there is no value). A row counts ``weight`` times."""
    x = F.col(col).cast("double")
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = (df.filter(x.isNotNull()).groupBy(x.alias("_x")).agg(n.alias("_n"))
              .withColumn("_b", _bucket(F.col("_x"))))
    buckets = counts.groupBy("_b").agg(F.sum("_n").alias("_n"))
    upto = F.sum("_n").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("_n").over(Window.partitionBy())
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p"))
                                 for i, p in enumerate(probs)]))
    rank = F.greatest(F.lit(1), F.ceil(F.col("w.p") * F.col("_total")))
    held = (buckets.withColumn("_upto", upto).withColumn("_total", total)
            .withColumn("w", wanted).withColumn("_rank", rank)
            .filter((F.col("_upto") - F.col("_n") < F.col("_rank"))
                    & (F.col("_rank") <= F.col("_upto")))
            .select("_b", F.col("w.i").alias("_i"),
                    (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_rank")))
    inside = F.sum("_n").over(Window.partitionBy("_i").orderBy("_x")
                              .rowsBetween(Window.unboundedPreceding, 0))
    found = (counts.join(held, "_b").withColumn("_upto", inside)
             .filter((F.col("_upto") - F.col("_n") < F.col("_rank"))
                     & (F.col("_rank") <= F.col("_upto"))))
    return found.agg(F.array(*[F.max(F.when(F.col("_i") == i, F.col("_x")))
                               for i in range(len(probs))]).alias("q"))


def quantiles(df: DataFrame, col: str, probs: Sequence[float], rel_error: float) -> DataFrame:
    """``exact_quantiles`` for ``rel_error`` 0, else the sketch of that accuracy."""
    if rel_error <= 0:
        return exact_quantiles(df, col, probs)
    accuracy = max(1, int(round(1.0 / rel_error)))
    return df.agg(F.percentile_approx(F.col(col), list(probs), accuracy).alias("q"))
