"""X6 hybrid scores and X7 segment-adjusted recommendations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Default blend weights (collaborative, content, popularity).
DEFAULT_WEIGHTS = {"collaborative": 0.5, "content": 0.3, "popularity": 0.2}


def min_max(df: DataFrame, col: str, out: str) -> DataFrame:
    """Scale ``col`` to [0, 1] over the whole table (constant column → 1)."""
    r = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("r")).scalar()
    lo, hi = r["lo"], r["hi"]
    return df.withColumn(out, F.when(hi > lo, (F.col(col) - lo) / (hi - lo)).otherwise(F.lit(1.0)))


def hybrid_scores(sources: Mapping[str, DataFrame], weights: Mapping[str, float] | None = None,
                  keys=("user_id", "product_id"), score: str = "score") -> DataFrame:
    """Blend per-source scores: each source (keys, ``score``) is min-max
    scaled, sources are full-outer-joined on the keys (missing → 0) and
    summed with their weights."""
    weights = dict(weights or DEFAULT_WEIGHTS)
    k = list(keys)
    merged = None
    for name, df in sources.items():
        best = df.groupBy(*k).agg(F.max(score).alias(score))
        scaled = min_max(best, score, name).select(*k, name)
        merged = scaled if merged is None else merged.join(scaled, k, "full_outer")
    total = None
    for name in sources:
        term = F.coalesce(F.col(name), F.lit(0.0)) * F.lit(float(weights.get(name, 0.0)))
        total = term if total is None else total + term
    return merged.select(*k, *[F.coalesce(F.col(n), F.lit(0.0)).alias(n) for n in sources],
                         total.alias("hybrid_score"))


def segment_category_lift(events: DataFrame, segments: DataFrame, label: str = "segment_id",
                          category: str = "category_code") -> DataFrame:
    """Per (segment, category): share of the segment's events in the category
    over the category's share of all events."""
    e = events.join(segments.select("user_id", label), "user_id")
    per = e.groupBy(label, category).agg(F.count(F.lit(1)).alias("n"))
    seg_tot = per.groupBy(label).agg(F.sum("n").alias("seg_n"))
    cat_tot = per.groupBy(category).agg(F.sum("n").alias("cat_n"))
    all_n = per.agg(F.sum("n").alias("t")).scalar()
    return (per.join(seg_tot, label).join(cat_tot, category)
            .select(label, category,
                    ((F.col("n") / F.col("seg_n")) / (F.col("cat_n") / all_n)).alias("lift")))


def segment_adjusted_recs(recs: DataFrame, segments: DataFrame, lift: DataFrame,
                          label: str = "segment_id",
                          category: str = "recommended_category_code") -> DataFrame:
    """rec_score × lift of (user's segment, recommended category);
    lift 1 when unknown. The lift table is size-checked before broadcast."""
    r = recs.join(segments.select("user_id", label), "user_id", "left")
    lt = lift.select(label, F.col("category_code").alias(category), "lift")
    r = r.join(lt, [label, category], "left")
    return r.withColumn("adjusted_score",
                        F.col("rec_score") * F.coalesce(F.col("lift"), F.lit(1.0)))
