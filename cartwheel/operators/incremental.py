"""User aggregates updated with a new period without a full rescan.

State = two tables, both mergeable:

* ``stats``: one row per user with counts, sums, min and max — merged by a
  full outer join that adds/min/maxes the columns;
* ``keys``: distinct (user, kind, key) rows for the exact distinct counts
  (active days, products, categories, brands, sessions) — merged by union
  + distinct, never collected into per-user arrays.

``finalize`` turns the state into the aggregates; merging the states of two
periods gives exactly the aggregates of the whole data. ``save_state`` and
``load_state`` keep a state as a run snapshot between periods.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import count_type, is_type
from cartwheel.functions.sizing import materialize
from cartwheel.schema import CART, PURCHASE, REMOVE, VIEW
from cartwheel.sources import snapshots

SUMS = ["total_events", "views", "carts", "purchases", "removes", "monetary", "price_sum",
        "price_n"]
DISTINCT_KINDS = ["active_days", "unique_products", "unique_categories", "unique_brands",
                  "unique_sessions"]


def distinct_values():
    """Column of each distinct kind (built lazily: needs an active session)."""
    return {
        "active_days": F.to_date("event_time").cast("string"),
        "unique_products": F.col("product_id").cast("string"),
        "unique_categories": F.col("category_code"),
        "unique_brands": F.col("brand"),
        "unique_sessions": F.col("user_session"),
    }


def sum_columns():
    """Mergeable columns of a user's row: SUMS, first and last time."""
    return [
        F.count(F.lit(1)).alias("total_events"),
        count_type(VIEW).alias("views"), count_type(CART).alias("carts"),
        count_type(PURCHASE).alias("purchases"), count_type(REMOVE).alias("removes"),
        F.sum(F.when(is_type(PURCHASE), F.col("price")).otherwise(F.lit(0.0))).alias("monetary"),
        F.sum("price").alias("price_sum"), F.count("price").alias("price_n"),
        F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen")]


def partial_state(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """State of one period: (stats, keys). The period's rows, which both
    read, are written once."""
    events = materialize(events.select("user_id", "event_time", "event_type", "price", "product_id",
                                       "category_code", "brand", "user_session"))
    stats = events.groupBy("user_id").agg(*sum_columns())
    items = F.array(*[F.struct(F.lit(k).alias("kind"), v.cast("string").alias("key"))
                      for k, v in distinct_values().items()])
    keys = (events.select("user_id", F.explode(items).alias("e"))
            .select("user_id", "e.kind", "e.key").filter(F.col("key").isNotNull()).distinct())
    return stats, keys


def merge_state(a: tuple[DataFrame, DataFrame], b: tuple[DataFrame, DataFrame]
                ) -> tuple[DataFrame, DataFrame]:
    """Combine two states (associative and commutative)."""
    sa, ka = a
    sb, kb = b
    # the NULL user of both sides is one user
    x = sa.alias("x").join(sb.alias("y"), F.col("x.user_id").eqNullSafe(F.col("y.user_id")), "full_outer")
    cols = [F.coalesce("x.user_id", "y.user_id").alias("user_id")]
    for c in SUMS:
        cols.append((F.coalesce(F.col(f"x.{c}"), F.lit(0)) + F.coalesce(F.col(f"y.{c}"), F.lit(0)))
                    .alias(c))
    cols.append(F.least(F.col("x.first_seen"), F.col("y.first_seen")).alias("first_seen"))
    cols.append(F.greatest(F.col("x.last_seen"), F.col("y.last_seen")).alias("last_seen"))
    stats = x.select(*cols)
    keys = ka.unionByName(kb).distinct()
    return stats, keys


def finalize(state: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Aggregates from a state: sums, mean price, first/last, distinct counts."""
    stats, keys = state
    counts = keys.groupBy("user_id").pivot("kind", list(DISTINCT_KINDS)).agg(
        F.count(F.lit(1))).withColumnRenamed("user_id", "_user")
    out = stats.join(counts, F.col("user_id").eqNullSafe(F.col("_user")), "left")
    return out.select(
        "user_id", *[c for c in SUMS if c not in ("price_sum", "price_n")],
        F.try_divide(F.col("price_sum"), F.col("price_n").cast("double")).alias("avg_price"),
        "first_seen", "last_seen",
        *[F.coalesce(F.col(k), F.lit(0)).cast("long").alias(k) for k in DISTINCT_KINDS])


def merge_user_aggregates(old: DataFrame, new: DataFrame) -> DataFrame:
    """Aggregates of ``old ∪ new`` computed from the two periods' states."""
    return finalize(merge_state(partial_state(old), partial_state(new)))


def save_state(state: tuple[DataFrame, DataFrame], base: str, run: str) -> None:
    """Store a state as one committed run of ``user_stats`` and ``user_keys``."""
    snapshots.write_run(dict(zip(("user_stats", "user_keys"), state, strict=True)), base, run)


def load_state(spark, base: str) -> tuple[DataFrame, DataFrame] | None:
    """The state of the newest committed run; None when there is none."""
    run = snapshots.latest_run(spark, base)
    return None if run is None else tuple(run[n].drop("snapshot") for n in ("user_stats", "user_keys"))


def update_state(spark, events: DataFrame, base: str, run: str) -> tuple[DataFrame, DataFrame]:
    """Merge a new period into the newest stored state, or start one from the
    period alone, and store the result as ``run``."""
    old, new = load_state(spark, base), partial_state(events)
    save_state(new if old is None else merge_state(old, new), base, run)
    return load_state(spark, base)
