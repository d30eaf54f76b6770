"""Period state of bounded size, made of mergeable sketches.

The exact state (``incremental``) keeps each distinct (user, key) pair, and
exact price bounds need the raw prices of every period. Here a period leaves

* ``user_sketches``: one row per user with the exact counts, sums, first and
  last time, and one HyperLogLog sketch per distinct count (at most about
  ``2 ** lg_k`` bytes each, a few bytes for a user of few events);
* ``category_sketches``: one row per top-level category with the exact sum and
  number of its prices, its earliest brand, and a KLL sketch of its prices.

Both are merged by one ``groupBy`` over the rows of any number of periods;
merging is associative and commutative, up to the sketches' error. The price
bounds and category statistics of all periods follow from the merged rows and
clean later events (``clean_events(stats=...)``) without reading earlier ones.

NULL users and NULL values: the NULL user is one user, NULL values are not
counted, as in the exact state.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import order_key
from cartwheel.operators.cleaning import QUARTILES, with_top_category
from cartwheel.operators.incremental import DISTINCT_KINDS, SUMS, distinct_values, sum_columns
from cartwheel.sources import snapshots

LG_K = 12  # relative standard error of a distinct count: 1.04 / sqrt(2 ** 12) = 1.6 %
KLL_K = 800  # normalised rank error of a quantile: under 0.5 %

State = tuple[DataFrame, DataFrame]


def user_sketches(events: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """One row per user: sums, first and last time, a sketch per distinct kind."""
    values = distinct_values()
    return events.groupBy("user_id").agg(
        *sum_columns(), *[F.hll_sketch_agg(values[k].cast("string"), lg_k).alias(k) for k in DISTINCT_KINDS])


def category_sketches(raw: DataFrame, kll_k: int = KLL_K) -> DataFrame:
    """One row per top-level category of the raw events: ``price_sum``,
    ``price_n``, the earliest event's key and brand, a sketch of the prices."""
    price = F.col("price").cast("double")
    brand = F.nullif(F.col("brand"), F.lit(""))
    return with_top_category(raw).groupBy("category_code").agg(
        F.sum(price).alias("price_sum"), F.count(price).alias("price_n"),
        F.min(F.struct(order_key().alias("key"), brand.alias("brand"))).alias("first"),
        F.kll_sketch_agg_double(price, kll_k).alias("prices"))


def partial_state(cleaned: DataFrame, raw: DataFrame) -> State:
    """State of one period: users from its cleaned, prices from its raw events."""
    return user_sketches(cleaned), category_sketches(raw)


def merge_states(states: list[State], lg_k: int = LG_K, kll_k: int = KLL_K) -> State:
    """The state of all given periods together: one aggregation per table."""
    users = reduce(DataFrame.unionByName, [s[0] for s in states])
    categories = reduce(DataFrame.unionByName, [s[1] for s in states])
    return (
        users.groupBy("user_id").agg(
            *[F.sum(c).alias(c) for c in SUMS], F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"), *[F.hll_union_agg(k).alias(k) for k in DISTINCT_KINDS]),
        categories.groupBy("category_code").agg(
            F.sum("price_sum").alias("price_sum"), F.sum("price_n").alias("price_n"),
            F.min("first").alias("first"), F.kll_merge_agg_double("prices", kll_k).alias("prices")))


def user_estimates(users: DataFrame) -> DataFrame:
    """The columns of ``incremental.finalize``; distinct counts are estimates."""
    return users.select(
        "user_id", *[c for c in SUMS if c not in ("price_sum", "price_n")],
        F.try_divide(F.col("price_sum"), F.col("price_n").cast("double")).alias("avg_price"),
        "first_seen", "last_seen", *[F.hll_sketch_estimate(k).alias(k) for k in DISTINCT_KINDS])


def distinct_totals(users: DataFrame) -> DataFrame:
    """One row: estimated distinct values of each kind over all users."""
    return users.agg(*[F.hll_sketch_estimate(F.hll_union_agg(k)).alias(k) for k in DISTINCT_KINDS])


def _quantile(sketch: Column, q: float) -> Column:
    """A quantile of a sketch; NULL when it holds no price."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(q)))


def cleaning_statistics(categories: DataFrame, kll_k: int = KLL_K) -> DataFrame:
    """``cleaning.cleaning_statistics`` of all merged periods: category means and
    brands exact, quartiles within the sketch's rank error."""
    merged = F.col("merged")
    bounds = categories.agg(F.kll_merge_agg_double("prices", kll_k).alias("merged")).select(
        F.array(*[_quantile(merged, q) for q in QUARTILES])).scalar()
    return categories.select(
        "category_code", F.try_divide(F.col("price_sum"), F.col("price_n").cast("double")).alias("avg_cat_price"),
        F.col("first.brand").alias("first_brand"), bounds[0].alias("q1"), bounds[1].alias("q3"))


def save_state(state: State, base: str, run: str) -> None:
    """Store a state as one committed run of both tables."""
    snapshots.write_run(dict(zip(("user_sketches", "category_sketches"), state, strict=True)), base, run)


def load_state(spark, base: str) -> State | None:
    """The state of the newest committed run; None when there is none."""
    run = snapshots.latest_run(spark, base)
    return None if run is None else tuple(run[n].drop("snapshot") for n in ("user_sketches", "category_sketches"))


def update_state(spark, cleaned: DataFrame, raw: DataFrame, base: str, run: str) -> State:
    """Merge a new period into the newest stored state and store the result."""
    old, new = load_state(spark, base), partial_state(cleaned, raw)
    save_state(new if old is None else merge_states([old, new]), base, run)
    return load_state(spark, base)
