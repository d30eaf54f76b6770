"""Items bought/seen together — support, confidence, lift, itemsets, rules.

Items below the minimum count are dropped first (no set with such an item
can reach it), so the equi-join on the basket meets frequent items only; each
pair is counted once, smaller item first, and both rules follow from it. Longer
sets grow level by level from the occurrences of frequent sets. The results are
exact for every set in at least ``min_count`` baskets, and nothing is collected
per basket or on the driver.

Memory: the number of tasks follows from the rows and from the pairs to be made
(``ROWS_PER_TASK``, ``PAIRS_PER_TASK``), so what a task holds does not grow with
the input; the items of a basket of more than ``CHUNK`` meet its other items in
as many parts, in different tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.sizing import materialize

ROWS_PER_TASK = 1 << 20
PAIRS_PER_TASK = 1 << 20
CHUNK = 1024


def _tasks(df: DataFrame, n: int, per_task: int) -> int:
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-n // per_task))


def _basket_rows(df: DataFrame, basket: str, item: str) -> DataFrame:
    """Distinct (basket, item) as ``_b, _i``, without NULLs."""
    rows = (df.filter(F.col(basket).isNotNull() & F.col(item).isNotNull())
            .select(F.col(basket).alias("_b"), F.col(item).alias("_i")))
    return materialize(rows.repartition(_tasks(df, df.count(), ROWS_PER_TASK), "_b", "_i").distinct())


def _item_counts(rows: DataFrame, min_count: int) -> DataFrame:
    return materialize(rows.groupBy("_i").agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") >= min_count))


def _pairs(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Every pair of ``items`` (column ``_i``) in every basket: ``_b, a, b`` with
    a < b."""
    size = F.count(F.lit(1)).over(Window.partitionBy("_b"))
    kept = materialize(rows.join(items.select("_i"), "_i", "left_semi").withColumn("_parts", F.ceil(size / CHUNK))
                       .withColumn("_size", size))
    made = kept.agg((F.sum(F.col("_size") - 1) / 2).cast("long")).first()[0] or 0
    a = kept.select("_b", F.col("_i").alias("a"), F.pmod(F.xxhash64("_i"), F.col("_parts")).alias("_part"))
    b = kept.select("_b", F.col("_i").alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))
                    .alias("_part"))
    n = _tasks(rows, made, PAIRS_PER_TASK)
    if n > rows.sparkSession.sparkContext.defaultParallelism:  # fewer pairs are left to Spark
        a, b = (x.repartition(n, "_b", "_part") for x in (a, b))
    return (a.join(b, ["_b", "_part"])
            .filter(F.col("a") < F.col("b")).select("_b", "a", "b"))


def _counted(sets: DataFrame, keys: list[str], min_count: int) -> DataFrame:
    return sets.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") >= min_count)


def affinity_pairs(df: DataFrame, basket: str, item: str, min_count: int = 2,
                   min_confidence: float = 0.0) -> DataFrame:
    """Rules a → b between single items seen together in ≥ ``min_count``
    baskets: pair count, support, confidence, lift."""
    rows = _basket_rows(df, basket, item)
    n = rows.agg(F.count_distinct("_b").alias("n")).scalar()
    counts = _item_counts(rows, min_count)
    pairs = materialize(_counted(_pairs(rows, counts), ["a", "b"], min_count)).withColumnRenamed("count", "pair_count")
    for x in ("a", "b"):
        pairs = pairs.join(counts.select(F.col("_i").alias(x), F.col("_c").alias(f"c{x}")), x)
    sides = F.explode(F.array(
        F.struct(F.col("a").alias("x"), F.col("ca").alias("cx"), F.col("b").alias("y"), F.col("cb").alias("cy")),
        F.struct(F.col("b").alias("x"), F.col("cb").alias("cx"), F.col("a").alias("y"), F.col("ca").alias("cy"))))
    rules = pairs.select("pair_count", sides.alias("r")).select(
        F.col("r.x").alias("antecedent"), F.col("r.y").alias("consequent"), "pair_count",
        (F.col("pair_count") / n).alias("support"),
        (F.col("pair_count") / F.col("r.cx")).alias("confidence"),
        (F.col("pair_count") / F.col("r.cx") / (F.col("r.cy") / n)).alias("lift"))
    return rules.filter(F.col("confidence") >= min_confidence)


def _itemsets(df: DataFrame, basket: str, item: str, min_count: int, max_size: int):
    """(distinct rows, frequent sets). Level k + 1 comes from the occurrences of
    frequent sets of k items and those of frequent pairs that start with a set's
    last item: every frequent set of k + 1 items ends in such a pair."""
    rows = _basket_rows(df, basket, item)
    counts = _item_counts(rows, min_count)
    levels = [counts.select(F.array("_i").alias("items"), F.col("_c").alias("count"))]
    if max_size > 1:
        found = materialize(_counted(_pairs(rows, counts), ["a", "b"], min_count))
        levels.append(_level(found, ["a", "b"]))
    if max_size > 2:
        # Only items of a frequent pair can be in a longer set.
        paired = found.select(F.explode(F.array("a", "b")).alias("_i")).distinct()
        links = materialize(_pairs(rows, paired).join(found, ["a", "b"], "left_semi"))
        held, keys = links.select("_b", F.col("a").alias("_1"), F.col("b").alias("_2")), ["_1", "_2"]
    for k in range(3, max_size + 1):
        step = links.select("_b", F.col("a").alias(keys[-1]), F.col("b").alias(f"_{k}"))
        longer, keys = held.join(step, ["_b", keys[-1]]), [*keys, f"_{k}"]
        found = materialize(_counted(longer, keys, min_count))
        levels.append(_level(found, keys))
        if k < max_size:
            held = materialize(longer.join(found, keys, "left_semi").select("_b", *keys))
    return rows, reduce(DataFrame.unionByName, levels)


def _level(found: DataFrame, keys: list[str]) -> DataFrame:
    return found.select(F.array(*keys).alias("items"), "count")


def frequent_itemsets(df: DataFrame, basket: str, item: str, min_count: int = 2, max_size: int = 3) -> DataFrame:
    """Every set of up to ``max_size`` items in ``min_count`` baskets or
    more: items (ascending), size, count. Level by level over joins on the
    basket; unlike FP-growth its depth is bounded by ``max_size``, so two
    equal baskets of many items give no exponential result."""
    return _itemsets(df, basket, item, min_count, max_size)[1].select("items", F.size("items").alias("size"), "count")


def association_rules(df: DataFrame, basket: str, item: str, min_count: int = 2, max_size: int = 3,
                      min_confidence: float = 0.0) -> DataFrame:
    """Rules from one or more antecedents to one item, of the frequent
    itemsets: antecedent (array), consequent, count, support, confidence, lift."""
    rows, sets = _itemsets(df, basket, item, min_count, max_size)
    n = rows.agg(F.count_distinct("_b").alias("n")).scalar()
    sets = materialize(sets)  # three readers
    rules = sets.filter(F.size("items") > 1).select(
        "items", F.explode("items").alias("consequent"), F.col("count")).withColumn(
        "antecedent", F.array_remove("items", F.col("consequent")))
    base = sets.select(F.col("items").alias("antecedent"), F.col("count").alias("_from"))
    single = sets.filter(F.size("items") == 1).select(F.col("items")[0].alias("consequent"),
                                                      F.col("count").alias("_to"))
    out = rules.join(base, "antecedent").join(single, "consequent").select(
        "antecedent", "consequent", "count", (F.col("count") / n).alias("support"),
        (F.col("count") / F.col("_from")).alias("confidence"),
        (F.col("count") / F.col("_from") / (F.col("_to") / n)).alias("lift"))
    return out.filter(F.col("confidence") >= min_confidence)
