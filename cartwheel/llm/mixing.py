"""Mixing sources to target weights by hierarchical budgeting.

The leaves are the sources under a domain -> language -> source tree. A node
hands its token budget to its children in proportion to their weights; a
child never gets more than its subtree holds in ``max_epochs`` passes. What
one child cannot use goes to its siblings, again by weight, and only what all
of them cannot use reaches the node's own siblings, because a subtree's
capacity limits what its parent hands down. Budgets are integers: with the
children ordered by capacity per weight, the ones filled to capacity are a
prefix, found from running sums, and the rest share what is left.

A leaf with budget b and t tokens gives b // t whole epochs and a prefix of
one more: epoch e orders the leaf's documents by md5(seed:e:id) and takes
documents until the remainder of the budget is reached (the document that
reaches it is taken whole). The order's first two hexadecimal digits split a
leaf into 256 ranges, the next two each of them into 256; ranges are summed
first, and only the range in which the budget ends is split further and then
ordered row by row, so a leaf with a third of all rows is never sorted in one
task.

Rows: tokens are words parted by ASCII white space; null text has none; null
or unknown languages, sources and domains are nodes of their own with the
default weight; rows with the same id and text stand or fall together; an
empty table, or a budget of zero, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import WORD, stage

LEVELS = ("domain", "lang", "source")
# Target weights of the registered query (fixed values).
WEIGHTS: dict[str, dict[str, int]] = {
    "domain": {"web": 5, "reference": 3, "curated": 2},
    "lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
    "source": {},
}
DEFAULT_WEIGHT = 1
RANGE_DIGITS = (2, 4)  # hexadecimal digits of the order that name a range
UNKNOWN = "unknown"


def domain_of(source: Column) -> Column:
    """The registered query's domains: the first hexadecimal digit of
    md5(source) puts a source among web (0-7), reference (8-b), curated."""
    digit = F.substring(F.md5(F.coalesce(source, F.lit("")).cast("binary")), 1, 1)
    return (F.when(digit < "8", F.lit("web")).when(digit < "c", F.lit("reference"))
            .otherwise(F.lit("curated")))


def _weight(key: str, weights: Mapping[str, int]) -> Column:
    out = F.lit(DEFAULT_WEIGHT)
    for name, w in weights.items():
        out = F.when(F.col(key) == name, F.lit(w)).otherwise(out)
    return out.cast("decimal(38,0)")


def _share(children: DataFrame, parent: Sequence[str], key: str) -> DataFrame:
    """Columns cap, w, parent_budget -> budget of each child of a parent."""
    ratio = F.when(F.col("w") > 0, F.col("cap").cast("double") / F.col("w").cast("double")).otherwise(
        F.lit(float("inf")))
    order = Window.partitionBy(*parent).orderBy("_ratio", key)
    zero = F.lit(0).cast("decimal(38,0)")
    filled = ((F.col("w") > 0)
              & (F.col("cap") * F.col("_w") <= F.col("w") * (F.col("parent_budget") - F.col("_c"))))
    over = Window.partitionBy(*parent)
    return (children.withColumn("_ratio", ratio)
            .withColumn("_c", F.coalesce(F.sum("cap").over(order.rowsBetween(
                Window.unboundedPreceding, -1)).cast("decimal(30,0)"), zero.cast("decimal(30,0)")))
            .withColumn("_w", F.sum("w").over(order.rowsBetween(
                Window.currentRow, Window.unboundedFollowing)).cast("decimal(8,0)"))
            .withColumn("_filled", filled)
            # Of the children that are not filled, the first in order.
            .withColumn("_left", F.col("parent_budget") - F.min(F.when(~F.col("_filled"), F.col("_c"))).over(over))
            .withColumn("_all", F.max(F.when(~F.col("_filled"), F.col("_w"))).over(over))
            .withColumn("budget", F.when(F.col("_filled"), F.col("cap").cast("long")).otherwise(
                F.coalesce(F.expr("CASE WHEN _all > 0 THEN (w * _left) DIV _all END"), F.lit(0))))
            .drop("_ratio", "_c", "_w", "_filled", "_left", "_all"))


def leaf_budgets(leaves: DataFrame, weights: Mapping[str, Mapping[str, int]],
                 share: tuple[int, int], max_epochs: int) -> DataFrame:
    """(domain, lang, source, tokens) -> the same with budget (long)."""
    narrow = "decimal(22,0)"
    total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("_t"))
    budget = F.expr(f"least(CAST(_t AS DECIMAL(30,0)) * {share[0]} DIV {share[1]}, _t * {max_epochs})")
    parents = total.select(F.lit(0).alias("_root"), budget.cast(narrow).alias("parent_budget"))
    above: list[str] = ["_root"]
    nodes = leaves.withColumn("_root", F.lit(0))
    for i, key in enumerate(LEVELS):
        path = ["_root", *LEVELS[:i + 1]]
        children = (nodes.groupBy(*path).agg((F.sum("tokens") * max_epochs).cast(narrow).alias("cap"),
                                             F.sum("tokens").alias("tokens"))
                    .withColumn("w", _weight(key, weights[key]).cast("decimal(6,0)"))
                    .join(parents, above))
        shared = _share(children, above, key)
        parents = shared.select(*path, F.col("budget").cast(narrow).alias("parent_budget"))
        above = path
        last = shared
    return last.select(*LEVELS, "tokens", "budget")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        domain: Column | None = None, lang_col: str = "lang", source_col: str = "source",
        weights: Mapping[str, Mapping[str, int]] | None = None, share: tuple[int, int] = (4, 5),
        max_epochs: int = 2, seed: int = 17) -> DataFrame:
    """One row per selected document and epoch: row (struct of all input
    columns), domain, lang, source, epoch, n_tokens, leaf_budget.

    The total budget is ``share`` (a fraction) of all tokens.
    """
    weights = weights or WEIGHTS
    unknown = F.lit(UNKNOWN)
    packed = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(domain if domain is not None else domain_of(F.col(source_col)), unknown).alias("domain"),
        F.coalesce(F.col(lang_col), unknown).alias("lang"),
        F.coalesce(F.col(source_col), unknown).alias("source"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"),
        F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("_digest"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"))
    place = F.concat(F.md5(F.concat(F.lit(f"{seed}:"), F.col("epochs").cast("string"), F.lit(":"),
                                    F.col("_id")).cast("binary")), F.col("_digest"))
    narrow, _ = stage(packed.select(*LEVELS, "_id", "_digest", "n_tokens"))
    leaves = narrow.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    # Written: Spark then knows their size and broadcasts them only if small.
    plan, _ = stage(leaf_budgets(leaves, weights, share, max_epochs).filter("budget > 0")
                    .withColumn("epochs", F.expr("budget DIV tokens"))
                    .withColumn("rest", F.expr("budget - (budget DIV tokens) * tokens")))

    # The part epoch: where in each leaf's order the remainder is reached.
    # Sums over ranges of the order narrow it down to one range of each leaf,
    # twice; only that range is ordered row by row.
    rows = (narrow.join(plan.filter("rest > 0"), list(LEVELS))
            .select(*LEVELS, "rest", "n_tokens", place.alias("place"), F.lit(0).cast("long").alias("start")))

    def before(by: str) -> Column:
        """Tokens of the leaf that stand before a range or place."""
        w = Window.partitionBy(*LEVELS).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.col("start") + F.coalesce(F.sum("sum").over(w), F.lit(0))

    for digits in RANGE_DIGITS:
        ranged = rows.withColumn("range", F.substring("place", 1, digits))
        reached = (ranged.groupBy(*LEVELS, "range", "rest", "start").agg(F.sum("n_tokens").alias("sum"))
                   .withColumn("at", before("range")).filter("at < rest AND at + sum >= rest")
                   .select(*LEVELS, "range", F.col("at").alias("start")))
        rows = ranged.drop("start").join(reached, [*LEVELS, "range"]).drop("range")
    ends = (rows.groupBy(*LEVELS, "rest", "start", "place").agg(F.sum("n_tokens").alias("sum"))
            .withColumn("at", before("place")).filter("at < rest")
            .groupBy(*LEVELS).agg(F.max("place").alias("end")))
    ended, _ = stage(plan.join(ends, list(LEVELS), "left"))

    whole = F.expr("CASE WHEN epochs > 0 THEN sequence(0L, epochs - 1) ELSE array() END")
    part = F.when(F.coalesce(place <= F.col("end"), F.lit(False)), F.array("epochs")).otherwise(
        F.array().cast("array<bigint>"))
    return (packed.join(ended, list(LEVELS))
            .withColumn("epoch", F.explode(F.concat(whole, part)))
            .select("row", *LEVELS, F.col("epoch").cast("int").alias("epoch"), "n_tokens",
                    F.col("budget").alias("leaf_budget")))


def mixing_sql(share: tuple[int, int] = (4, 5), max_epochs: int = 2, seed: int = 17) -> str:
    """DuckDB SQL of the registered query over ``documents``."""

    def weight(key: str) -> str:
        cases = " ".join(f"WHEN '{k}' THEN {w}" for k, w in WEIGHTS[key].items())
        return f"CASE c.{key} {cases} ELSE {DEFAULT_WEIGHT} END" if cases else str(DEFAULT_WEIGHT)

    def level(i: int) -> str:
        path = ", ".join(LEVELS[:i + 1])
        above = ", ".join(LEVELS[:i]) or "1"
        parent = "total" if i == 0 else f"b{i - 1}"
        on = "true" if i == 0 else " AND ".join(f"c.{k} = p.{k}" for k in LEVELS[:i])
        own = ", ".join(f"c.{k}" for k in LEVELS[:i + 1])
        return f"""
c{i} AS (
  SELECT {own}, c.tokens, c.tokens * {max_epochs} AS cap, ({weight(LEVELS[i])}) AS w, p.budget AS pb
  FROM (SELECT {path}, sum(tokens) AS tokens FROM leaves GROUP BY ALL) c JOIN {parent} p ON {on}),
o{i} AS (
  SELECT *, coalesce(sum(cap) OVER (PARTITION BY {above} ORDER BY cap::DOUBLE / w, {LEVELS[i]}
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cb,
         sum(w) OVER (PARTITION BY {above} ORDER BY cap::DOUBLE / w, {LEVELS[i]}
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM c{i}),
f{i} AS (SELECT *, cap * ws <= w * (pb - cb) AS filled FROM o{i}),
b{i} AS (
  SELECT {path}, tokens, CASE WHEN filled THEN cap ELSE
           (w * (pb - min(cb) FILTER (NOT filled) OVER (PARTITION BY {above})))
           // (max(ws) FILTER (NOT filled) OVER (PARTITION BY {above})) END AS budget
  FROM f{i})"""

    return rf"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '{UNKNOWN}') AS lang, coalesce(source, '{UNKNOWN}') AS source,
         CASE WHEN substr(md5(coalesce(source, '')), 1, 1) < '8' THEN 'web'
              WHEN substr(md5(coalesce(source, '')), 1, 1) < 'c' THEN 'reference' ELSE 'curated' END AS domain,
         md5(coalesce(text, '')) AS digest,
         coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS n_tokens
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM docs GROUP BY ALL),
total AS (SELECT least(sum(tokens) * {share[0]} // {share[1]}, sum(tokens) * {max_epochs}) AS budget FROM leaves),
{level(0)},{level(1)},{level(2)},
epochs AS (SELECT unnest(generate_series(0, {max_epochs})) AS epoch),
ordered AS (
  SELECT d.*, e.epoch, b.budget, b.tokens AS leaf_tokens,
         coalesce(sum(n_tokens) OVER (PARTITION BY d.domain, d.lang, d.source, e.epoch
           ORDER BY md5('{seed}:' || e.epoch || ':' || coalesce(doc_id::VARCHAR, '')) || digest
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs d JOIN b2 b ON d.domain = b.domain AND d.lang = b.lang AND d.source = b.source
  CROSS JOIN epochs e WHERE b.budget > 0)
SELECT doc_id, domain, lang, source, epoch::INTEGER AS epoch, n_tokens::BIGINT AS n_tokens,
       budget::BIGINT AS leaf_budget
FROM ordered WHERE epoch * leaf_tokens + before < budget AND epoch <= budget // leaf_tokens
"""
