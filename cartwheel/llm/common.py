"""Helpers shared by the operators of this package.

Conventions
-----------
* An operator selects the columns it needs first, so extra input columns,
  also ones named like its own, never clash.
* Intermediate tables that are read more than once are written into the
  folder named by ``spark.checkpoint.dir`` and read back (``stage``): they
  survive lost executors and give every reader the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.functions.sizing import drop_table, materialize_at

# ASCII white space of the query contracts: blank, tab, line feed, vertical
# tab, form feed, carriage return.
WHITE_SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# A key's rows are dealt to so many sub-keys where one key may be hot.
SALTS = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text modulo ``modulus``; a null id counts as ''."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus))


def stage(df: DataFrame) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder; return the table and its folder."""
    return materialize_at(df)


def salt(*key: Column, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(salts)).cast("int")


def smallest_ids(rows: DataFrame, by: str, id_col: str, limit: int) -> DataFrame:
    """A bounded, repeatable sample: per value of ``by`` the ``limit`` rows
    whose hashed id is smallest.

    Hashes are uniform, so a cut at 1.2 * limit / rows of a value (and a few
    standard deviations) keeps little more than ``limit`` rows of each value
    before they are ranked; a value with fewer rows keeps all.
    """
    hashed = rows.withColumn("_h", F.pmod(F.xxhash64(id_col), F.lit(1 << 40)))
    cut = rows.groupBy(by).agg(F.count("*").alias("_n")).select(
        by, (F.lit((1.2 * limit + 50) * float(1 << 40)) / F.col("_n")).alias("_cut"))
    w = Window.partitionBy(by).orderBy("_h", id_col)
    # One row a class of the classifier that is fitted to the sample.
    return (hashed.join(F.broadcast(cut), by).filter(F.col("_h") < F.col("_cut"))
            .withColumn("_rank", F.row_number().over(w))
            .filter(F.col("_rank") <= limit).drop("_h", "_rank", "_cut"))


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph given as (a long, b long) edges.

    Returns (node, component), one row per node that has an edge; component
    is the component's smallest node. Alternating large-star and small-star
    steps (Kiveris et al., 2014): each step is a minimum per node and an
    equi-join, the edge count never grows, and the number of rounds is
    logarithmic in practice. Every round is written to the shared folder.
    No edges: no rows.
    """
    spark = edges.sparkSession

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:  # neighbours above the node join the node's minimum
            sides = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
                e.select(F.col("b").alias("u"), F.col("a").alias("v")))
            low = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
            out = (sides.filter(F.col("v") > F.col("u")).join(low, "u")
                   .select(F.col("v").alias("a"), F.col("m").alias("b")))
        else:  # neighbours below the node, and the node, join their minimum
            low = e.groupBy("a").agg(F.min("b").alias("m"))
            out = (e.join(low, "a").select(
                F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                  F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e"))
                   .select("e.a", "e.b"))
        return out.filter(F.col("a") != F.col("b"))

    # Edges point from the larger node (a) to the smaller (b).
    current, path = stage(edges.filter(F.col("a") != F.col("b"))
                          .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                          .distinct())
    before = _checksum(current)
    while before[0]:
        # large-star emits (v, m) with v > u >= m: still larger to smaller, and
        # one row an edge, so what it repeats is dropped with the small-star's.
        following, next_path = stage(star(star(current, True), False).distinct())
        after = _checksum(following)
        drop_table(spark, path)
        current, path = following, next_path
        if after == before:
            break
        before = after
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
