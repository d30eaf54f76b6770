"""Exact global row numbers inside groups without one task per group.

``row_number() OVER (PARTITION BY g ORDER BY o)`` sends each group to one
task; a group holding a third of the table becomes one enormous task. Here
the table is range-partitioned by (g, o) — Spark samples the boundaries, so
a big group is split over many partitions — numbered inside each
partition, and shifted by the rows of the same group in the preceding
partitions (a table of at most partitions × groups-per-partition rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.sizing import materialize


def range_parts(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned by (group, order), with the partition number
    as ``_part``: a big group is split over partitions, in order.

    Range boundaries come from sampling, and a shuffled input has no fixed
    row order, so two evaluations may cut differently: materialised once.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(n, *[F.col(g) for g in group], *order)
                       .withColumn("_part", F.spark_partition_id()))


def split_groups(ranged: DataFrame, group: Sequence[str]) -> DataFrame:
    """The groups of a ``range_parts`` table that lie in more than one
    partition (fewer than there are partitions)."""
    return (ranged.select("_part", *group).distinct().groupBy(*group)
            .agg(F.count(F.lit(1)).alias("_parts")).filter(F.col("_parts") > 1).drop("_parts"))


def group_row_number(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                     name: str = "row_number", partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of each row in its group by ``order``
    (``order`` must be a total order, e.g. end with a unique key)."""
    return group_running_sum(df, group, order, F.lit(1), name, partitions)


def group_running_sum(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                      value: Column, name: str, partitions: int | None = None) -> DataFrame:
    """Add ``name`` = running sum of ``value`` (integral) in each group up to
    and including the row, rows ordered by ``order`` (a total order)."""
    ranged = range_parts(df.withColumn("_val", value.cast("long")), group, order, partitions)
    w = (Window.partitionBy("_part", *group).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumn("_rn", F.sum("_val").over(w))
    sizes = ranged.groupBy("_part", *group).agg(F.sum("_val").alias("_size"))
    before = sizes.withColumn(
        "_offset",
        F.coalesce(F.sum("_size").over(Window.partitionBy(*group).orderBy("_part")
                                       .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # The offset table has one row per (partition, group); AQE broadcasts it
    # when it is small at run time.
    out = local.join(before.select("_part", *group, "_offset"), ["_part", *group], "inner")
    return out.withColumn(name, (F.col("_offset") + F.col("_rn")).cast("long")).drop(
        "_part", "_rn", "_offset", "_val")


def first_rows_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
                         partitions: int | None = None) -> DataFrame:
    """The first ``n`` rows of every group by ``order`` (exact)."""
    ranked = group_row_number(df, group, order, "_pos", partitions)
    return ranked.filter(F.col("_pos") <= n).drop("_pos")
