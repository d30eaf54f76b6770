"""M1: dense ids for users and products, ordered like ``StringIndexer``.

Order: frequency descending, then the id as text ascending (so "10" < "2"),
index 0, 1, 2, ... as double. ``StringIndexer.fit`` ships every label to the
driver; here the index table is built distributed:

1. count rows per key (partial aggregation, one shuffle);
2. range-partition the counted keys by (count desc, text asc) and number
   rows inside each partition;
3. add the running total of the preceding partitions' sizes (a table with
   one row per partition, broadcast by construction).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.sizing import materialize



def index_table(df: DataFrame, key: str, idx: str | None = None,
                partitions: int | None = None) -> DataFrame:
    """Columns ``key, idx, frequency``: one row per non-NULL key."""
    idx = idx or f"{key}_idx"
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = (df.filter(F.col(key).isNotNull()).groupBy(key)
              .agg(F.count(F.lit(1)).alias("frequency"))
              .withColumn("_label", F.col(key).cast("string")))
    order = [F.desc("frequency"), F.asc("_label")]
    # sampled range boundaries depend on row order, which a shuffle does not
    # fix: materialise once so every use sees the same partitions
    ranged = materialize(counts.repartitionByRange(n, *order).withColumn(
        "_part", F.spark_partition_id()))
    local = ranged.withColumn(
        "_rn", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select(
        "_part",
        (F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_offset"))
    out = local.join(F.broadcast(offsets), "_part").select(
        F.col(key),
        (F.coalesce(F.col("_offset"), F.lit(0)) + F.col("_rn") - 1).cast("double").alias(idx),
        "frequency")
    return out


def attach_index(df: DataFrame, table: DataFrame, key: str, idx: str | None = None,
                 unseen: bool = True) -> DataFrame:
    """Join an index table; unseen/NULL keys get the extra index ``len(table)``
    when ``unseen`` (``handleInvalid="keep"``)."""
    idx = idx or f"{key}_idx"
    out = df.join(table.select(key, idx), key, "left")
    if unseen:
        size = table.agg(F.count(F.lit(1)).cast("double")).scalar()
        out = out.withColumn(idx, F.coalesce(F.col(idx), size))
    return out
