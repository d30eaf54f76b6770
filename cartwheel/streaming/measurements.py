"""X15 on a stream: the four dashboard measurements while events arrive.

The stream is read without state: each micro-batch is cleaned with the stored
statistics of the newest run (loaded again for every batch, so a new run takes
effect at the next one) and leaves, under its ``batch_id``, small mergeable
rows per key:

* ``hours``: sums per (hour, user), first and last event time;
* ``products``: sums per (product, user);
* ``interest``: events per (user, raw category), what recommendations need.

``MeasurementLog`` adds them up by key, which is the keyed upsert: a replayed
batch replaces its own rows, late events count like others, and the tables at
any moment equal the batch operators over all events read so far. A batch costs
what its own events cost. ``compact`` replaces the batches up to now by one
committed run, so that readers don't collect ever more folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.columns import count_type, is_type
from cartwheel.operators import cleaning, recommend, segmentation
from cartwheel.schema import CART, PURCHASE, REMOVE, VIEW
from cartwheel.sources import snapshots
from cartwheel.sources.points import to_points
from cartwheel.streaming.sinks import write_batch_parquet

STATISTICS, PRODUCTS = "cleaning_statistics", "product_data"  # tables of a run

_HOUR_SUMS = ["total_events", "views", "carts", "purchases", "removes", "price_sum", "price_n"]
_PRODUCT_SUMS = ["total_events", "total_views", "total_carts", "total_purchases", "price_sum", "price_n",
                 "purchase_revenue"]
_LAST = "interest"  # written last: a batch counts once it is there
# Per table: its keys and how its other columns add up.
_TABLES = {
    "hours": (["hour_bucket", "user_id"], dict.fromkeys(_HOUR_SUMS, F.sum) | {"first_seen": F.min, "last_seen": F.max}),
    "products": (["product_id", "user_id"], dict.fromkeys(_PRODUCT_SUMS, F.sum)),
    _LAST: (["user_id", "category_code"], {"event_count": F.sum}),
}


def _rows(raw: DataFrame, cleaned: DataFrame) -> dict[str, DataFrame]:
    """What a batch adds to each table, ``_LAST`` at the end."""
    n, price = F.count(F.lit(1)), F.col("price")
    prices = [F.sum(price).alias("price_sum"), F.count(price).alias("price_n")]
    return {
        "hours": cleaned.groupBy("hour_bucket", "user_id").agg(
            n.alias("total_events"), count_type(VIEW).alias("views"), count_type(CART).alias("carts"),
            count_type(PURCHASE).alias("purchases"), count_type(REMOVE).alias("removes"), *prices,
            F.min("event_time").alias("first_seen"), F.max("event_time").alias("last_seen")),
        "products": cleaned.groupBy("product_id", "user_id").agg(
            n.alias("total_events"), count_type(VIEW).alias("total_views"), count_type(CART).alias("total_carts"),
            count_type(PURCHASE).alias("total_purchases"), *prices,
            F.sum(F.when(is_type(PURCHASE), price)).alias("purchase_revenue")),
        _LAST: raw.groupBy("user_id", "category_code").agg(n.alias("event_count")),
    }


class MeasurementSink:
    """foreachBatch function over raw events: clean them with the newest run of
    ``runs`` and store what they add to each table under ``out``."""

    def __init__(self, out: str, runs: str):
        self.out = out.rstrip("/")
        self.runs = runs

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        raw = batch.persist()
        try:
            if raw.isEmpty():
                return
            stats = snapshots.latest_run(batch.sparkSession, self.runs)[STATISTICS].drop("snapshot")
            for name, rows in _rows(raw, cleaning.clean_events(raw, stats=stats)).items():
                write_batch_parquet(rows, f"{self.out}/{name}", batch_id)
        finally:
            raw.unpersist()


class MeasurementLog:
    """What the sink has stored under ``out``, added up by key."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark = spark
        self.out = out.rstrip("/")

    def _merged_until(self) -> int:
        """The last batch inside the newest compacted run, -1 without one."""
        runs = snapshots.list_runs(self.spark, f"{self.out}/compact")
        return int(runs[-1].replace("_", "")) if runs else -1

    def _stored_until(self) -> int:
        """The last batch that all tables hold, -1 without one."""
        names = snapshots.names_in(self.spark, f"{self.out}/{_LAST}")
        return max((int(n.split("=")[1]) for n in names if n.startswith("batch_id=")), default=-1)

    def table(self, name: str, until: int | None = None) -> DataFrame:
        """One row per key: the newest compacted run and the whole batches after
        it, up to batch ``until``. A batch that is being written is not read."""
        keys, sums = _TABLES[name]
        merged = self._merged_until()
        until = self._stored_until() if until is None else until
        rows = self.spark.read.parquet(f"{self.out}/{name}").filter(
            (F.col("batch_id") > merged) & (F.col("batch_id") <= until)).drop("batch_id")
        if merged >= 0:
            done = snapshots.latest_run(self.spark, f"{self.out}/compact")[name].drop("snapshot")
            rows = rows.unionByName(done)
        return rows.groupBy(*keys).agg(*[f(c).alias(c) for c, f in sums.items()])

    def compact(self) -> int:
        """Commit all tables up to the newest whole batch as one run; returns that
        batch (-1: nothing stored). A batch inside the run is not read again, even
        if it is written once more."""
        until = self._stored_until()
        if until > self._merged_until():
            stamp = f"{until:014d}"
            snapshots.write_run({name: self.table(name, until) for name in _TABLES}, f"{self.out}/compact",
                                f"{stamp[:8]}_{stamp[8:]}")
        return until

    def _per(self, name: str, key: str, sums: list[str]) -> DataFrame:
        """Sums per key with its distinct users (a row each) and mean price."""
        per = self.table(name).groupBy(key).agg(
            *[F.sum(c).alias(c) for c in sums], F.count("user_id").alias("unique_users"))
        mean = F.try_divide(F.col("price_sum"), F.col("price_n").cast("double"))
        return per.withColumn("avg_price", mean).drop("price_n")

    def hourly_activity(self) -> DataFrame:
        """A16 of all events read so far."""
        return self._per("hours", "hour_bucket", _HOUR_SUMS).drop("price_sum")

    def product_popularity(self) -> DataFrame:
        """A13 of all events read so far."""
        return self._per("products", "product_id", _PRODUCT_SUMS).withColumnRenamed("price_sum", "total_revenue")

    def users(self) -> DataFrame:
        """First and last event time of every user."""
        return self.table("hours").groupBy("user_id").agg(F.min("first_seen").alias("first_seen"),
                                                          F.max("last_seen").alias("last_seen"))

    def segment_evolution(self, before: Column, after: Column) -> DataFrame:
        """X10 between two labellings of a user's row (first_seen, last_seen)."""
        users = self.users()
        return segmentation.segment_stability(users.select("user_id", before.alias("segment_id")),
                                              users.select("user_id", after.alias("segment_id")))

    def recommendations(self, products: DataFrame) -> DataFrame:
        """R9 + R10 of the interest so far with a product run."""
        return recommend.recommend(self.table("interest"), products)

    def points(self, products: DataFrame, before: Column, after: Column) -> DataFrame:
        """The four measurements as points; those without a time of their own
        have the newest event's."""
        newest = self.users().agg(F.max("last_seen")).scalar()
        rec = self.recommendations(products).filter(F.col("recommended_category_code").isNotNull())
        tables = {
            "user_behavior": self.hourly_activity().withColumn("event_time", F.to_timestamp("hour_bucket")),
            "segment_evolution": self.segment_evolution(before, after).withColumn("event_time", newest),
            "recommendation_metrics": rec.groupBy("recommended_category_code").agg(
                F.count(F.lit(1)).alias("recommendations")).withColumn("event_time", newest),
            "product_popularity": self.product_popularity().withColumn("event_time", newest)}
        out = None
        for name, df in tables.items():
            points = to_points(df, name)
            out = points if out is None else out.unionByName(points)
        return out
