"""Micro-batch sinks (R4, R5, R7, R8, R11) and the streaming recommender.

Every batch writes under ``batch_id=<id>`` with dynamic partition
overwrite, so a batch replayed after a failure replaces its own output
instead of appending a second copy (exactly-once effect on files). Update
mode re-emits a group whenever its count changes; ``latest_versions`` turns
the per-batch outputs into the newest row per (window, key) — the keyed
upsert view.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwheel.functions.sizing import drop_table, path_exists
from cartwheel.operators.recommend import recommend
from cartwheel.sources.files import append_batch_csv
from cartwheel.sources.points import to_points
from cartwheel.streaming.activity import ACTIVITY_KEYS, TRIGGER, flatten_window


def write_batch_parquet(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def latest_versions(spark: SparkSession, path: str, keys: Sequence[str] = ACTIVITY_KEYS,
                    value: str = "event_count") -> DataFrame:
    """Newest emitted value per (window, key) across all batch outputs."""
    df = spark.read.parquet(path)
    k = ["window_start", "window_end", *keys]
    return df.groupBy(*k).agg(F.max_by(value, "batch_id").alias(value))


class ActivitySink:
    """foreachBatch function: store each update-mode batch."""

    def __init__(self, out: str):
        self.out = out

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        write_batch_parquet(flatten_window(batch), self.out, batch_id)


class RecommendationSink:
    """foreachBatch function of the streaming recommender.

    Per batch: write the activity (upsert source); skip the rest if it is empty;
    write event points, recommendations, and these as points and as CSV. Scoring
    uses ``event_count`` so an activity row counts the events behind it (hazard
    H16); point time is the window end (H17).

    The stateful aggregation and the scoring run once each: later steps read the
    stored batch. They do so in the session of the products, because adaptive
    execution is off in a micro-batch's own session, where each shuffle has as
    many tasks as the state has partitions, however small the batch.
    """

    def __init__(self, products: DataFrame, out: str, fallback: str = "per_user"):
        self.products = products
        self.out = out.rstrip("/")
        self.fallback = fallback

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        b = self._store(flatten_window(batch), "activity", batch_id)
        if b is None:
            return
        events = to_points(b.select("window_end", *ACTIVITY_KEYS, "event_count"),
                           "user_events", time_col="window_end")
        write_batch_parquet(events, f"{self.out}/points/user_events", batch_id)
        recs = self._store(recommend(b, self.products, self.fallback), "recommendations", batch_id)
        if recs is None:
            return
        append_batch_csv(recs, f"{self.out}/recommendations_csv", batch_id)
        window_end = b.agg(F.max("window_end")).scalar()
        pts = to_points(recs, "recommendations", time_col=None, default_time=window_end)
        write_batch_parquet(pts, f"{self.out}/points/recommendations", batch_id)

    def _store(self, df: DataFrame, name: str, batch_id: int) -> DataFrame | None:
        """Write a batch's table and read it back; None when it has no rows."""
        spark, folder = self.products.sparkSession, f"{self.out}/{name}/batch_id={batch_id}"
        drop_table(spark, folder)  # what a failed run of the batch left
        write_batch_parquet(df, f"{self.out}/{name}", batch_id)
        return spark.read.schema(df.schema).parquet(folder) if path_exists(spark, folder) else None


def start(stream: DataFrame, sink, checkpoint: str, output_mode: str = "update",
          trigger: str | None = TRIGGER, available_now: bool = False,
          name: str | None = None) -> StreamingQuery:
    """Start a query with its own checkpoint folder.

    The number of state partitions is the session's
    ``spark.sql.shuffle.partitions`` at the first start; a restarted query
    keeps the number recorded in its checkpoint.
    """
    w = stream.writeStream.outputMode(output_mode).foreachBatch(sink).option(
        "checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    return w.start()


def run_available_now(stream: DataFrame, sink, checkpoint: str, output_mode: str = "update",
                      timeout: float | None = None) -> StreamingQuery:
    """Process every file present now, then stop (tests and backfills)."""
    q = start(stream, sink, checkpoint, output_mode, available_now=True)
    q.awaitTermination(timeout)
    return q
