"""Registered source/sink and streaming queries.

Each writes derived data into a fresh folder inside the session's shared
checkpoint folder, reads it back (or streams it with ``availableNow``) and
returns the result as a batch DataFrame.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.operators import als, behavior, cleaning, products, recommend
from cartwheel.operators.behavior import bag_text
from cartwheel.plans.catalog import register
from cartwheel.plans.oracle import BASE_CTES, CLEANED_CTES, normalized
from cartwheel.plans.queries_batch import CLEANED_COLUMNS, UB_COLUMNS, _UB_FULL, cleaned
from cartwheel.plans.queries_model import (
    _REC_CTES,
    _SPLIT_CTES,
    _UB_LABEL_CTE,
    REC_COLS,
    _fit,
    _labelled_users,
    product_table,
    recs,
)
from cartwheel.plans.queries_profile import PRODUCT_DATA_COLS
from cartwheel.plans.queries_spec import _METRIC_COLS, _METRIC_CTES, _METRIC_SQL
from cartwheel.schema import EVENT_COLUMNS, EVENT_SCHEMA, clickstream
from cartwheel.sources import files, points, snapshots
from cartwheel.streaming import activity as sa
from cartwheel.streaming import measurements, sinks
from cartwheel.streaming.files import day_filter, scratch_dir, stage_event_files

_EVENT_SQL = "SELECT " + ", ".join(EVENT_COLUMNS) + " FROM clickstream"

# ------------------------------------------------------------------ sources / sinks


@register("scan_clickstream_csv", normalized(
    _EVENT_SQL, EVENT_COLUMNS, dbl=("price",), tss=("event_time",), ctes=BASE_CTES))
def q_scan_clickstream_csv(spark, sf_dir):
    """The clickstream written as CSV and read back with the schema."""
    path = scratch_dir(spark, "csv")
    files.write_csv(clickstream(spark, sf_dir).select(*EVENT_COLUMNS), path)
    return files.read_clickstream_csv(spark, path, nullValue=files.CSV_NULL)


_CLEANED_SCHEMA = T.StructType(
    [T.StructField("event_id", T.LongType())] + EVENT_SCHEMA.fields
    + [T.StructField(c, T.IntegerType()) for c in
       ["hour", "minute", "second", "day", "month", "dayofweek"]]
    + [T.StructField("date", T.StringType()), T.StructField("hour_bucket", T.StringType())])


@register("write_cleaned", normalized(
    "SELECT * FROM cleaned", CLEANED_COLUMNS, dbl=("price",), tss=("event_time",),
    ctes=CLEANED_CTES))
def q_write_cleaned(spark, sf_dir):
    """Cleaned events written by date/event_type and read back."""
    path = scratch_dir(spark, "cleaned")
    files.write_cleaned(cleaned(spark, sf_dir), path)
    return files.read_table(spark, path, _CLEANED_SCHEMA).select(*CLEANED_COLUMNS)


@register("write_user_behavior", normalized(
    _UB_FULL, UB_COLUMNS,
    dbl=("avg_price", "avg_price_purchased", "monetary", "conversion_rate", "cart_abandonment",
         "rfm_score"), tss=("first_seen", "last_seen"), ctes=CLEANED_CTES))
def q_write_user_behavior(spark, sf_dir):
    """User behaviour written by main_category and read back."""
    path = scratch_dir(spark, "users")
    ub = behavior.user_behavior(cleaned(spark, sf_dir))
    files.write_user_behavior(ub, path)
    back = spark.read.schema(ub.schema).parquet(path)
    return back.withColumn("viewed_categories", bag_text("viewed_categories")).withColumn(
        "viewed_brands", bag_text("viewed_brands")).select(*UB_COLUMNS)


def _product_sql():
    from cartwheel.plans.queries_profile import _PRODUCT_DATA_SQL
    return _PRODUCT_DATA_SQL


@register("write_table", normalized(
    _product_sql(), PRODUCT_DATA_COLS, dbl=("product_idx", "avg_price", "total_revenue"),
    ctes=CLEANED_CTES))
def q_write_table(spark, sf_dir):
    """The product table written as plain Parquet and read back."""
    path = scratch_dir(spark, "products")
    files.write_table(products.product_data(cleaned(spark, sf_dir)), path)
    return spark.read.parquet(path)


@register("scan_snapshots", normalized(
    "SELECT product_id, count(*) AS copies FROM (SELECT product_id FROM products UNION ALL "
    "SELECT product_id FROM products) AS u GROUP BY product_id", ["product_id", "copies"],
    ctes=_REC_CTES))
def q_scan_snapshots(spark, sf_dir):
    """S2 + S10: two runs of the product table; the glob reader sees both."""
    base = scratch_dir(spark, "runs")
    p = product_table(spark, sf_dir)
    snapshots.write_snapshot(p, base, "product_data", "20240101_000000")
    snapshots.write_snapshot(p, base, "product_data", "20240102_000000")
    return snapshots.scan_snapshots(spark, base, "product_data").groupBy("product_id").agg(
        F.count(F.lit(1)).alias("copies"))


@register("latest_snapshot", normalized(
    "SELECT product_id, total_purchases, avg_price, main_category_code, main_brand FROM products",
    ["product_id", "total_purchases", "avg_price", "main_category_code", "main_brand"],
    dbl=("avg_price",), ctes=_REC_CTES))
def q_latest_snapshot(spark, sf_dir):
    """S3: only the newest run is read (older run holds other data)."""
    base = scratch_dir(spark, "runs")
    p = product_table(spark, sf_dir)
    snapshots.write_snapshot(p.limit(0), base, "product_data", "20240101_000000")
    snapshots.write_snapshot(p, base, "product_data", "20240102_000000")
    return snapshots.latest_snapshot(spark, base, "product_data").select(
        "product_id", "total_purchases", "avg_price", "main_category_code", "main_brand")


@register("head_sample_by_month", normalized(
    "SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY "
    "strftime(event_time, '%Y-%m') ORDER BY event_time, event_id) AS rn FROM clickstream) AS t "
    "WHERE rn <= 200", ["event_id"], ctes=BASE_CTES))
def q_head_sample_by_month(spark, sf_dir):
    """The first 200 events of every month."""
    return files.head_sample_by_month(clickstream(spark, sf_dir), 200).select("event_id")


_REC_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("product_id", T.LongType()),
    T.StructField("rec_score", T.DoubleType()),
    T.StructField("recommended_category_code", T.StringType()),
    T.StructField("main_brand", T.StringType()), T.StructField("avg_price", T.DoubleType()),
    T.StructField("recommendation_type", T.StringType())])


def _write_batches(spark, sf_dir):
    path = scratch_dir(spark, "recs-csv")
    r = recs(spark, sf_dir).persist()
    aff = r.filter(F.col("recommendation_type") == recommend.AFFINITY)
    fb = r.filter(F.col("recommendation_type") == recommend.FALLBACK)
    files.append_batch_csv(aff, path, 0)
    files.append_batch_csv(fb, path, 1)
    files.append_batch_csv(aff, path, 0)  # replay of batch 0 after a failure
    r.unpersist()
    return path


@register("append_csv", normalized(
    "SELECT * FROM recs", REC_COLS, dbl=("rec_score", "avg_price"), ctes=_REC_CTES))
def q_append_csv(spark, sf_dir):
    """Per-batch CSV output; a replayed batch replaces its own folder."""
    path = _write_batches(spark, sf_dir)
    fields = _REC_SCHEMA.fields + [T.StructField("batch_id", T.LongType())]
    return (spark.read.schema(T.StructType(fields)).option("header", True).csv(path)
            .select(*REC_COLS))


@register("merge_recommendations", normalized(
    "SELECT * FROM recs", REC_COLS, dbl=("rec_score", "avg_price"), ctes=_REC_CTES))
def q_merge_recommendations(spark, sf_dir):
    """All batch outputs merged into one table, duplicates removed."""
    path = _write_batches(spark, sf_dir)
    return files.merge_recommendations(spark, path, _REC_SCHEMA).select(*REC_COLS)


def _points_sql():
    parts = []
    for c in ["event_type", "brand", "user_id"]:
        parts.append(f"SELECT 'user_events' AS measurement, event_time AS ts, 'tag' AS kind, "
                     f"'{c}' AS key, CAST({c} AS VARCHAR) AS tag_value, "
                     f"CAST(NULL AS DOUBLE) AS field_value FROM cleaned WHERE {c} IS NOT NULL")
    for c in ["product_id", "price"]:
        parts.append(f"SELECT 'user_events' AS measurement, event_time AS ts, 'field' AS kind, "
                     f"'{c}' AS key, CAST(NULL AS VARCHAR) AS tag_value, "
                     f"CAST({c} AS DOUBLE) AS field_value FROM cleaned WHERE {c} IS NOT NULL")
    return " UNION ALL ".join(parts)


@register("to_points", normalized(
    _points_sql(), ["measurement", "ts", "kind", "key", "tag_value", "field_value"],
    dbl=("field_value",), tss=("ts",), ctes=CLEANED_CTES))
def q_to_points(spark, sf_dir):
    """Events as time-series points (flattened for comparison)."""
    ev = cleaned(spark, sf_dir).select("event_time", "event_type", "product_id", "brand",
                                       "price", "user_id")
    return points.flatten_points(points.to_points(ev, "user_events"))


@register("model_roundtrip", normalized(
    "SELECT count(*) AS pairs, true AS same FROM split WHERE NOT is_train "
    "AND user_id IN (SELECT user_id FROM split WHERE is_train) "
    "AND product_id IN (SELECT product_id FROM split WHERE is_train)", ["pairs", "same"],
    ctes=_SPLIT_CTES))
def q_model_roundtrip(spark, sf_dir):
    """S13 (property): a saved and reloaded ALS model predicts the same."""
    from pyspark.ml.recommendation import ALSModel
    model, m, test, _, _ = _fit(spark, sf_dir)
    path = scratch_dir(spark, "als") + "/model"
    model.write().overwrite().save(path)
    again = ALSModel.load(path)
    a = als.predictions(model, test).select("user_idx", "product_idx", "prediction")
    b = als.predictions(again, test).select("user_idx", "product_idx",
                                            F.col("prediction").alias("reloaded"))
    j = a.join(b, ["user_idx", "product_idx"])
    same = F.abs(F.col("prediction") - F.col("reloaded")) < 1e-6
    return j.agg(F.count(F.lit(1)).alias("pairs"), F.bool_and(same).alias("same"))


@register("run_metadata", normalized(
    "SELECT count(DISTINCT user_id) AS total_users, count(DISTINCT product_id) AS total_products,"
    " count(*) AS total_interactions, (SELECT count(DISTINCT segment_id) FROM ub) AS segments_count"
    " FROM cleaned", ["total_users", "total_products", "total_interactions", "segments_count"],
    ctes=CLEANED_CTES + _UB_LABEL_CTE))
def q_run_metadata(spark, sf_dir):
    """Run counts (segments of the weekday labelling)."""
    md = files.run_metadata(cleaned(spark, sf_dir), _labelled_users(spark, sf_dir), sf_dir)
    return md.select("total_users", "total_products", "total_interactions", "segments_count")


# ------------------------------------------------------------------ streaming

STREAM_FILES = 24  # files that a phase is staged as
FILES_PER_BATCH = 6

_WINDOW_SQL = """
SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start,
       time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' AS window_end,
       user_id, product_id, event_type, category_code, brand, price, count(*) AS event_count
FROM clickstream GROUP BY ALL
"""
_WINDOW_COLS = ["window_start", "window_end"] + sa.ACTIVITY_KEYS + ["event_count"]


def _staged(spark, sf_dir, files_n=STREAM_FILES, df=None):
    src = scratch_dir(spark, "stream-src")
    stage_event_files(df if df is not None else clickstream(spark, sf_dir), src, files_n)
    return src


def _events(spark, src, per_batch=FILES_PER_BATCH):
    return sa.read_event_stream(spark, src, max_files_per_trigger=per_batch, nullValue=files.CSV_NULL)


@register("stream_clickstream", normalized(
    _EVENT_SQL, EVENT_COLUMNS, dbl=("price",), tss=("event_time",), ctes=BASE_CTES))
def q_stream_clickstream(spark, sf_dir):
    """Every event read through the file-stream source."""
    src = _staged(spark, sf_dir)
    out, ck = scratch_dir(spark, "stream-out"), scratch_dir(spark, "stream-ck")

    def sink(b, i):
        sinks.write_batch_parquet(b, out, i)

    sinks.run_available_now(_events(spark, src), sink, ck, output_mode="append")
    return spark.read.parquet(out).select(*EVENT_COLUMNS)


def _window_run(spark, src, ck=None, out=None):
    out = out or scratch_dir(spark, "stream-out")
    ck = ck or scratch_dir(spark, "stream-ck")
    sa.use_rocksdb(spark)
    stream = sa.windowed_activity(_events(spark, src))
    sinks.run_available_now(stream, sinks.ActivitySink(out), ck)
    return out, ck


@register("stream_window_activity", normalized(
    _WINDOW_SQL, _WINDOW_COLS, dbl=("price",), tss=("window_start", "window_end"),
    ctes=BASE_CTES))
def q_stream_window_activity(spark, sf_dir):
    """R3 + R4: 5-minute windowed activity; the newest update per key
    equals the batch aggregation (nothing late in time-ordered files)."""
    out, _ = _window_run(spark, _staged(spark, sf_dir))
    return sinks.latest_versions(spark, out).select(*_WINDOW_COLS)


@register("stream_restart", normalized(
    _WINDOW_SQL, _WINDOW_COLS, dbl=("price",), tss=("window_start", "window_end"),
    ctes=BASE_CTES))
def q_stream_restart(spark, sf_dir):
    """Stop after the first half of the files, restart on the same
    checkpoint with all files: same result as one run, no duplicates."""
    cs = clickstream(spark, sf_dir)
    src = scratch_dir(spark, "stream-src")
    first = day_filter(1, 15)
    t = stage_event_files(cs.filter(first), src, STREAM_FILES // 2, prefix="a")
    out, ck = _window_run(spark, src)
    stage_event_files(cs.filter(~first), src, STREAM_FILES // 2, prefix="b", start_mtime_ms=t)
    _window_run(spark, src, ck, out)
    return sinks.latest_versions(spark, out).select(*_WINDOW_COLS)


@register("stream_update_mode", normalized(
    "SELECT window_start, user_id, product_id, event_type, category_code, brand, price, "
    f"event_count AS last_count, true AS grows FROM ({_WINDOW_SQL}) AS w",
    ["window_start", *sa.ACTIVITY_KEYS, "last_count", "grows"], dbl=("price",), tss=("window_start",),
    ctes=BASE_CTES))
def q_stream_update_mode(spark, sf_dir):
    """Per key, each update is larger than the one before, and the last
    one emitted is the final count."""
    out, _ = _window_run(spark, _staged(spark, sf_dir))
    keys = ["window_start", *sa.ACTIVITY_KEYS]
    updates = F.array_sort(F.collect_list(F.struct("batch_id", "event_count")))  # one a batch
    per = spark.read.parquet(out).groupBy(*keys).agg(updates.alias("u"))
    later = F.slice("u", 2, F.greatest(F.size("u") - 1, F.lit(0)))
    grows = F.forall(F.zip_with("u", later, lambda a, b: F.coalesce(a["event_count"] < b["event_count"], F.lit(True))),
                     lambda ok: ok)
    return per.select(*keys, F.element_at("u", -1)["event_count"].alias("last_count"), grows.alias("grows"))


@register("stream_watermark", normalized(
    "SELECT CAST(sum(event_count) AS BIGINT) AS events_kept, count(*) AS keys, "
    f"true AS late_rows_dropped FROM ({_WINDOW_SQL}) AS w",
    ["events_kept", "keys", "late_rows_dropped"], ctes=BASE_CTES))
def q_stream_watermark(spark, sf_dir):
    """R2: days 1-15, then the others, then day 3 again (late): the late
    files change nothing and Spark reports dropped rows."""
    cs = clickstream(spark, sf_dir)
    src = scratch_dir(spark, "stream-src")
    first = day_filter(1, 15)
    t = stage_event_files(cs.filter(first), src, STREAM_FILES // 2, prefix="a")
    t = stage_event_files(cs.filter(~first), src, STREAM_FILES // 2, prefix="b", start_mtime_ms=t)
    stage_event_files(cs.filter(day_filter(3, 3)), src, FILES_PER_BATCH, prefix="c", start_mtime_ms=t)
    out, ck = scratch_dir(spark, "stream-out"), scratch_dir(spark, "stream-ck")
    sa.use_rocksdb(spark)
    stream = sa.windowed_activity(_events(spark, src))
    q = sinks.run_available_now(stream, sinks.ActivitySink(out), ck)
    dropped = sum(int(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0))
                  for p in q.recentProgress if p.get("stateOperators"))
    got = sinks.latest_versions(spark, out)
    return got.agg(F.sum("event_count").alias("events_kept"),
                   F.count(F.lit(1)).alias("keys")).select(
        "events_kept", "keys", F.lit(dropped > 0).alias("late_rows_dropped"))


# What the watermark has closed after all files: ends at or before it.
_CLOSED = "<= (SELECT max(event_time) FROM clickstream) - INTERVAL '10 minutes'"
_HOUR_COLS = ["window_start", "total_events", "unique_users", "views", "carts", "purchases", "removes",
              "sum_price", "n_priced"]


@register("stream_hourly_activity", normalized(
    "SELECT time_bucket(INTERVAL '1 hour', event_time) AS window_start, count(*) AS total_events, "
    "count(DISTINCT user_id) AS unique_users, "
    "count(*) FILTER (WHERE event_type = 'view') AS views, "
    "count(*) FILTER (WHERE event_type = 'cart') AS carts, "
    "count(*) FILTER (WHERE event_type = 'purchase') AS purchases, "
    "count(*) FILTER (WHERE event_type = 'remove_from_cart') AS removes, "
    "sum(price) AS sum_price, count(price) AS n_priced FROM clickstream GROUP BY 1 "
    f"HAVING time_bucket(INTERVAL '1 hour', event_time) + INTERVAL '1 hour' {_CLOSED}",
    _HOUR_COLS, dbl=("sum_price",), tss=("window_start",), ctes=BASE_CTES))
def q_stream_hourly_activity(spark, sf_dir):
    """Hourly activity on the stream with exact unique users, every hour
    that the watermark has closed, emitted once."""
    out, _ = _append_run(spark, sf_dir, sa.hourly_activity_stream, sa.flatten_window)
    return spark.read.parquet(out).select(*_HOUR_COLS)


def _append_run(spark, sf_dir, plan, shape=lambda df: df):
    """A stream in append mode over all staged files: (results, checkpoint)."""
    src = _staged(spark, sf_dir)
    out, ck = scratch_dir(spark, "stream-out"), scratch_dir(spark, "stream-ck")
    sa.use_rocksdb(spark)

    def sink(b, i):
        sinks.write_batch_parquet(shape(b), out, i)

    sinks.run_available_now(plan(_events(spark, src)), sink, ck, output_mode="append")
    return out, ck


_VISITS_SQL = """
SELECT user_id, min(event_time) AS visit_start, max(event_time) + INTERVAL '30 minutes' AS visit_end,
       count(*) AS events, count(*) FILTER (WHERE event_type = 'purchase') AS purchases
FROM (SELECT *, sum(CASE WHEN prev IS NULL OR event_time - prev >= INTERVAL '30 minutes'
                         THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_time, event_id)
                  AS visit
      FROM (SELECT user_id, event_time, event_id, event_type,
                   lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time, event_id) AS prev
            FROM clickstream WHERE user_id IS NOT NULL) AS a) AS b
GROUP BY user_id, visit"""
_VISIT_COLS = ["user_id", "visit_start", "visit_end", "events", "purchases"]


@register("stream_visits", normalized(
    f"SELECT * FROM ({_VISITS_SQL}) AS v WHERE visit_end {_CLOSED}", _VISIT_COLS,
    tss=("visit_start", "visit_end"), ctes=BASE_CTES))
def q_stream_visits(spark, sf_dir):
    """X2 on a stream: every visit that the watermark has closed, emitted once."""
    out, _ = _append_run(spark, sf_dir, sa.visits_stream)
    return spark.read.parquet(out).select(*_VISIT_COLS)


@register("stream_visit_state", normalized(
    f"SELECT user_id, count(*) AS open_visits FROM ({_VISITS_SQL}) AS v WHERE NOT visit_end {_CLOSED} "
    "GROUP BY user_id", ["user_id", "open_visits"], ctes=BASE_CTES))
def q_stream_visit_state(spark, sf_dir):
    """The state left after the stream holds the open visits only."""
    _, ck = _append_run(spark, sf_dir, sa.visits_stream)
    return sa.state_rows(spark, ck).groupBy(F.col("key.user_id").alias("user_id")).agg(
        F.count(F.lit(1)).alias("open_visits"))


@register("stream_window_state", normalized(
    f"SELECT * FROM ({_WINDOW_SQL}) AS w WHERE NOT window_end {_CLOSED}", _WINDOW_COLS, dbl=("price",),
    tss=("window_start", "window_end"), ctes=BASE_CTES))
def q_stream_window_state(spark, sf_dir):
    """R2 + R4: the state left after the stream: the windows that the
    watermark has not closed, with their counts, and no others."""
    _, ck = _window_run(spark, _staged(spark, sf_dir))
    state = sa.state_rows(spark, ck).select("key.*", F.col("value.count").alias("event_count"))
    return sa.flatten_window(state).select(*_WINDOW_COLS)


def _rec_stream(spark, sf_dir, per_batch=FILES_PER_BATCH):
    src = _staged(spark, sf_dir)
    out, ck = scratch_dir(spark, "stream-out"), scratch_dir(spark, "stream-ck")
    sa.use_rocksdb(spark)
    # The product side is a stored run: no micro-batch aggregates the history.
    base = scratch_dir(spark, "products")
    snapshots.write_snapshot(product_table(spark, sf_dir), base, "product_data", "20240101_000000")
    prods = snapshots.latest_snapshot(spark, base, "product_data")
    stream = sa.windowed_activity(_events(spark, src, per_batch))
    sinks.run_available_now(stream, sinks.RecommendationSink(prods, out), ck)
    return out


@register("stream_foreach_batch", normalized(
    "SELECT count(DISTINCT user_id) AS users, true AS within_limits FROM clickstream "
    "WHERE user_id IS NOT NULL", ["users", "within_limits"], ctes=BASE_CTES))
def q_stream_foreach_batch(spark, sf_dir):
    """R5 + R9 + R10 on a stream (property): every active user is served, and
    in no micro-batch with repeated or more than 10 products."""
    out = _rec_stream(spark, sf_dir)
    per = spark.read.parquet(f"{out}/recommendations").groupBy("batch_id", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("product_id").alias("d"))
    return per.agg(F.count_distinct("user_id").alias("users"),
                   F.bool_and((F.col("n") <= recommend.FALLBACK_PRODUCTS) & (F.col("n") == F.col("d")))
                   .alias("within_limits"))


_SINKS = {"activity": ("activity", "parquet", "activity"),
          "user_events": ("points/user_events", "parquet", "activity"),
          "recommendations": ("points/recommendations", "parquet", "recommendations"),
          "recommendations_csv": ("recommendations_csv", "csv", "recommendations")}


@register("stream_fanout", " UNION ALL ".join(
    f"SELECT '{name}' AS sink, true AS agrees" for name in _SINKS))
def q_stream_fanout(spark, sf_dir):
    """R11 (property): in every batch each sink has as many rows as the table
    it was written from."""
    out = _rec_stream(spark, sf_dir)

    def counted(path, fmt, name):
        reader = spark.read.option("header", True) if fmt == "csv" else spark.read
        return reader.format(fmt).load(f"{out}/{path}").groupBy(
            F.col("batch_id").cast("long").alias("batch_id")).agg(F.count(F.lit(1)).alias(name))

    res = None
    for name, (path, fmt, of) in _SINKS.items():
        pair = counted(of, "parquet", "want").join(counted(path, fmt, "got"), "batch_id", "full_outer")
        one = pair.agg(F.bool_and(F.col("want").eqNullSafe(F.col("got"))).alias("agrees")).select(
            F.lit(name).alias("sink"), "agrees")
        res = one if res is None else res.unionByName(one)
    return res


@register("stream_measurements", normalized(
    _METRIC_SQL, _METRIC_COLS, dbl=("field_value",), tss=("ts",), ctes=_METRIC_CTES))
def q_stream_measurements(spark, sf_dir):
    """X15 on a stream: the four dashboard measurements, kept up to date batch by
    batch and compacted half way, equal the batch query after the last file."""
    cs = clickstream(spark, sf_dir)
    runs, out, ck = (scratch_dir(spark, t) for t in ("runs", "measurements", "stream-ck"))
    stats = cleaning.cleaning_statistics(cs, rel_error=0.0)
    prods = products.product_data(cleaning.clean_events(cs, stats=stats), with_index=False)
    snapshots.write_run({measurements.STATISTICS: stats, measurements.PRODUCTS: prods}, runs, "20240101_000000")
    src, sink = scratch_dir(spark, "stream-src"), measurements.MeasurementSink(out, runs)
    t = 1_000_000_000_000
    first = day_filter(1, 15)
    log = measurements.MeasurementLog(spark, out)
    for prefix, part in (("a", first), ("b", ~first)):
        t = stage_event_files(cs.filter(part), src, STREAM_FILES // 2, prefix=prefix, start_mtime_ms=t)
        sinks.run_available_now(_events(spark, src), sink, ck, output_mode="append")
        if prefix == "a":
            log.compact()
    before, after = F.dayofweek("first_seen") - 1, F.dayofweek("last_seen") - 1
    stored = snapshots.latest_run(spark, runs)[measurements.PRODUCTS]
    return points.flatten_points(log.points(stored, before, after))


@register("stream_batch_equality", normalized(
    "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS only_stream, CAST(0 AS BIGINT) AS only_batch "
    "FROM recs", ["rows", "only_stream", "only_batch"], ctes=_REC_CTES))
def q_stream_batch_equality(spark, sf_dir):
    """R9 (property): one micro-batch of all files gives exactly the batch
    recommendations (same function on both paths)."""
    out = _rec_stream(spark, sf_dir, per_batch=STREAM_FILES)
    got = spark.read.parquet(f"{out}/recommendations").drop("batch_id")
    want = recs(spark, sf_dir)
    # mean prices summed in another order differ in their last digits
    got, want = (df.withColumns({c: F.round(c, 6) for c in ("rec_score", "avg_price")}) for df in (got, want))
    only_got = got.exceptAll(want).agg(F.count(F.lit(1)).alias("n")).scalar()
    only_want = want.exceptAll(got).agg(F.count(F.lit(1)).alias("n")).scalar()
    return got.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", only_got.alias("only_stream"), only_want.alias("only_batch"))


@register("empty_on_missing", normalized(
    "SELECT user_id, product_id, count(*) AS interaction_count, CAST(NULL AS BIGINT) AS total_purchases "
    "FROM clickstream GROUP BY user_id, product_id",
    ["user_id", "product_id", "interaction_count", "total_purchases"], ctes=BASE_CTES))
def q_empty_on_missing(spark, sf_dir):
    """Interactions left-joined to a product table that is not there
    yet: read as empty, so every row stays without product columns."""
    schema = T.StructType([T.StructField("product_id", T.LongType()),
                           T.StructField("total_purchases", T.LongType())])
    missing = files.read_or_empty(spark, scratch_dir(spark, "absent"), schema)
    acts = recommend.user_product_interactions(clickstream(spark, sf_dir)).select(
        "user_id", "product_id", "interaction_count")
    return acts.join(missing, "product_id", "left").select(
        "user_id", "product_id", "interaction_count", "total_purchases")
