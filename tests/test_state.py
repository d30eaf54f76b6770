"""Sketch state, cross-validation folds, and measurements of a stream."""

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import cleaning, evaluation, incremental, recommend, sketches
from cartwheel.sources import snapshots
from cartwheel.streaming import measurements, sinks
from cartwheel.streaming.activity import read_event_stream
from cartwheel.streaming.files import stage_event_files
from cartwheel.sources.files import CSV_NULL
from test_hazards import ev, frame


def events(spark, n=400):
    """Ten days of events, with a NULL user, category, brand and price now and then."""
    return frame(spark, [
        ev(i, i * 36, ["view", "cart", "purchase"][i % 3], [None, "a.b", "c", "d"][i % 4], ["x", "y", None][i % 5 % 3],
           None if i % 11 == 0 else float(i % 17 + 1), user=None if i % 13 == 0 else f"u{i % 7}",
           product=i % 9, session=f"s{i % 20}") for i in range(n)])


def test_sketches_merge_in_any_order(spark):
    raw = events(spark)
    cl = cleaning.clean_events(raw, rel_error=0.0)
    parts = [F.col("event_id") % 3 == i for i in range(3)]
    a, b, c = (sketches.partial_state(cl.filter(p), raw.filter(p)) for p in parts)
    left = sketches.merge_states([sketches.merge_states([a, b]), c])
    right = sketches.merge_states([a, sketches.merge_states([c, b])])
    cols = ["user_id", "total_events", "purchases", "first_seen", *incremental.DISTINCT_KINDS]
    got = sorted(map(str, sketches.user_estimates(left[0]).select(*cols).collect()))
    assert got == sorted(map(str, sketches.user_estimates(right[0]).select(*cols).collect()))
    # so few values are counted exactly; the NULL user is one user
    exact = incremental.finalize(incremental.partial_state(cl))
    assert got == sorted(map(str, exact.select(*cols).collect()))
    whole = sketches.distinct_totals(left[0]).first()
    assert (whole.unique_products, whole.unique_sessions) == (9, 20)
    means = {r.category_code: (round(r.avg_cat_price, 9), r.first_brand)
             for r in sketches.cleaning_statistics(left[1]).collect()}
    want = cleaning.cleaning_statistics(raw, rel_error=0.0).collect()
    assert means == {r.category_code: (round(r.avg_cat_price, 9), r.first_brand) for r in want}


def test_sketch_errors_stay_in_their_bounds(spark):
    n = 200_000
    raw = spark.range(n).select(
        F.col("id").alias("event_id"), F.timestamp_seconds("id").alias("event_time"), F.lit("view").alias("event_type"),
        F.col("id").alias("product_id"), F.lit("a").alias("category_code"), F.lit("x").alias("brand"),
        (F.col("id") + 1).cast("double").alias("price"), F.lit("u").alias("user_id"),
        F.concat(F.lit("s"), F.col("id") % 50_000).alias("user_session"))
    states = [sketches.partial_state(p, p) for p in (raw.filter("event_id % 2 = 0"), raw.filter("event_id % 2 = 1"))]
    users, categories = sketches.merge_states(states)
    u = sketches.user_estimates(users).first()
    assert abs(u.unique_products - n) < 0.08 * n and abs(u.unique_sessions - 50_000) < 0.08 * 50_000
    q = sketches.cleaning_statistics(categories).first()
    assert abs(q.q1 / n - 0.25) < 0.01 and abs(q.q3 / n - 0.75) < 0.01 and q.avg_cat_price == (n + 1) / 2


def test_sketches_of_nothing_and_of_nulls(spark, tmp_path):
    nothing = frame(spark, [])
    users, categories = sketches.partial_state(nothing, nothing)
    assert users.count() == 0 and sketches.cleaning_statistics(categories).count() == 0
    unpriced = frame(spark, [ev(1, 0, "view", "a", None, None)])
    base = f"file://{tmp_path}/state"
    assert sketches.load_state(spark, base) is None
    sketches.update_state(spark, nothing, nothing, base, "20240101_000000")
    state = sketches.update_state(spark, unpriced, unpriced, base, "20240102_000000")
    r = sketches.cleaning_statistics(state[1]).first()
    assert (r.avg_cat_price, r.first_brand, r.q1, r.q3) == (None, None, None, None)
    cleaned = cleaning.clean_events(frame(spark, [ev(2, 5, "view", "a", None, 3.0)]),
                                    stats=sketches.cleaning_statistics(state[1])).first()
    assert (cleaned.brand, cleaned.price) == ("generic", 3.0)


def test_folds_never_train_on_later_days(spark):
    raw = events(spark)
    cl = cleaning.clean_events(raw, rel_error=0.0)
    seen = []

    def candidate(activity, products):
        seen.append(activity.agg(F.max(F.dayofmonth("event_time")).alias("d")).first().d)
        return recommend.recommend(activity, products)

    day = F.dayofmonth("event_time")
    folds = [(day < 4, (day >= 4) & (day < 7)), (day < 7, day >= 7), (day < 7, day > 40)]
    got = evaluation.cross_validate(cl, raw, folds, {"one": candidate, "two": candidate}).collect()
    assert seen == [3, 3, 6, 6, 6, 6] and len(got) == 6
    by = {(r.fold, r.candidate): r for r in got}
    # the NULL user counts as one, without hits
    assert by[0, "one"].users == 8 and by[2, "one"].users == 0 and by[2, "one"].ndcg_at_k is None
    want = (by[0, "one"].ndcg_at_k + by[1, "one"].ndcg_at_k) / 2
    assert by[2, "two"].mean_ndcg == pytest.approx(want)


@pytest.fixture
def staged(spark, tmp_path):
    raw = events(spark)
    runs, src = f"file://{tmp_path}/runs", f"file://{tmp_path}/src"
    snapshots.write_run({measurements.STATISTICS: cleaning.cleaning_statistics(raw, rel_error=0.0)}, runs,
                        "20240101_000000")
    stage_event_files(raw, src, 4)
    stream = read_event_stream(spark, src, nullValue=CSV_NULL)
    return raw, runs, stream, f"file://{tmp_path}/out", f"file://{tmp_path}/ck"


def assert_whole(log, raw):
    from cartwheel.operators.products import product_popularity
    from cartwheel.operators.timeseries import hourly_activity

    cl = cleaning.clean_events(raw, rel_error=0.0)
    for got, want, key in ((log.hourly_activity(), hourly_activity(cl), "hour_bucket"),
                           (log.product_popularity(), product_popularity(cl), "product_id")):
        got, want = ({r[key]: {k: round(v, 6) if isinstance(v, float) else v for k, v in r.asDict().items()}
                      for r in df.collect()} for df in (got, want))
        assert got == want
    assert log.users().count() == 8  # the NULL user is one


def test_measurements_by_a_processing_time_trigger(spark, staged):
    raw, runs, stream, out, ck = staged
    log = measurements.MeasurementLog(spark, out)
    q = sinks.start(stream, measurements.MeasurementSink(out, runs), ck, "append", trigger="1 second")
    try:
        q.processAllAvailable()
        assert_whole(log, raw)
    finally:
        q.stop()
    assert sum(p["numInputRows"] > 0 for p in q.recentProgress) == 4  # one file a trigger


def test_replayed_torn_and_compacted_batches_count_once(spark, staged):
    raw, runs, _, out, _ = staged
    log = measurements.MeasurementLog(spark, out)
    sink = measurements.MeasurementSink(out, runs)
    assert log.compact() == -1
    parts = [raw.filter(F.col("event_id") % 3 == i) for i in range(3)]
    sink(parts[0], 0)
    sink(parts[0], 0)
    # killed after the first table of batch 1: nothing of it is read or compacted
    rows = measurements._rows(parts[1], cleaning.clean_events(parts[1], rel_error=0.0))["hours"]
    sinks.write_batch_parquet(rows, f"{out}/hours", 1)
    assert log.table("hours").agg(F.sum("total_events")).first()[0] == parts[0].count()
    assert log.compact() == 0
    sink(parts[0], 0)  # a replay of a compacted batch
    sink(parts[1], 1)
    sink(frame(raw.sparkSession, []), 2)
    sink(parts[2], 3)
    assert_whole(log, raw)
    assert log.compact() == 3 and log.compact() == 3
    assert_whole(log, raw)


def test_a_micro_batch_is_served_in_few_tasks_and_replayed(spark, tmp_path):
    """Every sink ran in as many tasks as the state has partitions."""
    from cartwheel.streaming.activity import ACTIVITY_KEYS

    micro = spark.newSession()  # as Spark sets a micro-batch's session up
    micro.conf.set("spark.sql.adaptive.enabled", "false")
    micro.conf.set("spark.sql.shuffle.partitions", "40")
    batch = micro.range(400).selectExpr(
        "struct(timestamp_seconds(id) AS start, timestamp_seconds(id + 300) AS end) AS window",
        "concat('u', id % 100) AS user_id", "id % 9 AS product_id", "'view' AS event_type",
        "if(id % 3 = 0, NULL, concat('c', id % 3, '.x')) AS category_code", "'b' AS brand", "1.0D AS price").groupBy(
        "window", *ACTIVITY_KEYS).agg(F.count(F.lit(1)).alias("event_count"))
    prods = spark.createDataFrame([(i, 5 + i, 1.0, f"c{i % 3}", "b") for i in range(9)],
                                  "product_id long, total_purchases long, avg_price double, main_category_code string, "
                                  "main_brand string")
    out = str(tmp_path / "out")
    sink = sinks.RecommendationSink(prods, out)
    for _ in range(2):  # a replay replaces the batch
        sink(batch, 3)
    sink(batch.limit(0), 4)
    want = recommend.recommend(sinks.flatten_window(batch), prods)
    got = {n: spark.read.parquet(f"{out}/{n}") for n in ("activity", "recommendations", "points/user_events",
                                                         "points/recommendations")}
    assert {n: df.count() for n, df in got.items()} == dict(zip(got, (400, n := want.count(), 400, n), strict=True))
    assert {r.batch_id for df in got.values() for r in df.select("batch_id").distinct().collect()} == {3}
    rows = [c for c in got["recommendations"].columns if c != "batch_id"]
    assert sorted(map(str, got["recommendations"].select(*rows).collect())) == sorted(map(str, want.select(*rows).collect()))
    for name in ("recommendations", "points/recommendations", "points/user_events"):
        assert len(list((tmp_path / "out" / name / "batch_id=3").glob("part-*"))) <= 10, name
