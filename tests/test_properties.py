"""Property checks of the queries on fitted models and streams."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from cartwheel.operators import als, segmentation
from cartwheel.plans import queries_model
from support import SF_SMALL


def q(spark, name):
    return entry.queries()[name](spark, SF_SMALL)


def test_kmeans_labels_are_nearest_centres(spark):
    df = q(spark, "kmeans_segments")
    assert df.count() > 0
    assert df.filter(~F.col("nearest")).count() == 0


def test_segment_users_named(spark):
    _, df = segmentation.segment_users(queries_model._user_features(spark, SF_SMALL))
    assert df.filter(F.col("segment").isNull()).count() == 0
    assert df.select("segment_id").distinct().count() <= 5
    named = q(spark, "segment_users")
    assert named.count() > 0 and named.filter(~F.col("named_by_profile")).count() == 0


def test_reloaded_pipeline_classifies_alike(spark):
    df = q(spark, "classify_new_users")
    assert df.count() > 0 and df.filter(~F.col("same_segment")).count() == 0


def test_als_properties(spark):
    fit = q(spark, "als_fit")
    assert fit.filter((F.col("rank") != 50) | ~F.col("non_negative")).count() == 0
    top = q(spark, "als_top_n")
    assert top.filter((F.col("n_items") > 10) | ~F.col("no_repeats") | ~F.col("descending")
                      ).count() == 0
    model, m, test, users, prods = queries_model._fit(spark, SF_SMALL)
    r = als.rmse_frame(als.predictions(model, test)).first()
    assert r.n_test > 0 and r.rmse >= 0
    ids = als.recs_to_ids(als.top_n(model, m), users, prods)
    assert ids.filter(F.col("user_id").isNull() | F.col("product_id").isNull()).count() == 0
    checked = q(spark, "als_rmse").first()
    assert checked.n_test == r.n_test and checked.as_evaluated and checked.in_range


def test_model_roundtrip_same_predictions(spark):
    df = q(spark, "model_roundtrip")
    assert df.count() > 0 and df.filter(~F.col("same")).count() == 0


def test_stream_update_mode_last_is_final(spark):
    df = q(spark, "stream_update_mode")
    assert df.count() > 0 and df.filter(~F.col("grows")).count() == 0


def test_stream_watermark_drops_late_file(spark):
    r = q(spark, "stream_watermark").first()
    # every event is on time once; the replayed day 3 is late
    assert r.events_kept == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert r.late_rows_dropped


def test_stream_equals_batch(spark):
    r = q(spark, "stream_batch_equality").first()
    assert r.rows > 0 and r.only_stream == 0 and r.only_batch == 0


def test_stream_fanout_writes_every_sink(spark):
    sinks = {r.sink for r in q(spark, "stream_fanout").collect()}
    assert sinks == {"activity", "user_events", "recommendations", "recommendations_csv"}


def test_realtime_metrics_measurements(spark):
    m = {r.measurement for r in q(spark, "realtime_metrics").select("measurement").distinct()
         .collect()}
    assert m == {"user_behavior", "segment_evolution", "recommendation_metrics",
                 "product_popularity"}
