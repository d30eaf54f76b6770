"""The corpus pipeline, stage by stage."""

import corpus_pipeline
from helpers import awkward, nothing

from cartwheel.functions.sizing import materialize

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF))
        sizes.append(docs.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert sizes[1] < sizes[0] and sizes[2] == sizes[1] and sizes[3] < sizes[2] and sizes[5] == sizes[4]
    assert docs.columns[:len(columns)] == columns and docs.filter("NOT round_trip").count() == 0
    assert corpus_pipeline.run(spark, SF).count() == sizes[-1]


def test_stages_take_awkward_and_no_rows(spark):
    for docs in (awkward(spark), nothing(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = materialize(stage(spark, materialize(docs), SF))
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns


def test_quality_stage_keeps_the_documents_that_are_labelled_good(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = corpus_pipeline.quality(spark, docs, sf).select("doc_id")
    good, bad = (labels.filter(f"quality = {q}").select("doc_id") for q in (1, 0))
    assert good.join(kept, "doc_id").count() > 0.98 * good.count()
    assert bad.join(kept, "doc_id").count() < 0.1 * bad.count()
