"""The corpus pipeline: five stages from raw documents to piece numbers.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; ``run`` writes every stage's result as Parquet into the folder named by
``spark.checkpoint.dir`` and rereads it. All stages but the last return the
columns of ``documents``. Nulls, empty and long texts, repeated rows and
empty tables are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.functions.sizing import materialize
from cartwheel.llm.common import read_table
from cartwheel.llm.line_dedup import line_dedup
from cartwheel.llm.mixing import mix
from cartwheel.llm.quality import fit_quality, score_quality
from cartwheel.llm.queries import PIECE_MODEL
from cartwheel.llm.sentencepiece_fst import encode, load_model
from cartwheel.llm.simhash import keep_one_of_each


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"))
    scored = score_quality(docs, model, columns=tuple(docs.columns))
    return scored.filter("predicted = 1").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without repeated chunks of lines; n_chars follows."""
    cleaned = line_dedup(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)
    return cleaned


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one_of_each(docs, words=3, max_bits=3)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights, as many tokens as there are; a document
    appears once for every epoch in which it is chosen."""
    return mix(docs, share=(1, 1)).select("row.*")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their piece numbers, and whether these decode to
    the text."""
    return encode(docs, load_model(PIECE_MODEL), columns=tuple(docs.columns), ids_col="piece_ids",
                  round_trip_col="round_trip")


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("SentencePiece encoding and decoding", pieces),
]

# The classifier, XXH64 fingerprints and the vocabulary are not SQL: the
# stages are tested against brute-force versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after another, over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
