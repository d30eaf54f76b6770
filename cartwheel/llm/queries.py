"""Registered queries of the package and their DuckDB SQL.

``queries()`` and ``oracle_sql()`` are merged into the driver contract by
``__spark_entry__`` when this package can be imported.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.llm.ball_tree import RANKED_SEARCH_SQL, ranked_search
from cartwheel.llm.common import read_table
from cartwheel.llm.conversation_repair import damage, repair
from cartwheel.llm.exact_dedup import exact_dedup
from cartwheel.llm.language import fit_language, identify
from cartwheel.llm.line_dedup import line_dedup, line_dedup_sql
from cartwheel.llm.log_bilinear import score_texts
from cartwheel.llm.mixing import mix, mixing_sql
from cartwheel.llm.quality import fit_quality, score_quality
from cartwheel.llm.secrets import scan_secrets
from cartwheel.llm.sentencepiece_fst import encode, load_model
from cartwheel.llm.simhash import near_duplicates, to_hex
from cartwheel.llm.vp_tree import nearest_neighbours
from cartwheel.llm.wavelet import new_folder, read_documents, write_ids

# Vocabularies of public tokenizers, read by the driver.
PIECE_MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
WORD_TOKENIZER = os.environ.get("WORD_TOKENIZER", "/opt/tokenizers/word_bpe_49k.json")
END_ID = 1  # appended to each document

Query = Callable[[SparkSession, str], DataFrame]


def op1_vp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every 20th by inner product."""
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), every=20, k=20, factor=0.2)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole document: family, then one-versus-one SVMs."""
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, fit_language(docs))


def op3_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every whole document by a log-bilinear model."""
    return score_texts(read_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and epochs chosen by hierarchical token budgets."""
    return mix(read_table(spark, sf_dir, "documents")).select(
        "row.doc_id", "domain", "lang", "source", "epoch", "n_tokens", "leaf_budget")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents without globally repeated chunks of lines."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs, count_col="removed_lines").select(
        "doc_id", "removed_lines", F.length("text").alias("n_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in whole documents: patterns, and costly guesses in context."""
    return scan_secrets(read_table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates by SimHash: 3-word shingles, 3 bits or fewer."""
    found = near_duplicates(read_table(spark, sf_dir, "documents"), words=3, max_bits=3)
    return found.select("doc_id", to_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece numbers of every whole document, and whether decoding them gives
    the document back."""
    coded = encode(read_table(spark, sf_dir, "documents"), load_model(PIECE_MODEL), round_trip_col="round_trip")
    joined = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"),
                        F.when(F.col("ids").isNotNull(), F.sha2(joined.cast("binary"), 256)).alias("ids_sha256"),
                        "round_trip")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole document by naive Bayes support vectors."""
    docs = read_table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, read_table(spark, sf_dir, "labels")))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of whole documents after white-space normalisation."""
    return exact_dedup(read_table(spark, sf_dir, "documents"))


def op11_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token numbers of every whole document, written as wavelet-matrix files
    and read back from them."""
    path = new_folder(spark)
    with open(WORD_TOKENIZER, encoding="utf-8") as f:
        write_ids(read_table(spark, sf_dir, "documents"), path, f.read(), END_ID)
    return read_documents(spark, path)


def op12_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents of each benchmark item that score highest."""
    return ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=20)


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest structural repair of every damaged conversation."""
    return repair(damage(read_table(spark, sf_dir, "conversations")), copies_col="copies")


EXACT_DEDUP_SQL = r"""
WITH norm AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
  FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept,
       sha256(t) AS text_sha256
FROM norm
"""

QUERIES: dict[str, Query] = {
    "op1_vp_tree": op1_vp_tree,
    "op2_language_id": op2_language_id,
    "op3_log_bilinear": op3_log_bilinear,
    "op4_mixing": op4_mixing,
    "op5_line_dedup": op5_line_dedup,
    "op6_secrets": op6_secrets,
    "op7_simhash": op7_simhash,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_quality": op9_quality,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_wavelet": op11_wavelet,
    "op12_ball_tree": op12_ball_tree,
    "op13_repair": op13_repair,
}

SQL: dict[str, str] = {
    "op4_mixing": mixing_sql(),
    "op5_line_dedup": line_dedup_sql(),
    "op10_exact_dedup": EXACT_DEDUP_SQL,
    "op12_ball_tree": RANKED_SEARCH_SQL,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
