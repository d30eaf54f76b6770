"""Quality classifier: naive Bayes support vectors (Wang and Manning, 2012).

Indicators of hashed byte n-grams, and of how often words and lines repeat
(n-grams whose second part is "the same again"), are scaled by the log ratio
of their class frequencies, and a hinge-loss linear model is fitted on the
scaled indicators by dual coordinate descent. The fit uses a bounded sample: of each class the
``fit_rows`` labelled training rows whose hashed id is smallest. Only these
rows are joined to their texts (the sample's ids are the broadcast side, at
most 2 * fit_rows rows). Scoring reads every whole text once, without a
shuffle; the model that tasks receive has two numbers a feature.

Rows: null and empty texts have no n-gram and are scored by the indicators of
their length; repeated rows are scored alike; labels that contradict each other are not
learned from; without labels of both classes every score is 0.5 (or 0 or 1
where only one class is known). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import id_remainder, smallest_ids
from cartwheel.llm.ngrams import GramSet, gram_rows, sigmoid, train_svm

FOLDS, HELD_OUT = 3, 1  # crc32(doc_id) mod 3 = 1 is held out
SHARES = (0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9)
EXTRA = 3 * len(SHARES) + 33  # indicators beside the n-grams


def repetition(data: bytes) -> list[int]:
    """Numbers (below EXTRA) of the indicators that hold for a text: which of
    SHARES the share of words equal to the word before exceeds, the same for
    lines that occurred before and for words that occurred before in the
    text, and the binary order of the number of words."""
    words = data.split()
    lines = [x for x in data.split(b"\n") if x]
    n = len(words)
    again = (sum(map(eq, words, words[1:])) / (n - 1) if n > 1 else 0.0,
             1 - len(set(lines)) / len(lines) if lines else 0.0,
             1 - len(set(words)) / n if n else 0.0)
    out = [k * len(SHARES) + i for k, share in enumerate(again) for i, least in enumerate(SHARES) if share > least]
    return [*out, 3 * len(SHARES) + min(n.bit_length(), 32)]


class Features:
    """Feature numbers of a text: n-gram buckets, then the indicators."""

    def __init__(self, bits: int, sizes: tuple[int, ...]) -> None:
        self.grams = GramSet(bits, sizes)
        self.size = 1 << bits

    def __call__(self, data: bytes) -> np.ndarray:
        more = np.array(repetition(data), np.int32) + np.int32(self.size)
        return np.concatenate([self.grams(data), more])


@dataclass(frozen=True)
class QualityModel:
    bits: int
    sizes: tuple[int, ...]
    ratio: np.ndarray  # log-count ratio of each bucket
    weights: np.ndarray  # of the scaled indicators; the bias is last
    slope: float  # margin -> log odds

    def score(self, grams: np.ndarray) -> float:
        scaled = self.ratio[grams]
        norm = np.sqrt(scaled @ scaled)
        margin = (self.weights[grams] @ scaled) / norm if norm > 0 else 0.0
        return float(sigmoid(self.slope * (margin + self.weights[-1])))


def fit_model(sets: list[np.ndarray], labels: np.ndarray, bits: int, sizes: tuple[int, ...]) -> QualityModel:
    """Model from n-gram sets and 0/1 labels."""
    size = (1 << bits) + EXTRA
    counts = np.ones((2, size))
    for grams, label in zip(sets, labels, strict=True):
        counts[int(label), grams] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    y = np.where(labels == 1, 1.0, -1.0)
    known = {int(v) for v in labels}
    if known != {0, 1}:  # nothing to tell apart
        bias = {(): 0.0, (0,): -30.0, (1,): 30.0}[tuple(known)]
        return QualityModel(bits, sizes, ratio, np.append(np.zeros(size), bias), 1.0)
    share = np.where(y > 0, 0.5 / (y > 0).mean(), 0.5 / (y < 0).mean())
    weights = train_svm(sets, y, ratio, size, costs=share)
    return QualityModel(bits, sizes, ratio, weights, 3.0)


def fit_quality(docs: DataFrame, labels: DataFrame, fit_rows: int = 2500, bits: int = 18,
                sizes: tuple[int, ...] = (2, 3, 4)) -> QualityModel:
    """Learn ``labels.quality`` from the training rows; ``fit_rows`` rows of
    each class at most."""
    known = (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
             .filter((F.col("low") == F.col("high")) & (id_remainder(F.col("doc_id"), FOLDS) != HELD_OUT))
             .select("doc_id", F.col("low").cast("int").alias("quality")))
    sample = smallest_ids(known, "quality", "doc_id", fit_rows)
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
             .join(F.broadcast(sample), "doc_id").select("text", "quality", "doc_id"))
    table = gram_rows(texts, lambda: Features(bits, sizes), "grams binary, quality int, doc_id long").toArrow()
    # The driver keeps the sample once, as it came, and only while it is fitted.
    order = pc.sort_indices(table, [(c, "ascending") for c in ("doc_id", "grams", "quality")]).to_pylist()
    model = _fit_table(table, order, bits, tuple(sizes))
    del table
    pa.default_memory_pool().release_unused()
    return model


def _fit_table(table: pa.Table, order: list[int], bits: int, sizes: tuple[int, ...]) -> QualityModel:
    """Model from the rows of (grams, quality), which are not copied."""
    grams = table["grams"]
    sets = [np.frombuffer(grams[i].as_buffer(), np.int32) for i in order]
    return fit_model(sets, table["quality"].to_numpy()[order].astype(np.int64), bits, sizes)


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text",
                  columns: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; with ``columns``,
    also those input columns, packed as the struct ``row``."""
    text, doc_id = F.col(text_col).cast("string"), F.col(id_col).cast("long")
    row = F.struct(*[F.col(f"`{c}`") for c in columns]) if columns else F.lit(None).cast("boolean")
    # The text is sent to the tasks once, also where it is among the columns.
    inside = list(columns).index(text_col) if text_col in columns else None
    rows = docs.select(row.alias("row"), doc_id.alias("doc_id"),
                       *([text.alias("text")] if inside is None else []))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        features = Features(m.bits, m.sizes)
        for batch in batches:
            texts = batch.column(2) if inside is None else batch.column(0).field(inside)
            scores = [m.score(features((texts[i].as_py() or "").encode("utf-8", "surrogatepass")))
                      for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(scores, pa.float64())],
                schema=pa.schema([*list(batch.schema)[:2], pa.field("score", pa.float64())]))

    kind = rows.schema["row"].dataType.simpleString()
    scored = rows.mapInArrow(run, f"row {kind}, doc_id long, score double")
    return scored.select("doc_id", (id_remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         *(["row"] if columns else []))
