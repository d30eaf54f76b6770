"""Hierarchical language identification.

A first set of linear models predicts the language family of a text; within
the family, one-versus-one linear support vector machines tell the languages
apart by majority vote (ties by summed margins, then by name). Features are
indicators of hashed byte n-grams of the lower-cased text. The fit uses a
bounded sample, of each language the ``fit_rows`` training documents whose
hashed id is smallest; their ids are the broadcast side of one join. Scoring
reads every whole text once, without a shuffle.

Rows: a text that is null or has no letter is ``und`` with score 0, and so is
every text if nothing was learned; if one language was learned it is always
predicted; repeated rows are predicted alike; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import id_remainder, smallest_ids
from cartwheel.llm.ngrams import GramSet, gram_rows, sigmoid, train_svm

FOLDS, HELD_OUT = 5, 0  # crc32(doc_id) mod 5 = 0 is held out
UNDETERMINED = "und"
SLOPE = 3.0  # margin -> log odds

# Families of common languages (fixed values, ISO 639-1 codes). A language
# that is not listed is a family of its own.
FAMILIES: dict[str, tuple[str, ...]] = {
    "germanic": ("af", "da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "finnic": ("et", "fi"),
    "turkic": ("az", "kk", "tr", "uz"),
    "indic": ("bn", "hi", "mr", "ne", "ur"),
    "semitic": ("ar", "he", "mt"),
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}


@dataclass(frozen=True)
class LanguageModel:
    bits: int
    sizes: tuple[int, ...]
    families: tuple[tuple[str, ...], ...]  # languages of each family
    family_weights: np.ndarray  # one row a family (one-versus-rest)
    pairs: tuple[tuple[tuple[int, int], ...], ...]  # of languages in each family
    pair_weights: tuple[np.ndarray, ...]  # one row a pair; positive: the first

    def predict(self, grams: np.ndarray) -> tuple[str, float]:
        if not self.families:
            return UNDETERMINED, 0.0
        scale = 1.0 / np.sqrt(max(1, len(grams)))
        family, sure = 0, 1.0
        if len(self.families) > 1:
            margins = self.family_weights[:, grams].sum(axis=1) * scale + self.family_weights[:, -1]
            family = int(np.argmax(margins))
            chances = sigmoid(SLOPE * margins)
            sure = float(chances[family] / chances.sum())
        langs = self.families[family]
        if len(langs) == 1:
            return langs[0], sure
        weights = self.pair_weights[family]
        margins = weights[:, grams].sum(axis=1) * scale + weights[:, -1]
        votes, total, chance = np.zeros(len(langs)), np.zeros(len(langs)), np.zeros(len(langs))
        for (a, b), margin in zip(self.pairs[family], margins, strict=True):
            votes[a if margin >= 0 else b] += 1
            total[a] += margin
            total[b] -= margin
            chance[a] += sigmoid(SLOPE * margin)
            chance[b] += 1 - sigmoid(SLOPE * margin)
        best = max(range(len(langs)), key=lambda i: (votes[i], total[i], -i))
        return langs[best], sure * float(chance[best] / (len(langs) - 1))


def fit_model(sets: list[np.ndarray], langs: list[str], bits: int, sizes: tuple[int, ...]) -> LanguageModel:
    size = 1 << bits
    names = sorted(set(langs))
    grouped: dict[str, list[str]] = {}
    for name in names:
        grouped.setdefault(FAMILY_OF.get(name, f"only {name}"), []).append(name)
    families = tuple(tuple(v) for _, v in sorted(grouped.items()))
    of = {name: i for i, members in enumerate(families) for name in members}

    def machine(rows: list[int], positive) -> np.ndarray:
        y = np.array([1.0 if positive(i) else -1.0 for i in rows])
        share = np.where(y > 0, 0.5 / (y > 0).mean(), 0.5 / (y < 0).mean())
        return train_svm([sets[i] for i in rows], y, None, size, costs=share)

    everything = list(range(len(sets)))
    if len(families) == 2:  # one machine, its mirror image is the other's
        first = machine(everything, lambda i: of[langs[i]] == 0)
        family_weights = np.stack([first, -first])
    elif families:
        family_weights = np.stack([machine(everything, lambda i, f=f: of[langs[i]] == f)
                                   for f in range(len(families))]) if len(families) > 1 else np.zeros((1, size + 1))
    else:
        family_weights = np.zeros((0, size + 1))
    pairs, pair_weights = [], []
    for members in families:
        own = list(combinations(range(len(members)), 2))
        pairs.append(tuple(own))
        pair_weights.append(np.stack([
            machine([i for i in everything if langs[i] in (members[a], members[b])],
                    lambda i, a=members[a]: langs[i] == a) for a, b in own])
            if own else np.zeros((0, size + 1)))
    return LanguageModel(bits, tuple(sizes), families, family_weights, tuple(pairs), tuple(pair_weights))


def fit_language(docs: DataFrame, fit_rows: int = 1000, bits: int = 16,
                 sizes: tuple[int, ...] = (1, 2, 3)) -> LanguageModel:
    """Learn text -> lang from the training documents; ``fit_rows`` documents
    of each language at most."""
    known = (docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
             .select(F.col("doc_id").cast("long").alias("doc_id"), "lang")
             .filter(id_remainder(F.col("doc_id"), FOLDS) != HELD_OUT)
             .distinct())
    sample = smallest_ids(known, "lang", "doc_id", fit_rows)
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"))
             .join(F.broadcast(sample), "doc_id").select("text", "lang", "doc_id"))
    table = gram_rows(texts, lambda: GramSet(bits, sizes), "grams binary, lang string, doc_id long").toArrow()
    rows = sorted(zip(table["doc_id"].to_pylist(), table["lang"].to_pylist(),
                      table["grams"].to_pylist(), strict=True))
    return fit_model([np.frombuffer(g, np.int32) for _, _, g in rows], [x for _, x, _ in rows],
                     bits, tuple(sizes))


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.when(text.rlike(r"\p{L}"), F.lower(text)).alias("text"),
                       F.col(id_col).cast("long").alias("doc_id"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        grams = GramSet(m.bits, m.sizes)
        for batch in batches:
            texts = batch.column(0)
            found = [m.predict(grams(t.encode("utf-8", "surrogatepass"))) if (t := texts[i].as_py()) else
                     (UNDETERMINED, 0.0) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([x for x, _ in found], pa.string()),
                 pa.array([s for _, s in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    out = rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", (id_remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
                      "lang_pred", "score")
