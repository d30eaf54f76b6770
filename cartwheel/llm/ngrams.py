"""Hashed byte n-grams and a linear support vector machine, in numpy.

Shared by the language and quality classifiers. Models are dense arrays of a
fixed number of buckets, so what is sent to the tasks has a fixed size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK = 1 << 18  # bytes of a text hashed at a time; n-grams across blocks count


class GramSet:
    """The distinct hashed n-grams of a text, as bucket numbers.

    ``last`` remembers, per bucket, where the current text last had it, which
    gives the distinct buckets in linear time without clearing.
    """

    def __init__(self, bits: int, sizes: Sequence[int]) -> None:
        self.bits, self.sizes = bits, tuple(sizes)
        self.last = np.zeros(1 << bits, np.int64)

    def __call__(self, data: bytes) -> np.ndarray:
        found = [self._distinct(self._codes(part)) for part in self._blocks(data)]
        if len(found) == 1:
            return found[0]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int32)

    def _blocks(self, data: bytes) -> Iterator[np.ndarray]:
        raw = np.frombuffer(data, np.uint8)
        overlap = max(self.sizes) - 1
        for start in range(0, len(raw), BLOCK):
            yield raw[start:start + BLOCK + overlap]

    def _codes(self, raw: np.ndarray) -> np.ndarray:
        wide = raw.astype(np.uint32)
        out, code = [], np.zeros(len(wide), np.uint32)
        for size in range(1, max(self.sizes) + 1):
            n = len(wide) - size + 1
            if n <= 0:
                break
            code = (code[:n] << np.uint32(8)) ^ wide[size - 1:]  # the last four bytes at most
            if size in self.sizes:
                # Fibonacci hashing of the bytes and their number.
                mixed = (code ^ np.uint32(size * 0x9E37)) * np.uint32(2654435769)
                out.append((mixed >> np.uint32(32 - self.bits)).astype(np.int32))
        return np.concatenate(out) if out else np.zeros(0, np.int32)

    def _distinct(self, codes: np.ndarray) -> np.ndarray:
        at = np.arange(len(codes))
        self.last[codes] = at
        return codes[self.last[codes] == at]


def gram_rows(docs: DataFrame, features: Callable[[], Callable[[bytes], np.ndarray]], schema: str) -> DataFrame:
    """(text, label...) rows -> the text replaced by its feature numbers as a
    binary of int32. ``schema`` names the output, the first column binary;
    ``features`` makes, in each task, the function of a text's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = features()
        for batch in batches:
            texts = batch.column(0)
            sets = pa.array([of((texts[i].as_py() or "").encode("utf-8", "surrogatepass")).tobytes()
                             for i in range(len(texts))], pa.binary())
            yield pa.RecordBatch.from_arrays([sets, *batch.columns[1:]], schema=pa.schema(
                [pa.field("grams", pa.binary()), *list(batch.schema)[1:]]))

    return docs.mapInArrow(run, schema)


def train_svm(rows: Sequence[np.ndarray], labels: np.ndarray, values: np.ndarray | None, size: int,
              cost: float = 1.0, epochs: int = 15, seed: int = 5,
              costs: np.ndarray | None = None) -> np.ndarray:
    """Hinge-loss linear SVM by dual coordinate descent (Hsieh et al., 2008).

    rows: feature numbers of each example; a feature's value is values[f]
    (1 if None), each example scaled to unit length; labels: +1 / -1.
    Returns the weights over ``size`` features and a bias (last place).
    """
    w = np.zeros(size + 1)
    n = len(rows)

    def scaled(r: np.ndarray) -> np.ndarray:
        v = np.ones(len(r)) if values is None else values[r]
        norm = np.sqrt(v @ v)
        return v / norm if norm > 0 else np.zeros(len(r))

    # Made anew at each visit: kept, they take twice the memory of ``rows``.
    square = np.array([v @ v + 1.0 for v in map(scaled, rows)])
    upper = np.full(n, cost) if costs is None else cost * costs
    alpha = np.zeros(n)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        largest = 0.0
        for i in rng.permutation(n):
            y, r, v = labels[i], rows[i], scaled(rows[i])
            gradient = y * (w[r] @ v + w[size]) - 1.0
            old = alpha[i]
            new = min(max(old - gradient / square[i], 0.0), upper[i])
            if new != old:
                step = (new - old) * y
                w[r] += step * v
                w[size] += step
                alpha[i] = new
                largest = max(largest, abs(new - old))
        if largest < 1e-3:
            break
    return w


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))
