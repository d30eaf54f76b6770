"""Ranked lexical search by sparse ball trees.

The score of a document for an item is an inner product: item weights (how
often a term stands in the item, times the term's weight) with document
impacts ``(1000000000 * tf) div (1000 * tf + 12 * m)``. Documents are vectors over
the items' terms; a shard of them becomes a ball tree, whose nodes hold a
centroid, a radius and, term by term, the radius along that axis. No document
below a node scores more than ``q . centroid + |q| * radius``, nor more than
``q . (centroid + radii)``; computed in doubles and rounded up, the smaller bound
prunes subtrees, best first, that lie below the item's k-th best score so far.
Leaves are scored exactly in 64-bit integers, so results are exact. For tight
bounds both sides are scaled, term by term, by powers of the term's weight
whose product is the weight.

Plan:

1. Items are cut into blocks of ``block_terms`` (item, term) pairs (one item, if
   it has more); a block and its vocabulary are all that is sent to tasks.
2. One scan turns documents into narrow vectors (n, term numbers, counts) and
   writes them; N, L and document frequencies are aggregations of these.
3. Each task takes shards of ``shard_rows`` vectors from its rows, builds the
   tree, and searches it for all items, whose best scores of the task's earlier
   shards already prune. A task returns k rows an item; a ranked merge follows.
   Nothing but these rows is shuffled.

Terms are maximal runs of ASCII letters, digits and characters beyond ASCII;
A-Z count as a-z. Rows: documents without a term (null or empty text) don't
count and are never found; documents that share an id are found one by one;
null ids come last among equal scores, equal scores of equal ids in any
order. Items that share an id are one item with all their terms; an item
without terms or without a match has no row. No documents or no items: no rows.
Extra columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.ranking import group_running_sum
from cartwheel.llm.common import stage

# Bytes of terms: other bytes become blanks, capitals small letters.
_TERM_BYTES = bytes(b if chr(b).isalnum() or b >= 0x80 else 0x20 for b in range(256)).lower()
IMPACT, SLOPE = 1_000_000_000, 12  # fixed values of the score
RESULT = "item_id long, doc_id long, score long"


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, repeats included."""
    return text.translate(_TERM_BYTES).split() if text else []


class SparseRows:
    """Sparse vectors, one after another: numbers of terms, values, starts."""

    def __init__(self, cols: np.ndarray, values: np.ndarray, starts: np.ndarray) -> None:
        self.cols, self.values, self.starts = cols, values, starts  # starts has one more entry than rows

    def __len__(self) -> int:
        return len(self.starts) - 1

    def take(self, rows: np.ndarray) -> SparseRows:
        sizes = (self.starts[1:] - self.starts[:-1])[rows]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(starts[-1]) + np.repeat(self.starts[rows] - starts[:-1], sizes)
        return SparseRows(self.cols[at], self.values[at], starts)

    def dot(self, dense: np.ndarray) -> np.ndarray:
        """Inner products with a dense vector; no row may be empty."""
        return np.add.reduceat(dense[self.cols] * self.values, self.starts[:-1])


class BallTree:
    """Ball tree over document vectors (impacts, integers).

    ``scale`` multiplies the impacts in the metric, term by term. Bounds hold
    for any item vector that is divided by ``scale`` in turn.
    """

    def __init__(self, impacts: SparseRows, scale: np.ndarray, leaf_rows: int = 8) -> None:
        self.impacts, self.leaf_rows = impacts, leaf_rows
        self.dense = np.zeros(len(scale))  # scratch
        # (centroid terms and values, radii along the axes, radius, children or leaf)
        self.nodes: list[tuple] = []
        scaled = SparseRows(impacts.cols, impacts.values * scale[impacts.cols], impacts.starts)
        self._add(np.arange(len(impacts)), scaled)

    def _add(self, rows: np.ndarray, vectors: SparseRows) -> int:
        """Add the node of these documents; returns its number."""
        cols, at = np.unique(vectors.cols, return_inverse=True)
        centre = np.bincount(at, vectors.values) / len(rows)
        norms = np.add.reduceat(vectors.values ** 2, vectors.starts[:-1])
        gaps = self._gaps(vectors, norms, cols, centre)
        highest = np.zeros(len(cols))
        np.maximum.at(highest, at, vectors.values)
        number = len(self.nodes)
        self.nodes.append(())
        if len(rows) <= self.leaf_rows:
            below = (rows, self.impacts.take(rows))
        else:
            a = int(gaps.argmax())
            from_a = self._gaps(vectors, norms, *self._row(vectors, a))
            from_b = self._gaps(vectors, norms, *self._row(vectors, int(from_a.argmax())))
            order = np.argsort(from_a - from_b, kind="stable")  # halves, also of equal vectors
            halves = np.sort(order[:len(rows) // 2]), np.sort(order[len(rows) // 2:])
            below = tuple(self._add(rows[h], vectors.take(h)) for h in halves)
        self.nodes[number] = (cols, centre, highest - centre, math.sqrt(gaps.max()), below)
        return number

    @staticmethod
    def _row(vectors: SparseRows, i: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(vectors.starts[i], vectors.starts[i + 1])
        return vectors.cols[part], vectors.values[part]

    def _gaps(self, vectors: SparseRows, norms: np.ndarray, cols: np.ndarray, point: np.ndarray) -> np.ndarray:
        """Squared distances of the rows to a sparse point, rounded up."""
        self.dense[cols] = point
        products = vectors.dot(self.dense)
        self.dense[cols] = 0
        total = norms + (point ** 2).sum()
        return np.maximum(total - 2 * products, 0) + 1e-9 * total

    def search(self, cols: np.ndarray, scaled: np.ndarray, dense: np.ndarray, best: Best) -> int:
        """Meet all documents that may belong to the ``best`` of an item, whose
        terms ``cols`` (ascending) have the weights ``scaled`` in the metric and
        ``dense[cols]`` (integers). Returns the number of documents scored."""
        length = math.sqrt((scaled ** 2).sum())

        def bound(number: int) -> float:
            support, centre, radii, radius, _ = self.nodes[number]
            at = np.minimum(support.searchsorted(cols), len(support) - 1)
            shared = support[at] == cols
            at, q = at[shared], scaled[shared]
            # Sums of positive doubles err by far less than these margins.
            return (float(q @ centre[at]) + min(length * radius, float(q @ radii[at]))) * (1 + 1e-9) + 1

        met, todo = 0, [(-bound(0), 0)]
        while todo:
            high, number = heapq.heappop(todo)
            if -high < best.lowest:
                break
            below = self.nodes[number][4]
            if isinstance(below[0], np.ndarray):
                rows, impacts = below
                met += len(rows)
                best.add(rows, impacts.dot(dense))
            else:
                for child in below:
                    if (high := bound(child)) >= best.lowest:
                        heapq.heappush(todo, (-high, child))
        return met


class Best:
    """The k best (score, document) of one item; ties to the smaller id,
    null ids last."""

    def __init__(self, k: int) -> None:
        self.k, self.lowest = k, 1  # documents must score above 0
        self.scores = np.empty(0, np.int64)
        self.ids = np.empty(0, np.int64)
        self.null = np.empty(0, bool)

    def shard(self, ids: np.ndarray, null: np.ndarray) -> None:
        """Documents are rows of these from now on."""
        self.all_ids, self.all_null = ids, null

    def add(self, rows: np.ndarray, scores: np.ndarray) -> None:
        good = scores >= self.lowest
        if not good.any():
            return
        rows = rows[good]
        scores = np.concatenate([self.scores, scores[good]])
        ids = np.concatenate([self.ids, self.all_ids[rows]])
        null = np.concatenate([self.null, self.all_null[rows]])
        keep = np.lexsort((ids, null, -scores))[:self.k]
        self.scores, self.ids, self.null = scores[keep], ids[keep], null[keep]
        if len(keep) == self.k:
            self.lowest = max(int(self.scores[-1]), 1)


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _blocks(items: DataFrame, item_col: str, text_col: str, block_terms: int) -> tuple[DataFrame, int]:
    """(block, item_id, term binary, times) and the number of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = terms(text.as_py())
                for at in range(0, len(found), 50_000):
                    part = found[at:at + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item] * len(part), pa.int64()), pa.array(part, pa.binary())], ["item_id", "term"])

    rows = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("binary").alias("t"))
    counted, _ = stage(rows.mapInArrow(run, "item_id long, term binary")
                       .groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times")))
    sizes = counted.groupBy("item_id").agg(F.count(F.lit(1)).alias("size"))
    n = counted.count()
    if n <= block_terms:
        return counted.withColumn("block", F.lit(0)), min(n, 1)
    ends = group_running_sum(sizes, [], [F.col("item_id")], F.col("size"), "end")
    dealt, _ = stage(counted.join(ends.select(F.col("item_id").alias("_id"), "end", "size"),
                                  F.col("item_id").eqNullSafe(F.col("_id")))
                     .select("item_id", "term", "times",
                             F.floor((F.col("end") - F.col("size")) / block_terms).cast("int").alias("block")))
    return dealt, -(-n // block_terms)


def _vectors(docs: DataFrame, id_col: str, text_col: str, vocabulary) -> DataFrame:
    """(doc_id, n, terms, counts) of the documents with a term, over the
    vocabulary (a broadcast dictionary of one block's terms)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for batch in batches:
            ids, sizes, cols, counts = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = terms(text.as_py())
                if not found:
                    continue
                known = np.fromiter((t for t in map(number, found) if t is not None), np.int32)
                unique, times = np.unique(known, return_counts=True)
                ids.append(doc_id)
                sizes.append(len(found))
                cols.append(unique)
                counts.append(times)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(cols, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("binary")).mapInArrow(
        run, "doc_id long, n long, terms array<int>, counts array<long>")


def _shards(batches: Iterator[pa.RecordBatch], rows: int, cells: int) -> Iterator[pa.Table]:
    """Tables of at most ``rows`` documents and about ``cells`` terms."""
    held, n, size = [], 0, 0
    step = max(1, min(512, rows))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            held.append(part)
            n += part.num_rows
            size += len(part.column(2).flatten())
            if n >= rows or size >= cells:
                yield pa.Table.from_batches(held)
                held, n, size = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  block_terms: int = 200_000, shard_rows: int = 8192, shard_cells: int = 2_000_000,
                  leaf_rows: int = 8, power: float = 0.5, met=None) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` documents of each item
    that score highest. ``met``, an accumulator, gets the documents scored."""
    spark = docs.sparkSession
    blocks, n_blocks = _blocks(items, item_col, item_text_col, block_terms)
    found = None
    for block in range(n_blocks):
        # One block, bounded by its terms, is all that reaches the driver.
        rows = blocks.filter(F.col("block") == block).select("item_id", "term", "times").toArrow()
        names = sorted(set(rows.column("term").to_pylist()))
        vocabulary = spark.sparkContext.broadcast({t: i for i, t in enumerate(names)})
        vectors, _ = stage(_vectors(docs, id_col, text_col, vocabulary))
        n, total = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.zeros(len(names), np.int64)
        for term, df in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            weights[term] = term_weight(n, df)
        queries = _queries(rows, vocabulary.value, weights)
        part = _search(vectors, spark.sparkContext.broadcast((queries, weights)), n, total, k, shard_rows,
                       shard_cells, leaf_rows, power, met)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def _queries(rows: pa.Table, number: dict, weights: np.ndarray) -> list[tuple]:
    """(item id, its term numbers ascending, integer weights above 0)."""
    items: dict = {}
    for item, term, times in zip(*(rows.column(c).to_pylist() for c in ("item_id", "term", "times")), strict=True):
        if weights[number[term]]:
            items.setdefault(item, []).append((number[term], times * int(weights[number[term]])))
    return [(item, *np.array(sorted(pairs), np.int64).T) for item, pairs in items.items()]


def _search(vectors: DataFrame, shared, n: int, total: int, k: int, shard_rows: int, shard_cells: int,
            leaf_rows: int, power: float, met) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shared.value
        scale = np.maximum(weights, 1) ** float(power)
        best = [Best(k) for _ in queries]
        dense = np.zeros(len(weights), np.int64)
        for table in _shards(batches, shard_rows, shard_cells):
            table = table.combine_chunks()
            ids, size = table.column(0), np.asarray(table.column(1))
            lists = table.column(2).chunk(0)
            lengths = np.asarray(lists.value_lengths())
            starts = np.concatenate([[0], np.cumsum(lengths)])
            cols, tf = np.asarray(lists.flatten()), np.asarray(table.column(3).chunk(0).flatten())
            m = 100 - 25 + (25 * size * n) // total
            impact = (IMPACT * tf) // (1000 * tf + SLOPE * np.repeat(m, lengths))
            matched = np.flatnonzero(lengths)  # the others score 0
            if not len(matched):
                continue
            tree = BallTree(SparseRows(cols, impact, starts).take(matched), scale, leaf_rows)
            null = np.asarray(ids.is_null())[matched]
            known = np.asarray(ids.fill_null(0))[matched]
            for (_, terms_, w), top in zip(queries, best, strict=True):
                top.shard(known, null)
                dense[terms_] = w
                scored = tree.search(terms_, w / scale[terms_], dense, top)
                dense[terms_] = 0
                if met is not None:
                    met.add(scored)
        for (item, _, _), top in zip(queries, best, strict=True):
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * len(top.ids), pa.int64()), pa.array(top.ids, pa.int64(), mask=top.null),
                 pa.array(top.scores, pa.int64())], ["item_id", "doc_id", "score"])

    return vectors.mapInArrow(run, RESULT)


RANKED_SEARCH_SQL = r"""
WITH doc_terms AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
sized AS (SELECT r, doc_id, t, len(t)::BIGINT AS n FROM doc_terms WHERE len(t) > 0),
totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS l FROM sized),
tf AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, n, unnest(t) AS term FROM sized) AS x GROUP BY ALL),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
item_terms AS (
  SELECT item_id, term, count(*)::BIGINT AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) AS x
  GROUP BY ALL),
scored AS (
  SELECT item_id, r, doc_id,
         sum(times * floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT
             * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // l))))::BIGINT AS score
  FROM item_terms JOIN tf USING (term) JOIN df USING (term), totals
  GROUP BY item_id, r, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0) AS x
WHERE rank <= 20
"""
