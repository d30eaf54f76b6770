"""Nearest neighbours by inner product: vantage-point trees per shard.

A vector x becomes (x, sqrt(M^2 - |x|^2)), M the largest norm of the table,
and a query (q, 0): Euclidean distance then falls as the inner product
rises, so trees on a metric serve the inner product. A shard holds about
``shard_rows`` vectors. A node keeps a vantage point and, of each half of its
vectors, the range of distances to it; the triangle inequality bounds the
distance from a query to either half from below. A half is skipped if the
bound exceeds ``factor`` times the distance of the query's k-th best so far:
factor one is exact, smaller factors skip more.

Smaller factors hold what they promise only where the extra coordinate is
small: it is the same way off for all vectors, so it lifts every bound. The
vectors of a shard are therefore put into bands whose norms differ by less
than ``BAND``, each with a tree and an M of its own, and a query, whose length
does not change the order, is scaled to that M. Bands are met from the
longest vectors down and share the k best; a band whose M times the query's
length is below the k-th best holds nothing better.

Plan: trees are built one shard a task and written; queries are packed into
blocks; every block visits every shard (a stated query set against all rows,
in blocks), grouped by shard and dealt over ``splits`` tasks a shard, each
streaming its blocks past one tree; the shards' best are merged by a ranked
window. A task holds one tree and one block.

Rows: vectors that are null, zero, or hold null or non-finite components take
no part, and neither do vectors of another length than the most frequent one
(the smallest of those that tie); of rows with the same id the smallest
vector counts; equal scores rank by id; a query without candidates, and an
empty table, give no row.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import stage

LEAF = 128  # vectors
BAND = 1.05  # largest norm of a band by its smallest


class VantageTree:
    """Tree over the vectors of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float, seed: int = 3) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], np.ascontiguousarray(vectors[order])
        self.square = largest * largest
        rest = np.sqrt(np.maximum(0.0, self.square - (self.vectors ** 2).sum(axis=1)))
        lifted = np.hstack([self.vectors, rest[:, None]])
        # node: (vantage row, ((child, low, high), (child, low, high))) or leaf rows
        self.nodes: list = []
        rng = np.random.default_rng(seed)
        self.nodes.append(None)
        todo = [(0, np.arange(len(ids)))]
        while todo:
            at, rows = todo.pop()
            if len(rows) <= LEAF:
                self.nodes[at] = rows
                continue
            vantage = int(rows[rng.integers(len(rows))])
            distance = np.sqrt(((lifted[rows] - lifted[vantage]) ** 2).sum(axis=1))
            by = np.argsort(distance, kind="stable")
            half = len(rows) // 2  # also halves vectors that are all equal
            children = []
            for part in (by[:half], by[half:]):
                self.nodes.append(None)
                todo.append((len(self.nodes) - 1, rows[part]))
                children.append((len(self.nodes) - 1, distance[part].min(), distance[part].max()))
            self.nodes[at] = (lifted[vantage], tuple(children))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float = 1.0, so_far=None):
        """(scores, ids) of the k best of each query, best first; -inf where
        there are fewer. A query's own id is no candidate. ``so_far`` is what
        other trees gave, and takes part.

        Every query first descends to the leaf that seems nearest, which
        gives a first k-th best; then the tree is walked once with all
        queries, each leaving where its bound says so.
        """
        n = len(queries)
        best, found = so_far or (np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max))
        largest = math.sqrt(self.square)
        lengths = np.sqrt((queries ** 2).sum(axis=1))
        scale = np.where(lengths > 0, largest / np.where(lengths > 0, lengths, 1.0), 1.0)
        scaled = queries * scale[:, None]
        norms = (scaled ** 2).sum(axis=1)
        slack = 1e-7 * (1.0 + largest + np.sqrt(norms))
        self.visited = 0
        # No product is larger than that of the lengths.
        able = np.flatnonzero(best[:, -1] <= lengths * largest * (1 + 1e-9))

        def reach(rows: np.ndarray) -> np.ndarray:
            """Distance of the k-th best so far."""
            kth = best[rows, -1]
            out = np.sqrt(np.maximum(0.0, norms[rows] + self.square - 2 * scale[rows] * np.where(np.isinf(kth), 0, kth)))
            return np.where(np.isinf(kth), np.inf, out)

        def bounds(node, rows: np.ndarray) -> list[np.ndarray]:
            """Lower bounds of the distance to anything in each child."""
            vantage, children = node
            # One matrix product; the slack covers its rounding.
            square = norms[rows] + vantage @ vantage - 2 * (scaled[rows] @ vantage[:-1])
            distance = np.sqrt(np.maximum(0.0, square))
            return [np.maximum(0.0, np.maximum(low - distance, distance - high)) for _, low, high in children]

        def scan(leaf: np.ndarray, rows: np.ndarray) -> None:
            """Meet the vectors of a leaf. A matrix product finds the pairs
            that count; their products are summed in one fixed order, so
            equal vectors get equal scores wherever they stand."""
            self.visited += len(rows) * len(leaf)
            own, ids = self.vectors[leaf], self.ids[leaf]
            rough = queries[rows] @ own.T
            margin = 1e-12 * (1.0 + np.abs(rough).max(initial=0.0)) * queries.shape[1]
            i, j = np.nonzero(rough >= best[rows, -1][:, None] - margin)
            other = ids[j] != query_ids[rows[i]]
            i, j = i[other], j[other]
            if not len(i):
                return
            score = (own[j] * queries[rows[i]]).sum(axis=1)
            touched, at = np.unique(i, return_inverse=True)
            who = rows[touched]
            owner = np.concatenate([np.repeat(np.arange(len(who)), k), at])
            scores = np.concatenate([best[who].ravel(), score])
            names = np.concatenate([found[who].ravel(), ids[j]])
            order = np.lexsort((names, -scores, owner))
            starts = np.searchsorted(owner[order], np.arange(len(who)))
            take = order[(starts[:, None] + np.arange(k)).ravel()]
            best[who] = scores[take].reshape(-1, k)
            found[who] = names[take].reshape(-1, k)

        home = np.zeros(n, np.int64)  # leaf that a query has met already
        todo = [(0, able)] if len(able) else []
        while todo:
            at, rows = todo.pop()
            node = self.nodes[at]
            if isinstance(node, np.ndarray):
                home[rows] = at
                scan(node, rows)
                continue
            first, second = bounds(node, rows)
            nearer = first <= second
            todo += [(child, part) for (child, _, _), part in zip(node[1], (rows[nearer], rows[~nearer]))
                     if len(part)]
        todo = [(0, able, np.zeros(len(able)))]
        while todo:
            at, rows, bound = todo.pop()
            rows = rows[bound <= factor * reach(rows) + slack[rows]]
            if not len(rows):
                continue
            node = self.nodes[at]
            if isinstance(node, np.ndarray):
                scan(node, rows[home[rows] != at])
            else:
                todo += [(child, rows, b) for (child, _, _), b in zip(node[1], bounds(node, rows))]
        return best, found


class NormBands:
    """Trees over the vectors of one shard, one a band of norms."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, seed: int = 3) -> None:
        norms = np.maximum(np.sqrt((vectors ** 2).sum(axis=1)), np.finfo(float).tiny)
        band = np.floor(np.log(norms.max() / norms) / math.log(BAND)).astype(np.int64)
        order = np.argsort(band, kind="stable")  # the longest vectors first
        cuts = np.flatnonzero(np.diff(band[order])) + 1
        self.trees = [VantageTree(ids[rows], vectors[rows], norms[rows].max() * (1 + 1e-12), seed)
                      for rows in np.split(order, cuts)]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float = 1.0):
        """As of one tree."""
        met, self.visited = None, 0
        for tree in self.trees:
            met = tree.search(query_ids, queries, k, factor, met)
            self.visited += tree.visited
        return met


def clean_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v array<double>) of the vectors that take part."""
    v = F.col("v")
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"),
                           F.col(vector_col).cast("array<double>").alias("v"))
            .filter(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
                    & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
                    & F.exists(v, lambda x: x != 0)))
    rows, _ = stage(rows.groupBy("id").agg(F.min("v").alias("v")))
    size = (rows.groupBy(F.size("v").alias("_size")).count()
            .orderBy(F.desc("count"), "_size").limit(1).select("_size"))
    return rows.join(F.broadcast(size), F.size("v") == F.col("_size")).drop("_size")


def nearest_neighbours(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                       every: int = 20, k: int = 20, factor: float = 1.0, shard_rows: int = 16384,
                       block: int = 512, splits: int = 4) -> DataFrame:
    """Of each row whose id is divisible by ``every``, the k rows with the
    largest inner product: query_id, rank (from 1), vec_id, score."""
    spark = vectors.sparkSession
    rows, _ = stage(clean_vectors(vectors, id_col, vector_col))
    is_query = F.col("id") % every == 0
    n, queries = rows.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    if not n or not queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shards = -(-n // shard_rows)
    blocks = -(-queries // block)

    def build(key, pdf: pd.DataFrame) -> pd.DataFrame:
        tree = NormBands(pdf["id"].to_numpy(np.int64), np.stack(pdf["v"].to_numpy()))
        return pd.DataFrame({"shard": [key[0]], "tree": [pickle.dumps(tree, protocol=5)]})

    def pack(key, pdf: pd.DataFrame) -> pd.DataFrame:
        data = (pdf["id"].to_numpy(np.int64), np.stack(pdf["v"].to_numpy()))
        return pd.DataFrame({"block": [key[0]], "queries": [pickle.dumps(data, protocol=5)]})

    trees, _ = stage(rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
                     .groupBy("shard").applyInPandas(build, "shard int, tree binary"))
    packed, _ = stage(rows.filter(is_query)
                      .withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int"))
                      .groupBy("block").applyInPandas(pack, "block int, queries binary"))
    parts = min(splits, blocks)
    left = trees.select("shard", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("split"),
                        F.lit(0).alias("kind"), F.col("tree").alias("data"))
    right = packed.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
                          F.pmod(F.col("block"), F.lit(parts)).alias("split"),
                          F.lit(1).alias("kind"), F.col("queries").alias("data"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = None
        for batch in batches:
            for i in range(batch.num_rows):
                data = pickle.loads(batch.column(3)[i].as_py())
                if batch.column(2)[i].as_py() == 0:
                    tree = data  # its blocks follow
                    continue
                ids, queries = data
                best, found = tree.search(ids, queries, k, factor)
                real = np.isfinite(best)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, real.sum(axis=1))), pa.array(found[real]), pa.array(best[real])],
                    ["query_id", "vec_id", "score"])

    met = (left.unionByName(right).repartition(shards * parts, "shard", "split")
           .sortWithinPartitions("shard", "split", "kind")
           .mapInArrow(run, "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
