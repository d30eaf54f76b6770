"""Ranked lexical search: brute force, DuckDB, awkward rows."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
from helpers import awkward, nothing

from cartwheel.llm.ball_tree import RANKED_SEARCH_SQL, BallTree, Best, SparseRows, ranked_search, terms
from cartwheel.llm.queries import op12_ball_tree

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CAPITALS = {i: chr(i + 32) for i in range(65, 91)}


def brute_force(docs, items, k):
    """{item_id: [(doc_id, score)]} of (id, text) rows."""
    cut = [(i, TERM.findall((t or "").translate(CAPITALS))) for i, t in docs]
    cut = [(i, t) for i, t in cut if t]
    n, total = len(cut), sum(len(t) for _, t in cut)
    df = Counter(x for _, t in cut for x in set(t))
    asked = {}
    for i, t in items:
        asked.setdefault(i, []).extend(TERM.findall((t or "").translate(CAPITALS)))
    out = {}
    for item, words in asked.items():
        found = []
        for i, t in cut:
            m, tf = 75 + (25 * len(t) * n) // total, Counter(t)
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
                        * ((1_000_000_000 * tf[w]) // (1000 * tf[w] + 12 * m)) for w in words if tf[w])
            if score:
                found.append((-score, i is None, i or 0))
        if found:
            out[item] = [(None if null else i, -s) for s, null, i in sorted(found)[:k]]
    return out


def ranked(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r["rank"] == len(out[r.item_id])
    return out


def test_terms():
    text = "It's 3,4 A_b Äß\x00Öx É中文😀-tail y\x7fz"
    assert [t.decode() for t in terms(text.encode())] == TERM.findall(text.translate(CAPITALS))
    assert terms(None) == terms(b"") == terms(b" .,") == []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(5)
    rows, width = 600, 80
    sets = [np.sort(rng.choice(width // 4, 6, replace=False)) + width // 4 * rng.integers(4) for _ in range(rows)]
    impacts = SparseRows(np.concatenate(sets), rng.integers(1, 10**6, 6 * rows), np.arange(0, 6 * rows + 1, 6))
    full = np.zeros((rows, width), np.int64)
    for i, cols in enumerate(sets):
        full[i, cols] = impacts.values[6 * i:6 * i + 6]
    weights = rng.integers(1, 9000, width)
    for scale in (np.ones(width), weights ** 0.5, weights * 1.0):
        tree = BallTree(impacts, scale, 4)
        met = 0
        for _ in range(30):
            cols = np.sort(rng.choice(width, 5, replace=False))
            dense = np.zeros(width, np.int64)
            dense[cols] = weights[cols]
            best = Best(7)
            best.shard(np.arange(rows), np.zeros(rows, bool))
            met += tree.search(cols, weights[cols] / scale[cols], dense, best)
            scores = full @ dense
            want = sorted((-s, i) for i, s in enumerate(scores) if s > 0)[:7]
            assert [(-s, i) for s, i in zip(best.scores.tolist(), best.ids.tolist())] == want
        assert met < 0.7 * 30 * rows


def test_query_against_brute_force_and_duckdb(spark):
    rows = {t: [(r[0], r.text) for r in spark.read.parquet(f"{SF}/{t}.parquet").collect()]
            for t in ("documents", "benchmark")}
    got = ranked(op12_ball_tree(spark, SF))
    assert got == brute_force(rows["documents"], rows["benchmark"], 20)
    con = duckdb.connect()
    for t in rows:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = {}
    for item, _, doc_id, score in sorted(con.execute(RANKED_SEARCH_SQL).fetchall()):
        want.setdefault(item, []).append((doc_id, score))
    assert got == want


def test_blocks_shards_ties_and_repeated_rows(spark):
    rnd = random.Random(2)

    def text(n):
        return " ".join(f"w{min(rnd.randrange(60), rnd.randrange(60))}" for _ in range(n))

    docs = [(i, text(rnd.randint(1, 40))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(100)] + [docs[3]] * 3 + [(None, docs[7][1]), (5, None), (6, "")]
    items = [(i, text(rnd.randint(1, 12))) for i in range(12)] + [(3, "w1 w2"), (None, "w5 W5"), (50, None),
                                                               (51, "nowhere"), (52, docs[7][1])]
    want = brute_force(docs, items, 9)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    for options in ({}, {"block_terms": 20}, {"shard_rows": 16, "leaf_rows": 2}, {"shard_cells": 1}, {"power": 0.0}):
        assert ranked(ranked_search(frame, asked, k=9, **options)) == want


def test_awkward_and_no_rows(spark):
    asked = spark.createDataFrame([(1, "quick fox"), (2, "repeat"), (3, "naïve 中文"), (4, "passage1 word5")],
                                  "item_id long, text string")
    docs = [(r.doc_id, r.text) for r in awkward(spark).collect()]
    got = ranked(ranked_search(awkward(spark), asked, k=5))
    assert got == brute_force(docs, [(r.item_id, r.text) for r in asked.collect()], 5)
    assert ranked_search(nothing(spark), asked).count() == 0
    empty = ranked_search(awkward(spark), asked.limit(0))
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]
