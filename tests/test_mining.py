"""Sequences, itemsets, pruned top-N, segments that continue from run to run."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from support import SF_SMALL

from cartwheel.operators import affinity, als, segmentation, sessions


def test_sequences_are_cut_at_the_window_and_null_steps_are_steps(spark):
    rnd = random.Random(3)
    rows = [(f"s{s}", i, rnd.choice(["a", "b", None, "c"])) for s in range(15) for i in range(rnd.randint(1, 9))]
    rows += [("hot", i, "ab"[i % 2]) for i in range(300)] + [(None, 1, "a")]
    df = spark.createDataFrame(rows, "user_session string, event_id long, event_type string").selectExpr(
        "*", "timestamp_seconds(event_id) AS event_time")
    got = {r.path: r["count"] for r in sessions.frequent_sequences(df, min_count=3, max_length=3, window=4).collect()}
    parts = {}
    for s, i, step in rows:
        if s is not None:
            parts.setdefault((s, i // 4), []).append(step or "NULL")
    want = Counter(">".join(p) for part in parts.values()
                   for p in {c for n in (1, 2, 3) for c in itertools.combinations(part, n)})
    assert got == {p: c for p, c in want.items() if c >= 3}
    assert sessions.frequent_sequences(df.limit(0)).count() == 0


def test_two_large_equal_baskets_do_not_explode(spark):
    df = spark.createDataFrame([(b, i) for b in (1, 2) for i in range(40)] + [(3, 0), (3, None), (None, 1)],
                               "b int, i int")
    sets = affinity.frequent_itemsets(df, "b", "i", min_count=2, max_size=2)
    assert sets.filter("size = 2").count() == 40 * 39 // 2 and sets.count() == 40 + 780
    rules = {(tuple(r.antecedent), r.consequent): r for r in
             affinity.association_rules(df, "b", "i", 2, 2, min_confidence=0.9).collect()}
    assert ((0,), 1) not in rules and rules[(1,), 0].confidence == 1.0  # item 0 is in three baskets
    assert rules[(1,), 0].lift == 1.0 and rules[(1,), 2].lift == 1.5


@pytest.mark.parametrize("max_size", [1, 2, 3, 4])
def test_itemsets_are_joins_with_no_pass_per_item(spark, monkeypatch, max_size):
    """a miner that runs every prefix over all baskets takes baskets times items."""
    def per_prefix(*args):
        raise AssertionError("prefixes are projected one by one")

    for module in (affinity, sessions):
        monkeypatch.setattr(module, "frequent_patterns", per_prefix, raising=False)
    monkeypatch.setattr(affinity, "CHUNK", 4, raising=False)  # most baskets meet themselves in parts
    rnd = random.Random(7)
    baskets = {b: rnd.sample(range(25), rnd.randint(1, 9)) for b in range(60)} | {99: list(range(25))}
    df = spark.createDataFrame([(b, i) for b, items in baskets.items() for i in items * 2] + [(7, None), (None, 3)],
                               "b int, i int")
    want = Counter(c for items in baskets.values() for n in range(1, max_size + 1)
                   for c in itertools.combinations(sorted(items), n))
    got = [(tuple(r["items"]), r["count"]) for r in affinity.frequent_itemsets(df, "b", "i", 3, max_size).collect()]
    assert sorted(got) == sorted((s, c) for s, c in want.items() if c >= 3)
    rules = affinity.association_rules(df, "b", "i", 3, max_size).collect()
    assert len(rules) == sum(len(s) for s, c in want.items() if c >= 3 and len(s) > 1)
    assert all(r["count"] == want[tuple(sorted([*r.antecedent, r.consequent]))]
               and r.confidence == pytest.approx(r["count"] / want[tuple(r.antecedent)]) for r in rules)
    assert affinity.frequent_itemsets(df.limit(0), "b", "i", 3, max_size).count() == 0


def test_pairs_are_dealt_by_their_number(spark, monkeypatch):
    """tasks follow the pairs to be made; a large basket is spread over tasks."""
    monkeypatch.setattr(affinity, "PAIRS_PER_TASK", 100, raising=False)
    monkeypatch.setattr(affinity, "CHUNK", 10, raising=False)
    df = spark.createDataFrame([(b, i) for b in range(2) for i in range(100)], "b int, i int")
    rows = affinity._basket_rows(df, "b", "i")
    pairs = affinity._pairs(rows, affinity._item_counts(rows, 2))
    held = pairs.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in held) == 2 * 100 * 99 // 2
    assert pairs.rdd.getNumPartitions() == 99 and len(held) > 10
    got = affinity.affinity_pairs(df, "b", "i", min_count=2)
    assert got.count() == 100 * 99 and {r.pair_count for r in got.select("pair_count").distinct().collect()} == {2}


@pytest.mark.parametrize("k", [1, 2, 3, 5, 6])
def test_centers_are_matched_at_the_least_cost(k):
    rng = np.random.default_rng(k)
    for _ in range(25):
        a, b = rng.normal(size=(k, 3)), rng.normal(size=(k, 3))
        of = segmentation.match_centers(a, b)
        assert sorted(of) == list(range(k))
        cost = sum(((b[i] - a[of[i]]) ** 2).sum() for i in range(k))
        best = min(sum(((b[i] - a[p[i]]) ** 2).sum() for i in range(k)) for p in itertools.permutations(range(k)))
        assert cost == pytest.approx(best)


def test_a_refit_on_the_same_users_changes_no_segment(spark):
    from cartwheel.plans.queries_model import _user_features

    users = _user_features(spark, SF_SMALL)
    model, seg = segmentation.fit_segments(users, max_iter=100)
    centers, again = segmentation.refit_segments(model, users)
    assert segmentation.match_centers(segmentation.centers_of(model), centers) == list(range(len(centers)))
    stable = segmentation.segment_stability(seg, again).first()
    assert stable.users > 0 and stable.changed_pct < 15
    # an unmatched numbering would have moved nearly everybody
    turned = seg.withColumn("segment_id", (seg["segment_id"] + 1) % len(centers))
    assert segmentation.segment_stability(seg, turned).first().changed_pct == 100


@pytest.mark.parametrize("options", [{}, {"chunk_items": 7, "block_items": 2}])
def test_pruned_top_n_is_the_cross_product_and_prunes(spark, options):
    rnd = random.Random(1)
    rows = [(u, p, float(rnd.randint(1, 9))) for u in range(40) for p in range(60) if rnd.random() < 3 / (p + 4)]
    m = spark.createDataFrame(rows, "user_idx int, product_idx int, rating double")
    model = als.fit_als(m, rank=4, max_iter=3)
    met = spark.sparkContext.accumulator(0)
    got = {}
    for r in als.top_n_pruned(model, m, n=5, met=met, **options).orderBy("user_idx", "rank").collect():
        got.setdefault(r.user_idx, []).append((r.product_idx, r.score))
    u = {r.id: np.array(r.features, float) for r in model.userFactors.collect()}
    v = {r.id: np.array(r.features, float) for r in model.itemFactors.collect()}
    assert set(got) == set(u)
    for i, x in u.items():
        want = sorted((-(x @ y), p) for p, y in v.items())[:5]
        assert [s for _, s in got[i]] == pytest.approx([-s for s, _ in want])
    if options:
        assert met.value < 0.8 * len(u) * len(v)
