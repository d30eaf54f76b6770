"""Exact and near duplicates, line dedup, components."""

import hashlib
import os
import random
import re
import tempfile
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from helpers import PASSAGE, ROWS, awkward, nothing
from hypothesis import given, settings
from hypothesis import strategies as st

from cartwheel.llm.common import connected_components
from cartwheel.llm.exact_dedup import exact_dedup, grace
from cartwheel.llm.line_dedup import line_dedup
from cartwheel.llm.simhash import (
    cells, fingerprint, keep_one_of_each, link_fingerprints, near_duplicates, spanning_links)


def test_exact_dedup_against_brute_force(spark):
    want = defaultdict(list)
    for doc_id, text, *_ in ROWS:
        want[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    for table_bytes in (96 << 20, 2000):  # the second flushes and spills
        got = exact_dedup(awkward(spark), table_bytes=table_bytes, local_bytes=table_bytes).collect()
        assert len(got) == len(ROWS)
        by_digest = defaultdict(list)
        for r in got:
            by_digest[r.text_sha256].append(r)
        for text, ids in want.items():
            rows = by_digest.pop(hashlib.sha256(text.encode()).hexdigest())
            known = [i for i in ids if i is not None]
            assert {r.keep_id for r in rows} == {min(known) if known else None}
            assert {r.group_size for r in rows} == {len(ids)}
            assert sum(r.kept for r in rows) == 1
            assert all(r.doc_id == r.keep_id for r in rows if r.kept)
        assert not by_digest
    assert exact_dedup(nothing(spark)).count() == 0


def test_grace_recursion_bounds_the_table_and_leaves_no_files():
    before = set(os.listdir(tempfile.gettempdir()))
    texts = [f"text {i}".encode() * 20 for i in range(500)]
    records = [(hashlib.sha256(t).hexdigest(), t, i + 500 * k, i + 500 * k, 1, [i + 500 * k])
               for k in range(3) for i, t in enumerate(texts)]
    out = list(grace(records, table_bytes=5000))
    assert len(out) == 500
    assert {e[1]: (e[2], e[4], sorted(e[5])) for e in out} == {
        t: (i, 3, [i, i + 500, i + 1000]) for i, t in enumerate(texts)}
    assert not [x for x in set(os.listdir(tempfile.gettempdir())) - before if x.startswith("grace-")]


def test_equal_digests_of_different_texts_stay_apart():
    out = list(grace([("0" * 64, b"a", 1, 1, 1, [1]), ("0" * 64, b"b", 2, 2, 1, [2])], table_bytes=1))
    assert len(out) == 2


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(prints, max_bits=3):
    """Smallest member of each position's component, by comparing all pairs."""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= max_bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_simhash_against_brute_force(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    texts = [r[1] for r in ROWS]
    for _ in range(30):
        base = [rnd.choice(words) for _ in range(300)]
        texts.append(" ".join(base))
        for _ in range(3):
            other = list(base)
            other[rnd.randrange(300)] = "changed"
            texts.append(" ".join(other))
    rows = [(i + 100, t) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    prints = [slow_fingerprint(t) for _, t in rows]
    low = groups_of(prints)
    assert len(got) == len(rows)
    assert len(set(low)) < len(low) - 30  # there are groups
    for i, (doc_id, _) in enumerate(rows):
        assert got[doc_id].fingerprint % (1 << 64) == prints[i]
        assert got[doc_id].component_id == rows[low[i]][0]


def test_simhash_takes_awkward_and_no_rows(spark):
    got = near_duplicates(awkward(spark)).collect()
    assert len(got) == len(ROWS)
    zero = [r for r in got if r.fingerprint == 0]
    assert len(zero) == 4 and {r.component_id for r in zero} == {3}
    assert near_duplicates(nothing(spark)).count() == 0
    kept = keep_one_of_each(awkward(spark))
    assert kept.columns == awkward(spark).columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x))
    assert ids.count(10) == 1 and ids.count(3) == 1 and 4 not in ids and 2 not in ids
    assert keep_one_of_each(nothing(spark)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**64 - 1), st.sets(st.integers(0, 63), max_size=5), st.sampled_from([1, 2, 4]),
       st.sampled_from([0, 1, 2, 3, 4, 5]))
def test_every_close_pair_meets_in_a_cell(value, flips, segment_bits, max_bits):
    other = value
    for b in flips:
        other ^= 1 << b
    prints = np.array([value, other], np.uint64).view(np.int64)
    grid = defaultdict(set)
    for cell, who, visitor in cells(prints, max_bits, segment_bits):
        for c, w in zip(cell.tolist(), who.tolist()):
            grid[c].add((w, visitor))
    met = any({w for w, _ in members} == set(prints.tolist()) and any(not v for _, v in members)
              for members in grid.values())
    if len(flips) <= max_bits:
        assert met


def test_spanning_links_join_a_large_cell_without_all_pairs():
    prints = np.sort(np.array([1 << i for i in range(60)] + [0], np.int64))
    a, b = spanning_links(np.zeros(61, np.int64), prints, np.zeros(61, np.int8), 3)
    assert len(a) == 60


def test_connected_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, x) for x in range(101, 130)] + [(200, 201), (201, 200)]
    edges += [(rnd.randrange(1000, 1100), rnd.randrange(1000, 1100)) for _ in range(60)]
    got = {r.node: r.component for r in
           connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == {x: c for x, c in label.items() if any(x in e and e[0] != e[1] for e in edges)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_row_of_each_group_stays_whatever_its_ids(spark):
    rnd = random.Random(6)
    one, other, last = (" ".join(f"w{rnd.randrange(10**9)}" for _ in range(400)) for _ in range(3))
    near = last + " tail"
    assert 0 < (fingerprint(last) ^ fingerprint(near)).bit_count() <= 3
    rows = [(1, one), (1, other), (2, one), (2, other), (None, last), (None, near), (None, near)]
    kept = keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(kept) == 3 and sum(r.doc_id is None for r in kept) == 1
    assert {(r.doc_id, r.text) for r in kept} >= {(1, one), (1, other)}


def test_line_dedup_removes_repeated_passages_and_leaves_the_rest(spark):
    rows = awkward(spark)
    out = line_dedup(rows)
    assert out.columns == rows.columns and out.count() == len(ROWS)
    texts = defaultdict(list)
    for r in out.collect():
        texts[r.doc_id].append(r.text)
    assert PASSAGE in texts[8][0] and PASSAGE not in texts[9][0]
    assert texts[9] == ["other line\nfinal line"]
    for doc_id, text, *_ in ROWS:
        if doc_id != 9:
            assert text in texts[doc_id]
    assert line_dedup(nothing(spark)).count() == 0


def test_line_dedup_chunks_resist_shifts(spark):
    rnd = random.Random(2)
    block = [f"line {i} {rnd.random()}" for i in range(60)]
    rows = [(1, "\n".join(block)), (2, "\n".join(["something new", *block])), (3, "\n".join(["quite", "new", "here"]))]
    out = {r.doc_id: r.text for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1] == rows[0][1] and out[3] == rows[2][1]
    assert out[2] == "something new"


@pytest.mark.parametrize("bits", [64, 5])
def test_line_dedup_takes_short_passages_out_of_any_surroundings(spark, bits):
    rnd = random.Random(4)

    def fresh(n):
        return [" ".join(f"w{rnd.randrange(10**9)}" for _ in range(rnd.randint(1, 30))) for _ in range(n)]

    rows, want = [], {}
    for size in (1, 2, 3, 4, 5, 6, 12):
        passage = fresh(size)
        for copy in range(20):
            before, after = fresh(rnd.randint(0, 6)), fresh(rnd.randint(0, 6))
            rows.append((len(rows), "\n".join([*before, *passage, *after])))
            whole = copy == 0 or size == 1  # a short line by itself stays
            want[rows[-1][0]] = "\n".join([*before, *(passage if whole else []), *after])
    odd = ["a b\n\nc d\n", "x\na b\n\nc d\ny", "a b\nc d", "\n\n", "\n\n", "z\n\n\n", "z", "z\n", "r s\nt\nr s\nt"]
    stay = ["a b\n\nc d\n", "x\ny", "a b\nc d", "\n\n", "\n\n", "z\n\n\n", "z", "z\n", "r s\nt"]
    for text, left in zip(odd, stay):
        rows.append((len(rows), text))
        want[rows[-1][0]] = left
    rows += [rows[3], (None, rows[0][1]), (len(rows), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = line_dedup(docs, hash_bits=bits).collect()  # five bits: most hashes stand for several texts
    assert len(got) == len(rows)
    by_id = {r.doc_id: r.text for r in got}
    assert by_id.pop(None) == (rows[0][1] if "\n" not in rows[0][1] else "")
    assert by_id.pop(len(rows) - 1 - 2) is None
    assert by_id == want


def slow_line_dedup(rows):
    """{id: text} of (id, text) rows with distinct ids."""
    seen, out = {}, {}
    for size in (2, 1):
        for doc_id, text in sorted(rows):
            lines = text.split("\n")
            worded = [i for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x)]
            spans = zip(worded, worded[1:]) if size == 2 else (
                (i, i) for i in worded if len(re.findall(r"[^\x20\x09-\x0D]+", lines[i])) >= 50)
            for a, b in spans:
                if seen.setdefault((size, *lines[a:b + 1]), (doc_id, a)) != (doc_id, a):
                    out.setdefault(doc_id, set()).update(range(a, b + 1))
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in out.get(d, ())) for d, t in rows}


@pytest.mark.parametrize("bits", [64, 6])
def test_line_dedup_against_brute_force(spark, bits):
    rnd = random.Random(9)
    wide = [" ".join(f"long{k}{i}" for i in range(50)) for k in range(3)]
    rows = [(i, "\n".join(rnd.choice(["a", "b", "c", "d e", "", " ", "f", wide[i % 3]] + [f"n{rnd.random()}"] * 4)
                          for _ in range(rnd.randint(1, 12)))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.doc_id: r.text for r in line_dedup(docs, hash_bits=bits).collect()} == slow_line_dedup(rows)


@pytest.mark.parametrize("cell_rows", [16384, 300, 20])
def test_crowded_cells_lose_no_link(spark, cell_rows):
    rnd = random.Random(3)
    prints = {rnd.getrandbits(32) << 32 | 0x5A5A0F0F for _ in range(1200)}  # one cell of the lower half
    prints |= {rnd.getrandbits(32) | 0x123456780000 << 16 for _ in range(600)}
    for p in list(prints)[:300]:
        for _ in range(3):
            p ^= 1 << rnd.randrange(64)
            prints.add(p)
    center = rnd.getrandbits(64)
    prints |= {center ^ sum(1 << b for b in rnd.sample(range(12), rnd.randint(0, 6))) for _ in range(500)}
    prints = sorted(prints)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    edges = [(r.a, r.b) for r in link_fingerprints(frame, 3, cell_rows=cell_rows).collect()]
    parent = {p: p for p in signed}

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in edges:
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 3
        parent[root(a)] = root(b)
    bits = np.array(prints, np.uint64)
    for i in range(len(bits)):
        for j in np.flatnonzero(np.bitwise_count(bits ^ bits[i]) <= 3).tolist():
            assert root(signed[i]) == root(signed[j])


def test_a_hundred_thousand_fingerprints_of_one_cell(spark):
    rng = np.random.default_rng(4)
    upper = np.unique(rng.integers(0, 1 << 32, 100_000, dtype=np.uint64))
    prints = (upper << np.uint64(32) | np.uint64(0x5A5A0F0F)).view(np.int64)
    frame = spark.createDataFrame([(p,) for p in prints.tolist()], "fingerprint long")
    got = {frozenset((r.a, r.b)) for r in link_fingerprints(frame, 3).collect()}
    linked = {p for pair in got for p in pair}
    bits = prints.view(np.uint64)
    for i in rng.choice(len(bits), 300, replace=False).tolist():
        near = np.bitwise_count(bits ^ bits[i]) <= 3
        assert (int(prints[i]) in linked) == (near.sum() > 1)
