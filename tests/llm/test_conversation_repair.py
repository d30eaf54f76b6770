"""Conversation repair: cheapest edits against exhaustive search, whole query
against brute force, conversations cut into blocks and over tasks."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartwheel.llm.conversation_repair import (
    ENDS, START, Estimate, cheapest, damage, follow, places, repair, ways)
from cartwheel.llm.queries import op13_repair

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = {"": "su", "s": "u", "u": "a", "a": "u"}  # by the last initial; '' and 'a' may end


def exhaustive(rows):
    """(cost, audit, lines) of (role, text, kind) rows: all edits, cheapest and
    then ASCII-least first."""
    heap, done = [(0, "", 0, "", ())], {}
    while True:
        cost, audit, i, last, lines = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, lines
        if done.setdefault((i, last), (cost, audit)) < (cost, audit):
            continue
        for role in ("user", "assistant"):
            if role[0] in GRAMMAR[last]:
                heapq.heappush(heap, (cost + 3, audit + "I", i, role[0], (*lines, role + ":")))
        if i < len(rows):
            role, text, kind = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, lines))
            if kind in ("fine", "truncated"):
                more = cost + 3 * (kind == "truncated")
                if role[:1] and role[:1] in GRAMMAR[last]:
                    heapq.heappush(heap, (more, audit + "K", i + 1, role[:1], (*lines, f"{role}:{text}")))
                for to in ("user", "assistant"):
                    if to[0] in GRAMMAR[last]:
                        heapq.heappush(heap, (more + 3, audit + "R", i + 1, to[0], (*lines, f"{to}:{text}")))


def brute_force(rows, damaged=True):
    """{conv_id: result} of (conv_id, turn, role, text) rows."""
    convs = {}
    for conv, turn, role, text in rows:
        kept = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        how = zlib.crc32(key.encode()) % 20 if damaged else 9
        if how == 0:
            continue
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        kept += [(turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    out = {}
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        seen, marked = set(), []
        for _, role, text in kept:
            ink = re.sub(r"[\x20\x09-\x0D]", "", text)
            kind = ("blank" if not ink else "duplicate" if (role, text) in seen
                    else "fine" if ink[-1] in ".!?" else "truncated")
            seen.add((role, text))
            marked.append((role, text, kind))
        turns = {t for t, _, _ in kept if t is not None}
        cost, audit, lines = exhaustive(marked)
        kinds = [k for _, _, k in marked]
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:])]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, kinds.count("blank"),
                     kinds.count("duplicate"), kinds.count("truncated"),
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def results(df):
    rows = df.collect()
    out = {r.conv_id: tuple(r[1:]) for r in rows}
    assert len(out) == len(rows)
    return out


ROWS = st.lists(st.tuples(st.sampled_from(["s", "u", "a", "a", "u", "t", ""]), st.sampled_from([0, 0, 0, 1, 2, 3]),
                          st.sampled_from([1, 1, 1, 2, 3])), max_size=7)
NAMES = ("fine", "truncated", "duplicate", "blank")


@settings(deadline=None, max_examples=400)
@given(ROWS, st.integers(1, 4))
def test_search_and_composition_against_all_edits(rows, size):
    spread = [r for initial, kind, copies in rows for r in
              [(initial, "", NAMES[kind])] + [(initial, "", "duplicate")] * (copies - 1)]
    cost, audit, _ = exhaustive(spread)
    got, answer = cheapest(rows, START, ENDS, True)
    it = iter(rows)
    full = "".join("I" if e == "I" else e + "D" * (next(it)[2] - 1) for e in answer)
    assert (got, full) == (cost, audit)
    assert Estimate(rows)(0, START) <= cost
    blocks = [rows[i:i + size] for i in range(0, len(rows), size)]
    found = [ways(b) for b in blocks]
    total, rank, _ = follow(found, START)
    tail = (0, 6, 3, 0)
    best = min((total[x] + tail[x], rank[x], x) for x in range(4))
    pieces = [cheapest(b, a, (to,), False)[1] for b, (a, to) in zip(blocks, places(found, START, best[2]))]
    assert best[0] == cost and "".join(pieces) + "I" * (tail[best[2]] // 3) == answer
    halves = [[follow(part, e)[:2] for e in range(4)] for part in (found[:1], found[1:])]  # composed once more
    again = [([c for c, _ in h], [r for _, r in h]) for h in halves]
    assert follow(again, START)[0] == total


def chat(rnd, conv, turns):
    roles = ["system"] * (rnd.random() < 0.2) + ["user", "assistant"] * turns
    return [(conv, t, role, rnd.choice(["Yes.", "No!", "What?", "cut", " ", "Tell me more.", f"Text {rnd.random()}."]))
            for t, role in enumerate(roles[:turns])]


@pytest.mark.parametrize("options", [{}, {"block_rows": 1}, {"block_rows": 3}, {"block_bytes": 10}])
def test_damaged_conversations_against_brute_force(spark, options):
    rnd = random.Random(8)
    rows = [r for conv in range(60) for r in chat(rnd, conv, rnd.randint(1, 9))] + chat(rnd, 1000, 150)
    rows += [r for r in rows[:10]] + [(None, 1, "user", "a."), (None, None, None, None), (77, None, "user", None),
                                      (77, None, "tool", "x."), (77, -5, "", "z."), (78, 0, "user", ""),
                                      (79, 9_000_000_000_000_000_000, "user", "b."), (79, -9_000_000_000_000_000_000, "u", "c")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute_force(rows)
    want = {k: (min(v[0], 2**63 - 1), *v[1:]) for k, v in want.items()}
    assert results(repair(damage(frame), copies_col="copies", **options)) == want


def test_long_conversation_of_equal_rows_and_extra_columns(spark):
    rows = [(1, t, "user", "same.") for t in range(400)] + [(1, 400 + t, "assistant", f"line {t}.") for t in range(50)]
    rows += [(2, 0, "user", "a.")] * 500 + [(2, 1, "assistant", "b.")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS copies", "'y' AS kind", "'z' AS digest")
    assert results(repair(frame, block_rows=32)) == brute_force(rows, damaged=False)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert results(op13_repair(spark, SF)) == brute_force(rows)


def test_no_rows_and_conversations_that_lose_all(spark):
    assert repair(spark.createDataFrame([], SCHEMA)).count() == 0
    lost = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    got = results(repair(damage(spark.createDataFrame([(5, lost, "user", "a.")], SCHEMA)), copies_col="copies"))
    assert got == {5: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
