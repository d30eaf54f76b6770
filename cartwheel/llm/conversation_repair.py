"""Repair of conversation structure by iterative-deepening A*.

The rows of a conversation, by turn, are edited at the least cost so that the
initials of their roles read ``(s?(ua)+)?``: Keep costs 0, Rerole (to user or
assistant) 3, Delete 4, Insert (an empty user or assistant row) 3. Blank rows and
duplicates must be deleted; a truncated row that is not deleted adds 3. Of the
cheapest edits the ASCII-least sequence of initials (D, I, K, R) is the answer.

Search: depth first, edits in ASCII order, under a cost bound that grows to the
least estimate beyond it, so the first accepting path is the answer. A failed
state (row, place in the grammar) is kept with the largest budget that failed
and is not entered again with that budget or less. The estimate of the remaining cost
adds the unavoidable cost of each row and, for pairs of neighbouring rows that
cannot both stay as they are (no row in two pairs), the least that mends one.

Plan, for conversations of any length:

1. Equal rows of a turn are counted (partly before the shuffle); duplicates of
   earlier turns are found by digest of the text (SHA-256).
2. Rows are range-partitioned and sorted by (conversation, turn), so a long
   conversation is spread over tasks. Tasks read rows as a stream and search each
   conversation that ends inside them at once. Of one that is longer than
   ``block_rows``, or that touches an end of the task's range, every block of rows
   is searched for each pair of grammar places at its ends: least cost, and the
   order of the answers.
3. These small matrices are composed, blocks to the segment of a task and
   segments (one a task at most) to the conversation, which fixes the places at
   every block's ends.
4. Blocks are searched once more between their places, and the edits and texts
   are put together as a sorted stream: only the answer itself, one string a
   conversation, is held.

Rows: null roles and texts count as one blank; null turns come first; rows of one
turn go by role and digest of the text; rows without a conversation id are one
conversation. A role's initial is its first character, if any. Extra columns are
not read. No rows: no result.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import stage

START, SYSTEM, USER, ASSISTANT = range(4)  # what has been read of the grammar
FOLLOWING = (USER, USER, ASSISTANT, USER)  # by a user or assistant row
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
ENDS = (START, ASSISTANT)
FINE, TRUNCATED, DUPLICATE, BLANK = range(4)
KEEP, REROLE, DELETE, INSERT, TRUNCATION = 0, 3, 4, 3, 3  # costs
FAR = 1 << 62
TAIL = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}  # inserts that end the grammar


def kept_place(place: int, initial: str) -> int | None:
    """The place after a kept row, None if it cannot be kept."""
    if initial == "s":
        return SYSTEM if place == START else None
    if initial == "u":
        return USER if place != USER else None
    return ASSISTANT if initial == "a" and place == USER else None


class Estimate:
    """Lower bounds of the cost from row i and a place of the grammar to one of
    ``exits`` on."""

    def __init__(self, rows: list[tuple], exits: tuple[int, ...] = ENDS) -> None:
        n = len(rows)
        self.rows, self.base, self.pairs = rows, [0] * (n + 1), [0] * (n + 1)
        self.exits, self.all = exits, [0] * (n + 1)  # cost of deleting all rows from i on
        self.live = [n] * (n + 1)  # the first row from i on that may stay
        after = [n] * (n + 1)  # and the one after it
        for i in range(n - 1, -1, -1):
            initial, kind, copies = rows[i]
            self.all[i] = self.all[i + 1] + DELETE * copies
            self.base[i] = self.base[i + 1] + DELETE * (copies - 1) + (
                DELETE if kind >= DUPLICATE else TRUNCATION if kind == TRUNCATED else 0)
            self.live[i], self.pairs[i] = self.live[i + 1], self.pairs[i + 1]
            after[i] = after[i + 1]
            if kind < DUPLICATE:
                j = self.live[i + 1]
                self.live[i], after[i] = i, j
                if j < n and initial + rows[j][0] not in LEGAL:
                    self.pairs[i] = max(self.pairs[i], self._mend(i, j) + self.pairs[after[j]])
        self.after = after

    def _mend(self, *pair: int) -> int:
        """To delete a truncated row costs one more than to leave it."""
        return DELETE - TRUNCATION if any(self.rows[i][1] == TRUNCATED for i in pair) else min(REROLE, INSERT)

    def __call__(self, i: int, place: int) -> int:
        if max(self.exits) <= SYSTEM:  # no user or assistant row may stay, at most one system row
            return FAR if place > SYSTEM else self.all[i] - DELETE * (place not in self.exits)
        pairs, j = self.pairs[i], self.live[i]
        if j < len(self.rows) and kept_place(place, self.rows[j][0]) is None:
            pairs = max(pairs, self._mend(j) + self.pairs[self.after[j]])
        return self.base[i] + pairs


def cheapest(rows: list[tuple], entry: int, exits: tuple[int, ...], tail: bool) -> tuple[int, str]:
    """Cost and edits (one letter an edit, copies of a row apart) that lead
    from one place of the grammar to one of ``exits``; ``rows`` holds (initial,
    kind, copies). Inserts after the last row are allowed with ``tail`` only.
    The caller sees to it that there is a way."""
    n, estimate = len(rows), Estimate(rows, exits)
    failed: dict[tuple[int, int], int] = {}

    def edits(i: int, place: int) -> Iterator[tuple[str, int, int, int]]:
        """(edit, cost, next row, next place) in ASCII order."""
        following = FOLLOWING[place]
        if i == n:
            if tail:
                yield "I", INSERT, n, following
            return
        initial, kind, copies = rows[i]
        rest = DELETE * (copies - 1)
        yield "D", DELETE + rest, i + 1, place
        yield "I", INSERT, i, following
        if kind < DUPLICATE:
            rest += TRUNCATION if kind == TRUNCATED else 0
            kept = kept_place(place, initial)
            if kept is not None:
                yield "K", KEEP + rest, i + 1, kept
            yield "R", REROLE + rest, i + 1, following

    if n == 0 and entry in exits:
        return 0, ""
    bound = estimate(0, entry)
    while True:
        beyond, path = FAR, []
        frames = [(0, entry, bound, edits(0, entry))]
        while frames:
            i, place, budget, left = frames[-1]
            for edit, cost, j, to in left:
                rest = budget - cost
                need = max(estimate(j, to), failed.get((j, to), -1) + 1)
                if need > rest:
                    beyond = min(beyond, bound - rest + need)
                    continue
                path.append(edit)
                if j == n and to in exits:
                    return bound - rest, "".join(path)
                frames.append((j, to, rest, edits(j, to)))
                break
            else:
                failed[i, place] = max(budget, failed.get((i, place), -1))
                frames.pop()
                if path:
                    path.pop()
        bound = beyond


def ways(rows: list[tuple]) -> tuple[list, list]:
    """Cost and rank among the exits of the answer, by entry and exit."""
    costs = [[FAR] * 4 for _ in range(4)]
    ranks = [[0] * 4 for _ in range(4)]
    has_system = any(r[0] == "s" and r[1] < DUPLICATE for r in rows)
    for entry in range(4):
        found = []
        for to in range(4):
            if not rows or to <= SYSTEM:
                able = to == entry or (bool(rows) and to == SYSTEM and entry == START and has_system)
            else:
                able = True
            if able:
                costs[entry][to], answer = cheapest(rows, entry, (to,), False)
                found.append((answer, to))
        for rank, (_, to) in enumerate(sorted(found)):
            ranks[entry][to] = rank
    return costs, ranks


def follow(pieces: list[tuple[list, list]], entry: int) -> tuple[list, list, list]:
    """Through pieces, each (costs, ranks): cost and rank by exit, and for
    each piece the place before it by the place after it.

    No answer of a piece is the beginning of another, so the first piece in
    which two ways differ decides their order."""
    cost, rank, back = [FAR] * 4, [0] * 4, []
    cost[entry] = 0
    for costs, ranks in pieces:
        best = [min(((cost[a] + costs[a][b], rank[a], ranks[a][b], a) for a in range(4)
                     if cost[a] < FAR and costs[a][b] < FAR), default=None) for b in range(4)]
        order = sorted((b for b in range(4) if best[b]), key=lambda b: best[b][1:3])
        cost = [x[0] if x else FAR for x in best]
        back.append([x[3] if x else -1 for x in best])
        rank = [order.index(b) if b in order else 0 for b in range(4)]
    return cost, rank, back


def places(pieces: list[tuple[list, list]], entry: int, to: int) -> list[tuple[int, int]]:
    """Entry and exit of each piece on the best way between two places."""
    out = []
    for before in reversed(follow(pieces, entry)[2]):
        out.append((before[to], to))
        to = before[to]
    return out[::-1]


class Facts:
    """What is counted of successive rows."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, turn: int | None, initial: str, kind: int, copies: int) -> None:
        self.blank += copies if kind == BLANK else 0
        self.duplicate += copies if kind == DUPLICATE else copies - 1 if kind != BLANK else 0
        self.truncated += kind == TRUNCATED
        one = Facts()
        one.illegal, one.first, one.last = copies - 1, initial, initial
        if turn is not None:
            one.turns, one.low, one.high = 1, turn, turn
        self.join(one)

    def join(self, other: Facts) -> None:
        """Add the facts of the rows that follow."""
        for name in ("blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(self, name, getattr(self, name) + getattr(other, name))
        if other.first is not None:
            self.illegal += self.last is not None and self.last + other.first not in LEGAL
            self.first = other.first if self.first is None else self.first
            self.last = other.last
        if other.low is not None:
            self.turns -= self.high == other.low  # turns ascend
            self.low = other.low if self.low is None else self.low
            self.high = other.high

    def row(self) -> list[int]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return [min(gaps, 2**63 - 1), self.blank, self.duplicate, self.truncated, self.illegal]


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal"]
RESULT = ["conv_id", *COUNTS, "cost", "audit", "repaired_sha256"]
_COUNTS = ", ".join(f"{c} long" for c in COUNTS)
RESULT_SCHEMA = f"conv_id long, {_COUNTS}, cost long, audit string, repaired_sha256 string"
PART_SCHEMA = ("conv_id long, part int, segment int, seq int, piece binary, rows binary, "
               f"{_COUNTS}, cost long, audit string, repaired_sha256 string")


def written(rows: list[tuple], answer: str, entry: int) -> tuple[str, list[str]]:
    """The audit of all copies and the repaired lines; ``rows`` holds
    (initial, kind, copies, role, text)."""
    audit, lines, place, i = [], [], entry, 0
    for edit in answer:
        audit.append(edit)
        if edit == "I":
            place = FOLLOWING[place]
            lines.append(f"{ROLE[place]}:")
            continue
        initial, _, copies, role, text = rows[i]
        i += 1
        audit.append("D" * (copies - 1))
        if edit == "K":
            place = kept_place(place, initial)
            lines.append(f"{role}:{text}")
        elif edit == "R":
            place = FOLLOWING[place]
            lines.append(f"{ROLE[place]}:{text}")
    return "".join(audit), lines


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)],
                                      [name for name, _ in fields])


def _parts(block_rows: int, block_bytes: int):
    """Sorted rows to results of whole conversations, and to blocks and
    segments of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out, segment, seq, size = [], 0, 0, 0
        conv, first, started = None, True, False
        rows: list[tuple] = []
        blocks: list[tuple] = []  # costs and ranks of the conversation's blocks
        facts, block = Facts(), Facts()

        def close_block() -> None:
            nonlocal rows, seq, size, block
            costs = ways([r[:3] for r in rows])
            blocks.append(costs)
            out.append((conv, part, segment, seq, pickle.dumps(costs), pickle.dumps(rows), *[None] * 8))
            facts.join(block)
            rows, seq, size, block = [], seq + 1, 0, Facts()

        def close(edge: bool) -> None:
            nonlocal segment, rows, blocks, facts, block, size
            if edge or blocks:
                close_block()
                composed = [follow(blocks, entry)[:2] for entry in range(4)]
                piece = ([c for c, _ in composed], [r for _, r in composed], facts)
                out.append((conv, part, segment, None, pickle.dumps(piece), None, *[None] * 8))
            else:
                cost, answer = cheapest([r[:3] for r in rows], START, ENDS, True)
                audit, lines = written(rows, answer, START)
                digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
                out.append((conv, part, segment, None, None, None, *block.row(), cost, audit, digest))
            segment, rows, blocks, facts, block, size = segment + 1, [], [], Facts(), Facts(), 0

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5)]
            texts = batch.column(3)
            for i, (conv_id, turn, role, copies, kind) in enumerate(zip(*columns, strict=True)):
                if not started or conv_id != conv:
                    if started:
                        close(first)
                        first = False
                    conv, started = conv_id, True
                if not copies:
                    continue  # only tells that there is such a conversation
                text = texts[i].as_py()
                if rows and (len(rows) >= block_rows or size + len(text) > block_bytes):
                    close_block()
                rows.append((role[:1], kind, copies, role, text))
                block.add(turn, role[:1], kind, copies)
                size += len(text)
                if len(out) >= 256:
                    yield _table(out, PART_SCHEMA)
                    out = []
            if out:
                yield _table(out, PART_SCHEMA)
                out = []
        if started:
            close(True)
            yield _table(out, PART_SCHEMA)

    return run


def _conversation(pdf: pd.DataFrame) -> pd.DataFrame:
    """Places and counts of the segments (one a task) of a conversation."""
    pdf = pdf.sort_values("part")
    pieces = [pickle.loads(p) for p in pdf["piece"]]
    ways_ = [p[:2] for p in pieces]
    cost, rank, _ = follow(ways_, START)
    total, _, to = min((cost[x] + INSERT * TAIL[x], rank[x], x) for x in range(4))
    facts = Facts()
    for p in pieces:
        facts.join(p[2])
    return pd.DataFrame([(part, segment, a, b, *facts.row(), total) for part, segment, (a, b) in zip(
        pdf["part"], pdf["segment"], places(ways_, START, to), strict=True)],
        columns=["part", "segment", "entry", "to", *COUNTS, "cost"])


def _segment(pdf: pd.DataFrame) -> pd.DataFrame:
    """Places of the blocks of a segment."""
    pdf = pdf.sort_values("seq")
    found = places([pickle.loads(p) for p in pdf["piece"]], int(pdf["entry"].iloc[0]), int(pdf["to"].iloc[0]))
    return pd.DataFrame({"part": pdf["part"], "seq": pdf["seq"], "entry": [a for a, _ in found],
                         "to": [b for _, b in found], **{c: pdf[c] for c in [*COUNTS, "cost"]}})


_COSTS = f"{_COUNTS}, cost long"
BLOCK_SCHEMA = f"conv_id long, part int, seq int, to int, {_COSTS}, audit string, lines long, text string"


def _block_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            conv, part, seq, entry, to, *counts = (batch.column(c)[i].as_py() for c in range(11))
            rows = pickle.loads(batch.column(11)[i].as_py())
            answer = cheapest([r[:3] for r in rows], entry, (to,), False)[1]
            audit, lines = written(rows, answer, entry)
            yield _table([(conv, part, seq, to, *counts, audit, len(lines), "\n".join(lines))], BLOCK_SCHEMA)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in order to conversations."""
    conv, open_, audit, digest, empty, end = None, False, [], None, True, None

    def finish() -> pa.RecordBatch:
        lines = [f"{ROLE[r]}:" for r in ((USER, ASSISTANT) if TAIL[end[0]] == 2 else (ASSISTANT,) * TAIL[end[0]])]
        feed("\n".join(lines), len(lines))
        return _table([(conv, *end[1:], "".join(audit) + "I" * len(lines), digest.hexdigest())], RESULT_SCHEMA)

    def feed(text: str, lines: int) -> None:
        nonlocal empty
        if lines:
            digest.update((text if empty else "\n" + text).encode())
            empty = False

    for batch in batches:
        for i in range(batch.num_rows):
            conv_id, _, _, to, *counts, edits, lines, text = (batch.column(c)[i].as_py() for c in range(13))
            if open_ and conv_id != conv:
                yield finish()
                open_ = False
            if not open_:
                conv, open_, audit, digest, empty = conv_id, True, [], hashlib.sha256(), True
            audit.append(edits)
            feed(text, lines)
            end = (to, *counts)
    if open_:
        yield finish()


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", copies_col: str | None = None, block_rows: int = 256,
           block_bytes: int = 4 << 20) -> DataFrame:
    """One row a conversation: conv_id, gaps (missing turns), blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256 (of ``role:text`` lines).

    ``copies_col`` counts how often each row stands, one after another; rows
    that stand 0 times only name their conversation. ``block_rows`` and
    ``block_bytes`` bound what a task holds; they change no result."""
    spark = conversations.sparkSession
    white = F.lit(" \t\n\x0b\f\r")
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
        (F.col(copies_col) if copies_col else F.lit(1)).cast("long").alias("copies"))
    rows, _ = stage(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
                    .withColumn("digest", F.sha2(F.col("text").cast("binary"), 256)))
    first = (rows.filter("copies > 0").groupBy("conv_id", "role", "digest")
             .agg(F.count(F.lit(1)).alias("n"), F.min("turn").alias("_turn"),
                  F.max(F.col("turn").isNull()).alias("_null"))
             .filter("n > 1")
             .select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"),
                     F.when(~F.col("_null"), F.col("_turn")).alias("_turn")))
    last = F.substring(F.rtrim(F.col("text"), white), -1, 1)
    again = F.col("_role").isNotNull() & ~F.col("turn").eqNullSafe(F.col("_turn"))
    kind = (F.when(last == "", BLANK).when(again, DUPLICATE)
            .when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(FINE))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = (rows.join(first, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role"))
                             & (F.col("digest") == F.col("_digest")), "left")
                   .select("conv_id", "turn", "role", "text", "copies", kind.alias("kind"), "digest")
                   .repartitionByRange(n, *order).sortWithinPartitions(*order).drop("digest"))
    parts, _ = stage(sorted_rows.mapInArrow(_parts(block_rows, block_bytes), PART_SCHEMA))
    whole = parts.filter("piece IS NULL").select(*RESULT)
    segments = parts.filter("piece IS NOT NULL AND seq IS NULL").select("conv_id", "part", "segment", "piece")
    blocks = parts.filter("seq IS NOT NULL").select("conv_id", "part", "segment", "seq", "piece", "rows")
    # At most one row of a conversation a task of the sort.
    routes = segments.groupBy("conv_id").applyInPandas(
        _conversation, f"part int, segment int, entry int, to int, {_COSTS}")
    steps = (blocks.select("part", "segment", "seq", "piece").join(routes, ["part", "segment"])
             .groupBy("part", "segment").applyInPandas(_segment, f"part int, seq int, entry int, to int, {_COSTS}"))
    texts = (blocks.select("conv_id", "part", "seq", "rows").join(steps, ["part", "seq"])
             .select("conv_id", "part", "seq", "entry", "to", *COUNTS, "cost", "rows")
             .mapInArrow(_block_texts, BLOCK_SCHEMA))
    long = (texts.repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
            .mapInArrow(_joined, RESULT_SCHEMA))
    return whole.unionByName(long)


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged by crc32(conv_id:turn)
    mod 20 (nulls: one blank): 0 drops a row (copies 0), 1 empties its text, 2
    removes [.!?] from it, 3 repeats it, 4 makes its role user."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), blank))
    kind = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col("text"), blank)
    gone = kind == 0
    return conversations.select(
        F.col("conv_id"), F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(kind == 4, "user").otherwise(F.coalesce(F.col("role"), blank)).alias("role"),
        F.when(gone | (kind == 1), "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
        .alias("text"),
        F.when(gone, 0).when(kind == 3, 2).otherwise(1).alias("copies"))
