"""SimHash near-deduplication with a segment-popcount embedding.

Fingerprints (64 bits) are cut into segments of ``segment_bits`` bits; the
number of set bits in each segment embeds a fingerprint in a small integer
space. Manhattan distance there never exceeds Hamming distance, because one
flipped bit moves one coordinate by at most one.

Range join: the segments are halved into two blocks. Two fingerprints within
d bits are, in at least one block, within d // 2 of each other, so every
fingerprint enters the grid cell of each block (as owner) and the cells
within d // 2 of it (as visitor). Steps are taken upwards only: of two cells
one apart, one is reached from the other by a step up; for larger distances
all the cells of the neighbourhood are visited. In a cell owners meet owners
and visitors; each meeting is verified by the exact Hamming distance. A cell
is reduced to the spanning edges of its links (union-find), never to all
pairs, and cells hold distinct fingerprints only, so a large group of copies
is one point.

Expected meetings grow with the square of the number of *distinct*
fingerprints times the chance that two random ones share a cell, about
2^-22 for ``segment_bits=2``; ``segment_bits=1`` makes cells rarer still.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import connected_components, salt, stage

SEED = 42


def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash of one text as a signed 64-bit number: A-Z lower-cased, ASCII
    white space parts words, shingles of ``words`` words joined by a blank
    (a shorter text is one shingle), XXH64 with seed 42; a bit is set where
    over half of the hashes, repeats included, have it. No word: 0."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(parts) < words:
        hashes = [digest(b" ".join(parts), SEED)]
    else:
        joined = b" ".join(parts)
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1:].tolist())]
    values = np.array(hashes, dtype="<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(values), 1 << 16):
        part = values[i:i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(values)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     words: int = 3, keep: list[Column] | None = None) -> DataFrame:
    """doc_id, fingerprint, and the columns ``keep`` (long) of every row."""
    keep = keep or []
    names = [f"_k{i}" for i in range(len(keep))]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"),
                       *[k.cast("long").alias(n) for k, n in zip(keep, names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            prints = pa.array((fingerprint(texts[i].as_py(), words) for i in range(len(texts))),
                              pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), prints, *[batch.column(2 + i) for i in range(len(names))]],
                ["doc_id", "fingerprint", *names])

    schema = ", ".join(["doc_id long", "fingerprint long", *[f"{n} long" for n in names]])
    return rows.mapInArrow(run, schema)


def popcounts(prints: np.ndarray, segment_bits: int) -> np.ndarray:
    """The embedding: (n, 64 / segment_bits) counts of set bits."""
    bits = np.unpackbits(prints.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.reshape(len(prints), 64 // segment_bits, segment_bits).sum(axis=2, dtype=np.int64)


def cells(prints: np.ndarray, max_bits: int, segment_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(cell, fingerprint, visitor 0/1) arrays: the grid entries of the prints."""
    counts = popcounts(prints, segment_bits)
    half = counts.shape[1] // 2
    radius = max_bits // 2
    base = segment_bits + 1
    place = np.array([base ** i for i in range(half)], dtype=np.int64)
    for block in (0, 1):
        own_counts = counts[:, block * half:(block + 1) * half]
        # The last bit tells the blocks apart.
        own = (own_counts @ place) * 2 + block
        yield own, prints, 0
        steps = [1] if radius == 1 else [1, -1]
        reached = [(own_counts, own, prints, 0)] if radius else []
        for depth in range(radius):
            following = []
            for at, cell, who, first in reached:
                # Segments in rising order; a segment is left for good once
                # passed, or stepped again in the direction it was stepped.
                for i in range(first, half):
                    for step in steps:
                        ok = at[:, i] < segment_bits if step > 0 else at[:, i] > 0
                        if not ok.any():
                            continue
                        moved = at[ok].copy()
                        moved[:, i] += step
                        out = cell[ok] + 2 * step * place[i]
                        yield out, who[ok], 1
                        following.append((moved, out, who[ok], i))
            reached = following if depth + 1 < radius else []


def _enter_grid(max_bits: int, segment_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(prints), 4096):
                for cell, who, visitor in cells(prints[i:i + 4096], max_bits, segment_bits):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell), pa.array(who), pa.array(np.full(len(cell), visitor, np.int8))],
                        ["cell", "fingerprint", "visitor"])

    return run


def spanning_links(cell: np.ndarray, prints: np.ndarray, visitor: np.ndarray, max_bits: int):
    """Spanning edges of the links inside each cell (rows sorted by cell,
    owners first): row i meets row i + d for d = 1, 2, ... while the two share
    a cell and row i is an owner."""
    n = len(cell)
    parent = list(range(n))
    label = np.arange(n)
    left, right = [], []

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    alive = np.flatnonzero(visitor == 0)
    bits = prints.view(np.uint64)
    d = 1
    while len(alive):
        alive = alive[alive + d < n]
        alive = alive[cell[alive] == cell[alive + d]]
        near = alive[np.bitwise_count(bits[alive] ^ bits[alive + d]) <= max_bits]
        near = near[label[near] != label[near + d]]
        joined = False
        for i in near.tolist():
            a, b = find(i), find(i + d)
            if a != b:
                parent[max(a, b)] = min(a, b)
                left.append(i)
                right.append(i + d)
                joined = True
        if joined:
            label = np.array(parent)
            while True:
                up = label[label]
                if np.array_equal(up, label):
                    break
                label = up
        d += 1
    return prints[np.array(left, np.int64)], prints[np.array(right, np.int64)]


def _verify(max_bits: int, cell_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def links(parts) -> pa.RecordBatch:
            cell, prints, visitor = (np.concatenate(x) for x in zip(*parts, strict=True))
            a, b = spanning_links(cell, prints, visitor, max_bits)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            part = tuple(batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            last = part[0][-1]
            cut = int(np.searchsorted(part[0] == last, True))  # where the last cell starts
            if cut == 0 and held and held[0][0][0] == last:
                held.append(part)  # the same cell goes on
                if part[2][-1] and sum(len(x[0]) for x in held) > 4 * cell_rows:
                    # All owners are here: visitors met so far need not be kept.
                    yield links(held)
                    held = [tuple(np.concatenate(x) for x in zip(*held, strict=True))]
                    held = [tuple(x[held[0][2] == 0] for x in held[0])]
                    if not len(held[0][0]):  # nobody owns the cell
                        held = [tuple(x[:1] for x in part)]
                continue
            ready = held + ([tuple(x[:cut] for x in part)] if cut else [])
            if ready:
                yield links(ready)
            held = [tuple(x[cut:] for x in part)]
        if held:
            yield links(held)

    return run


def _owned(batches: Iterator[pa.RecordBatch], max_bits: int, segment_bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        for cell, _, visitor in cells(prints, max_bits, segment_bits):
            if not visitor:
                yield pa.RecordBatch.from_arrays([pa.array(cell)], ["cell"])


def _equal_parts(max_bits: int) -> Column:
    """Numbers that two fingerprints within ``max_bits`` bits share at least one
    of: each half is cut into max_bits + 1 pieces, of which one is equal in both;
    the numbers are the pairs of a piece of each half."""
    n = max_bits + 1
    width = 32 // n

    def piece(half: int, i: int) -> Column:
        size = width if i < n - 1 else 32 - width * (n - 1)
        return F.shiftrightunsigned("fingerprint", 32 * half + width * i).bitwiseAND(F.lit((1 << size) - 1))

    return F.array(*[F.xxhash64(F.lit(i), F.lit(j), piece(0, i), piece(1, j)) for i in range(n) for j in range(n)])


def link_fingerprints(prints: DataFrame, max_bits: int = 3, segment_bits: int = 2,
                      cell_rows: int = 16384) -> DataFrame:
    """Edges (a, b) whose components are those of the graph that links
    distinct fingerprints (column ``fingerprint``) at ``max_bits`` or fewer
    differing bits.

    A cell with more than ``cell_rows`` owners is split by equal pieces of the
    fingerprints (every link shares one, so none is lost), and what is still
    larger by owners: each block of about ``cell_rows`` owners meets all rows.
    A task holds the owners of one cell and ``4 * cell_rows`` others at a time.
    """
    distinct = prints.select("fingerprint").distinct()
    grid = distinct.mapInArrow(_enter_grid(max_bits, segment_bits), "cell long, fingerprint long, visitor byte")
    owned = distinct.mapInArrow(lambda batches: _owned(batches, max_bits, segment_bits), "cell long")

    def crowded(owners: DataFrame) -> DataFrame:
        return (owners.groupBy("cell").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > cell_rows))

    hot, _ = stage(crowded(owned))
    if not hot.isEmpty():
        marked = grid.join(hot, "cell", "left")
        split, _ = stage(marked.filter("_n IS NOT NULL").select(
            "cell", "fingerprint", "visitor", F.explode(_equal_parts(max_bits)).alias("_part"))
            .select(F.xxhash64("cell", "_part").alias("cell"), "fingerprint", "visitor"))
        dense = crowded(split.filter("visitor = 0"))
        again = split.join(dense, "cell", "left")
        blocks = F.ceil(F.col("_n") / cell_rows).cast("int")
        own = F.pmod(F.xxhash64("fingerprint"), blocks)
        dealt = (again.filter("_n IS NOT NULL")
                 .withColumn("_block", F.explode(F.sequence(F.lit(0), blocks - 1)))
                 .select(F.xxhash64("cell", "_block").alias("cell"), "fingerprint",
                         F.when((F.col("visitor") == 0) & (own == F.col("_block")), 0).otherwise(1)
                         .cast("byte").alias("visitor")))
        grid = (marked.filter("_n IS NULL").drop("_n")
                .unionByName(again.filter("_n IS NULL").drop("_n")).unionByName(dealt))
    # Cells are counts packed as digits: hashed, so that partitions are even.
    sorted_grid = grid.repartition("cell").sortWithinPartitions("cell", "visitor", "fingerprint")
    return sorted_grid.mapInArrow(_verify(max_bits, cell_rows), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words: int = 3, max_bits: int = 3, segment_bits: int = 2,
                    keep: list[Column] | None = None) -> DataFrame:
    """doc_id, fingerprint (signed long), component_id and component for every
    row, and the columns ``keep`` as _k0, _k1, ...

    component is the smallest fingerprint that links of at most ``max_bits``
    bits reach, component_id the smallest doc_id. Null or blank texts have
    fingerprint 0 and link like others; rows with a null id take part
    (component_id is null only where all ids are); repeated rows stay. An
    empty table gives an empty result.
    """
    rows, _ = stage(with_fingerprint(docs, id_col, text_col, words, keep))
    # One row per (salt, fingerprint): a fingerprint held by a third of all
    # rows is spread over the salts before it is joined.
    salted = rows.withColumn("_salt", salt("doc_id"))
    local = salted.groupBy("_salt", "fingerprint").agg(F.min("doc_id").alias("_low"))
    points, _ = stage(local.groupBy("fingerprint").agg(F.min("_low").alias("_low")))
    parts = connected_components(link_fingerprints(points, max_bits, segment_bits))
    placed, _ = stage(points.join(parts.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
                      .withColumn("component", F.coalesce("component", "fingerprint")))
    smallest = placed.groupBy("component").agg(F.min("_low").alias("component_id"))
    classes = placed.join(smallest, "component").select("fingerprint", "component_id", "component")
    spread = local.select("_salt", "fingerprint").join(classes, "fingerprint")
    return salted.join(spread, ["_salt", "fingerprint"]).drop("_salt")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                     max_bits: int = 3, segment_bits: int = 2) -> DataFrame:
    """The rows of ``docs``, one of each group of near duplicates: the one
    with the smallest id; of rows of the group that share it, one of those
    with the smallest hash of all columns (so too where every id is null)."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    whole = F.xxhash64(*columns, *[c.isNull() for c in columns])
    found = near_duplicates(docs, id_col, text_col, words, max_bits, segment_bits, keep=[whole])
    best = (found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("component").agg(F.min("_k0").alias("_whole")))
    rows = docs.select(F.struct("*").alias("row"), whole.alias("_whole"))
    # Rows that meet are the same row: a text has one component.
    met = rows.join(best.select("_whole"), "_whole")
    first = Window.partitionBy("_whole").orderBy("_whole")
    return (met.withColumn("_copy", F.row_number().over(first)).filter("_copy = 1").select("row.*"))


def to_hex(fingerprint_col: Column) -> Column:
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fingerprint_col), 16, "0"))
