"""Exact deduplication by Grace hashing.

Records are partitioned by a digest of their normalised text until each
bucket fits an open-addressing table in memory, and the table decides by
comparing complete contents; digests only choose buckets and slots.

1. Every map task passes its rows through such a table, so a text leaves a
   task once, with the number and the smallest id of its local copies (a
   text held by a third of all rows becomes one record per task). When the
   table is full it is emptied and started anew.
2. The records are shuffled by digest (the first partitioning pass). Each
   reducing task fills a table; where its contents outgrow ``table_bytes``
   it deals all records to 16 spill files by the next hexadecimal digit of
   the digest and recurses into each. Spill files live in the task's own
   temporary folder, like Spark's shuffle spill, and end with the task.
3. Rows learn their class through the key of their local class, which is
   held by the rows of one map task only, so no join key is hot.

Rows: null text counts as empty; of equal texts the row with the smallest id
stays (a null id comes last); of repeated rows with the same id exactly one
stays. An empty table gives an empty result.
"""

from __future__ import annotations

import os
import pickle
import shutil
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import WHITE_SPACE, stage

FAN_OUT = 16  # one hexadecimal digit of the digest a level
DIGITS = 64  # of a SHA-256 digest


class OpenTable:
    """Open-addressing table with linear probing over complete contents.

    An entry is [digest, text, smallest id, its row, number of rows, keys of
    the local classes]. ``add`` merges equal texts.
    """

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.entries: list[list] = []
        self.bytes = 0

    def add(self, digest: str, text: bytes, smallest, row: int, count: int, keys: list[int]) -> list:
        mask = len(self.slots) - 1
        at = int(digest[-12:], 16) & mask
        while (found := self.slots[at]) >= 0:
            entry = self.entries[found]
            if entry[0] == digest and entry[1] == text:
                if _before(smallest, row, entry[2], entry[3]):
                    entry[2], entry[3] = smallest, row
                entry[4] += count
                entry[5] += keys
                self.bytes += 8 * len(keys)
                return entry
            at = (at + 1) & mask
        self.slots[at] = len(self.entries)
        entry = [digest, text, smallest, row, count, list(keys)]
        self.entries.append(entry)
        self.bytes += len(text) + 300 + 8 * len(keys)
        if len(self.entries) * 10 > len(self.slots) * 7:
            self._grow()
        return entry

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for i, entry in enumerate(self.entries):
            at = int(entry[0][-12:], 16) & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = i


def _before(id_a, row_a: int, id_b, row_b: int) -> bool:
    """Order by id, nulls last, then by row."""
    if id_a is None or id_b is None:
        return (id_a is None, row_a) < (id_b is None, row_b) if id_a is id_b else id_b is None
    return (id_a, row_a) < (id_b, row_b)


def grace(records: Iterable[tuple], table_bytes: int, level: int = 0) -> Iterator[list]:
    """Merge records (digest, text, smallest id, row, count, keys) of equal
    text; at most ``table_bytes`` of distinct contents are held at a time."""
    table = OpenTable()
    records = iter(records)
    for record in records:
        table.add(*record)
        if table.bytes > table_bytes and len(table.entries) > 1 and level < DIGITS:
            break
    else:
        yield from table.entries
        return
    folder = tempfile.mkdtemp(prefix="grace-")
    try:
        files = [open(os.path.join(folder, f"{i:x}"), "wb") for i in range(FAN_OUT)]
        try:
            for source in (table.entries, records):
                for record in source:
                    pickle.dump(tuple(record), files[int(record[0][level], 16)], protocol=5)
            del table
        finally:
            for f in files:
                f.close()
        for f in files:
            yield from grace(_spilled(f.name), table_bytes, level + 1)
            os.unlink(f.name)
    finally:
        shutil.rmtree(folder, ignore_errors=True)


def _spilled(path: str) -> Iterator[tuple]:
    with open(path, "rb") as f:
        while True:
            try:
                yield pickle.load(f)
            except EOFError:
                return


LOCAL_SCHEMA = ("is_class boolean, local long, row long, doc_id long, count long, "
                "digest string, content binary")
CLASS_SCHEMA = "local long, keep_id long, keep_row long, group_size long, text_sha256 string"


def _local_classes(table_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        at, table = 0, OpenTable()

        def classes() -> pa.RecordBatch:
            e = table.entries
            n = len(e)
            return pa.RecordBatch.from_arrays(
                [pa.array([True] * n, pa.bool_()), pa.array([x[5][0] for x in e], pa.int64()),
                 pa.array([x[3] for x in e], pa.int64()), pa.array([x[2] for x in e], pa.int64()),
                 pa.array([x[4] for x in e], pa.int64()), pa.array([x[0] for x in e], pa.string()),
                 pa.array([x[1] for x in e], pa.binary())], names)

        names = ["is_class", "local", "row", "doc_id", "count", "digest", "content"]
        for batch in batches:
            ids, digests = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            texts = batch.column(1)
            members: list[int] = []
            flushed = []
            for i, (doc_id, digest) in enumerate(zip(ids, digests, strict=True)):
                row = base + at
                at += 1
                entry = table.add(digest, texts[i].as_py(), doc_id, row, 1, [])
                if not entry[5]:
                    entry[5].append(row)  # the first row's number names the local class
                members.append(entry[5][0])
                if table.bytes > table_bytes:
                    flushed.append(classes())
                    table = OpenTable()
            n = len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([False] * n, pa.bool_()), pa.array(members, pa.int64()),
                 pa.array(range(base + at - n, base + at), pa.int64()), batch.column(0),
                 pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.nulls(n, pa.binary())], names)
            yield from flushed
        yield classes()

    return run


def _global_classes(table_bytes: int):
    def records(batches):
        for batch in batches:
            local, row, ids, count, digest = (batch.column(i).to_pylist() for i in range(5))
            for i in range(batch.num_rows):
                yield (digest[i], batch.column(5)[i].as_py(), ids[i], row[i], count[i], [local[i]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def full() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["local", "keep_id", "keep_row", "group_size", "text_sha256"])

        for digest, _, smallest, row, count, keys in grace(records(batches), table_bytes):
            for key in keys:
                out.append((key, smallest, row, count, digest))
                if len(out) >= 50_000:
                    yield full()
                    out.clear()
        yield full()

    return run


def normalise_white_space(text: Column) -> Column:
    """Each run of ASCII white space becomes one blank; null becomes ''."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                table_bytes: int = 96 << 20, local_bytes: int = 48 << 20) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    ``table_bytes`` and ``local_bytes`` bound the distinct contents that a
    reducing and a mapping task hold; they change no result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       normalise_white_space(F.col(text_col)).alias("content"))
    rows = rows.select("doc_id", F.col("content").cast("binary").alias("content"),
                       F.sha2(F.col("content").cast("binary"), 256).alias("digest"))
    local, _ = stage(rows.mapInArrow(_local_classes(local_bytes), LOCAL_SCHEMA))
    classes = (local.filter("is_class").select("local", "row", "doc_id", "count", "digest", "content")
               .repartition("digest").mapInArrow(_global_classes(table_bytes), CLASS_SCHEMA))
    members = local.filter("NOT is_class").select("local", "row", "doc_id")
    return members.join(classes, "local").select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        "text_sha256")
