"""Token numbers in wavelet-matrix files.

A shard is one file: the token numbers of its documents, in order, as a
wavelet matrix. The matrix has one plane of bits a binary digit, highest
first; every plane orders the tokens stably by the digits of the planes above.
Each plane is cut into blocks of ``BLOCK`` bits, compressed one by one, with a
directory of the one-bits before each block, so that rank and select touch one
block a plane:

* ``access``: the token at a position;
* ``rank`` and ``count``: how often a token occurs before a position, or at all;
* ``select`` and ``occurrences``: where a token occurs.

``write_ids`` encodes whole texts with a tokenizer of the ``tokenizers``
library, appends ``end_id`` to each document, orders documents by id and
writes one Parquet file a shard, holding one row: part, seq (the shard's place),
n_tokens, doc_ids, lengths, matrix. Ranges of ids are dealt to tasks by Spark;
a shard ends with the documents encoded together (about 1 MB of text) with
which it has ``shard_tokens`` tokens, so memory holds one shard, or one document
if that is longer. ``read_documents``,
``count_token`` and ``find_token`` work on the files alone.

Encoding takes the text in pieces between ASCII white space and keeps the
numbers of recent pieces (``PieceEncoder``): the tokenizer must drop white space
and never join what it separates (tests compare with whole texts).

Rows: null text counts as empty (one token, the end); null ids come last; rows
that share an id stand side by side, in the order in which they were read.
Repeated rows are documents of their own. No documents: no rows, and the files
hold nothing. Extra columns are not read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE

from cartwheel.functions.sizing import ensure_checkpoint_dir

BLOCK = 1 << 16  # bits of a block
HEAD = struct.Struct("<4sQI")  # magic, tokens, planes
MAGIC = b"WMX1"


class WaveletMatrix:
    """Read access to the bytes that ``build`` returned."""

    @staticmethod
    def build(tokens: np.ndarray) -> bytes:
        """The file of an array of unsigned numbers below 2**32."""
        order = np.ascontiguousarray(tokens)
        planes = max(1, int(order.max()).bit_length()) if len(order) else 1
        order = order.astype(np.uint16 if planes <= 16 else np.uint32)  # a copy
        squeeze = zstandard.ZstdCompressor(level=1).compress
        parts = [HEAD.pack(MAGIC, len(order), planes)]
        below = np.empty_like(order)
        for plane in range(planes):
            mask = order.dtype.type(1 << (planes - 1 - plane))
            blocks, ones, moved, zeros = [], [0], [], 0
            for at in range(0, len(order), BLOCK):  # block by block: it stays in the processor's cache
                piece = order[at:at + BLOCK]
                bits = (piece & mask).astype(bool)
                blocks.append(squeeze(np.packbits(bits).tobytes()))
                # By places: a mask costs a mispredicted branch a token.
                moved.append(piece.take(np.flatnonzero(bits)))
                ones.append(ones[-1] + len(moved[-1]))
                rest = piece.take(np.flatnonzero(~bits))
                below[zeros:zeros + len(rest)] = rest
                zeros += len(rest)
            below[zeros:] = np.concatenate(moved) if moved else 0
            order, below = below, order
            ends = np.cumsum([0, *map(len, blocks)])
            parts += [np.asarray(ones, "<u8").tobytes(), ends.astype("<u8").tobytes(), *blocks]
        return b"".join(parts)

    def __init__(self, data: bytes) -> None:
        magic, self.n, self.planes = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix")
        self.data, self.cache = memoryview(data), {}
        blocks = -(-self.n // BLOCK)
        at, self.ones, self.ends, self.start = HEAD.size, [], [], []
        for _ in range(self.planes):
            self.ones.append(np.frombuffer(data, "<u8", blocks + 1, at).astype(np.int64))
            at += 8 * (blocks + 1)
            self.ends.append(np.frombuffer(data, "<u8", blocks + 1, at).astype(np.int64))
            at += 8 * (blocks + 1)
            self.start.append(at)
            at += int(self.ends[-1][-1])
        self.zeros = [self.n - int(o[-1]) for o in self.ones]

    def __len__(self) -> int:
        return self.n

    def _block(self, plane: int, block: int) -> np.ndarray:
        """The bits of one block; the last ones used are kept."""
        bits = self.cache.get((plane, block))
        if bits is None:
            a, b = self.start[plane] + self.ends[plane][block:block + 2]
            raw = zstandard.ZstdDecompressor().decompress(bytes(self.data[a:b]))
            bits = np.unpackbits(np.frombuffer(raw, np.uint8), count=min(BLOCK, self.n - block * BLOCK))
            if len(self.cache) >= 64:
                self.cache.clear()
            self.cache[plane, block] = bits
        return bits

    def _rank1(self, plane: int, i: int) -> int:
        """One-bits of a plane before position i."""
        block, rest = divmod(i, BLOCK)
        before = int(self.ones[plane][block])
        return before + (int(np.count_nonzero(self._block(plane, block)[:rest])) if rest else 0)

    def _select(self, plane: int, bit: int, ranks: np.ndarray) -> np.ndarray:
        """Positions of the one-bits (or zero-bits) with these numbers, ascending."""
        before = self.ones[plane]
        if not bit:
            before = np.minimum(np.arange(len(before)) * BLOCK, self.n) - before
        block = np.searchsorted(before, ranks, side="right") - 1
        out = np.empty(len(ranks), np.int64)
        for b in np.unique(block):
            rows = block == b
            places = np.flatnonzero(self._block(plane, int(b)) == bit)
            out[rows] = b * BLOCK + places[ranks[rows] - before[b]]
        return out

    def access(self, i: int) -> int:
        """The token at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for plane in range(self.planes):
            bit = int(self._block(plane, i // BLOCK)[i % BLOCK])
            ones = self._rank1(plane, i)
            i = self.zeros[plane] + ones if bit else i - ones
            token = 2 * token + bit
        return token

    def _range(self, token: int, low: int, high: int) -> tuple[int, int]:
        """Where the token's occurrences in [low, high) lie below the last plane."""
        if token < 0 or token >> self.planes:
            return 0, 0
        for plane in range(self.planes):
            if low >= high:
                return 0, 0
            a, b = self._rank1(plane, low), self._rank1(plane, high)
            one = token >> (self.planes - 1 - plane) & 1
            low, high = (self.zeros[plane] + a, self.zeros[plane] + b) if one else (low - a, high - b)
        return low, high

    def rank(self, token: int, i: int) -> int:
        """Occurrences of the token before position i."""
        low, high = self._range(token, 0, min(max(i, 0), self.n))
        return high - low

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _up(self, token: int, places: np.ndarray) -> np.ndarray:
        for plane in reversed(range(self.planes)):
            one = token >> (self.planes - 1 - plane) & 1
            places = self._select(plane, one, places - self.zeros[plane] if one else places)
        return places

    def select(self, token: int, j: int) -> int:
        """Position of the token's occurrence number j (from 0)."""
        low, high = self._range(token, 0, self.n)
        if not 0 <= j < high - low:
            raise IndexError(j)
        return int(self._up(token, np.array([low + j]))[0])

    def occurrences(self, token: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """All positions of the token in [start, stop), ascending."""
        low, high = self._range(token, max(start, 0), self.n if stop is None else min(stop, self.n))
        return self._up(token, np.arange(low, high))

    def decode(self) -> np.ndarray:
        """All tokens, from the lowest plane up."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        order, above = np.zeros(self.n, kind), np.empty(self.n, kind)
        unpack = zstandard.ZstdDecompressor().decompress
        for plane in reversed(range(self.planes)):
            mask, before = kind(1 << (self.planes - 1 - plane)), self.ones[plane]
            zero, one = 0, self.zeros[plane]
            for block in range(len(before) - 1):
                a, b = self.start[plane] + self.ends[plane][block:block + 2]
                place = above[block * BLOCK:(block + 1) * BLOCK]
                ones = np.unpackbits(np.frombuffer(unpack(self.data[a:b]), np.uint8), count=len(place)).view(bool)
                n = int(before[block + 1] - before[block])
                place[np.flatnonzero(ones)] = order[one:one + n] | mask
                place[np.flatnonzero(~ones)] = order[zero:zero + len(place) - n]
                zero, one = zero + len(place) - n, one + n
            order, above = above, order
        return order


PUNCTUATION = ".,;:!?#$%&*()-+=/"
TAIL = PUNCTUATION.encode()
# A tokenizer's rule that leaves runs of letters whole.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class PieceEncoder:
    """Token numbers of whole texts, piece by piece, by a tokenizer of the
    ``tokenizers`` library that drops white space.

    ``young`` and ``old`` hold the numbers of pieces met lately, as bytes: when
    ``keep`` are young, or take ``32 * keep`` bytes, they become the old ones, and
    older ones go. What the
    tokenizer's file says makes pieces fewer and calls longer: if it lower-cases,
    so are ASCII letters beforehand (but not in texts with an added token); if it
    marks ends of words, many words are encoded in one call and cut at the
    marks, punctuation after a word is a piece of its own, and words that its
    normaliser and splitting rule leave alone go to its model without these."""

    def __init__(self, tokenizer_json: str, keep: int = 1 << 20, longest: int = 64) -> None:
        self.tokenizer, self.keep, self.longest = Tokenizer.from_str(tokenizer_json), keep, longest
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.held = 0  # bytes of the young ones and their numbers
        spec = json.loads(tokenizer_json)
        rules = spec.get("normalizer") or {}
        self.fold = any(r["type"] == "Lowercase" for r in rules.get("normalizers", [rules]) if r)
        self.added = [t["content"].lower().encode() for t in spec["added_tokens"]]
        mark = spec["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if mark and token.endswith(mark)]] = True
        cut = self.tokenizer.pre_tokenizer.pre_tokenize_str(f"ab{PUNCTUATION}") if spec["pre_tokenizer"] else []
        self.apart = [token for token, _ in cut] == ["ab", PUNCTUATION]
        self.plain, self.steady = self._plain(spec) if mark and self.apart else (None, None)

    def _plain(self, spec: dict) -> tuple:
        """The same model without the steps that leave words of some letters as they
        are, and what tells such words: lower-case letters below U+0530, where no
        letter composes with another, that this tokenizer neither changes nor splits."""
        steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
        rules = spec.get("normalizer") or {"type": "Sequence", "normalizers": []}
        rules = rules.get("normalizers", [rules])
        if (spec["model"]["type"] != "BPE"
                or any(s["type"] != "ByteLevel" and (s["type"] != "Split" or s["pattern"] != {"Regex": WORDS})
                       for s in steps)
                or any(r["type"] not in ("NFC", "NFKC", "Lowercase") and r.get("pattern") != {"Regex": r"\s+"}
                       for r in rules)):
            return None, None
        letters = [c for c in map(chr, range(0x61, 0x530)) if c.isalpha() and c == c.lower()]
        normal, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer.pre_tokenize_str
        letters = [c for c in letters if (not normal or normal.normalize_str(f"a{c}b") == f"a{c}b")
                   and len(cut(f"a{c}b")) == len(cut(f"{c}{c}")) == 1]
        if not letters:
            return None, None
        steps = [{"type": "WhitespaceSplit"}, *(s for s in steps if s["type"] == "ByteLevel")]
        plain = {**spec, "normalizer": None, "added_tokens": [], "post_processor": None,
                 "pre_tokenizer": {"type": "Sequence", "pretokenizers": steps}}
        plain = Tokenizer.from_str(json.dumps(plain))
        # No word comes twice: the model's own memory of words only costs time.
        rules = {k: v for k, v in spec["model"].items() if k not in ("type", "vocab", "merges") and v is not None}
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        plain.model = BPE(spec["model"]["vocab"], merges, cache_capacity=0, **rules)
        return plain, re.compile(f"[{''.join(letters)}]+").fullmatch

    def _one_by_one(self, pieces: list[str]) -> list[bytes]:
        return [np.asarray(c.ids, "<u4").tobytes()
                for c in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _words(self, words: list[str], tokenizer: Tokenizer) -> list[bytes]:
        """Numbers of words of letters."""
        coded = tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
        ids = np.asarray(coded.ids, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):  # no such marks
            return self._one_by_one(words)
        data, ends = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def _learn(self, new: list[bytes]) -> list[bytes]:
        """The numbers of these pieces, at most a few thousand."""
        young, steady = self.young, self.steady
        texts = b" ".join(new).decode().split(" ")
        left = range(len(new))
        out = [b""] * len(new)
        if steady:
            alone = list(map(steady, texts))
            whole = [i for i, match in enumerate(alone) if match]
            if whole:
                for i, numbers in zip(whole, self._words([texts[i] for i in whole], self.plain), strict=True):
                    out[i] = numbers
            left = [i for i, match in enumerate(alone) if not match]
        known, plain, words, others, joined = {b"": b""}, {}, {}, {}, []
        for i in left:
            piece, text = new[i], texts[i]
            word, rest = (piece.rstrip(TAIL) if self.apart else b""), piece
            if word:
                text = text[:len(text) - len(piece) + len(word)]
                if not text.isalpha():  # signs belong to the run of signs behind them
                    word = b""
                elif word in young:
                    known[word] = young[word]
                elif steady and steady(text):
                    plain[word] = text
                else:
                    words[word] = text
                rest = piece[len(word):]
            if rest and rest not in others:
                others[rest] = rest.decode()
            joined.append((i, word, rest))
        if plain:
            known.update(zip(plain, self._words(list(plain.values()), self.plain), strict=True))
        if words:
            known.update(zip(words, self._words(list(words.values()), self.tokenizer), strict=True))
        if others:
            known.update(zip(others, self._one_by_one(list(others.values())), strict=True))
        for i, word, rest in joined:
            out[i] = known[word] + known[rest]
        return out

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all texts, one after another, and how many each has."""
        folded = []
        for text in texts:
            low = text.lower() if self.fold else text  # of ASCII letters
            folded.append(text if any(t in low for t in self.added) else low)
        pieces, which, of_text = _distinct_pieces(folded)
        if len(self.young) > self.keep or self.held > 32 * self.keep:
            self.young, self.old, self.held = {}, self.young, 0
        young, old = self.young, self.old
        coded = list(map(young.get, pieces))
        missing = [i for i, numbers in enumerate(coded) if numbers is None]
        names = list(map(pieces.__getitem__, missing))
        numbers = list(map(old.get, names))
        new = [p for p, found in zip(names, numbers) if found is None]
        learned = []
        for at in range(0, len(new), 2048):
            learned += self._learn(new[at:at + 2048])
            young.update(zip(new[at:at + 2048], learned[at:]))
        following = iter(learned)
        numbers = [next(following) if found is None else found for found in numbers]
        for i, found in zip(missing, numbers):
            coded[i] = found
        young.update(zip(names, numbers))
        self.held += sum(map(len, names)) + sum(map(len, numbers))
        for piece in new:
            if len(piece) > self.longest:
                self.held -= len(piece) + len(young.pop(piece))
        numbers = np.frombuffer(b"".join(coded), "<u4")
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        size = sizes[which]
        ends = np.cumsum(size)
        at = np.arange(len(numbers) and ends[-1]) + np.repeat((np.cumsum(sizes) - sizes)[which] - (ends - size), size)
        return numbers[at], np.bincount(of_text, size, len(texts)).astype(np.int64)


_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\n\x0b\x0c\r")] = True
_POWERS = np.multiply.accumulate(np.full(4096, 0x9E3779B97F4A7C15, np.uint64))
_SHORT = 64  # bytes of a run that is hashed, eight at a time
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # of the first n of eight bytes


def _distinct_pieces(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct runs between ASCII white space; for every run in order its
    number among them, and its text. Short runs are grouped by a hash of their bytes
    and compared byte by byte with the first of the group."""
    joined = b"\n".join([*texts, b"\n" * 8])  # so that eight bytes can be read at any place
    data = np.frombuffer(joined, np.uint8)
    blank = _BLANK[data]
    edges = np.flatnonzero(np.diff(blank, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    of_text = np.searchsorted(text_ends, starts, side="right")
    if not len(starts):
        return [], starts, of_text
    sizes = ends - starts
    eight = np.ndarray(len(joined) - 7, "<u8", joined, strides=(1,))
    short = sizes <= _SHORT
    hashes = sizes.astype(np.uint64) * _POWERS[-1]
    words = []  # the runs that have them, and their next eight bytes
    rows = np.flatnonzero(short)
    while len(rows):
        at = 8 * len(words)
        word = eight[starts[rows] + at] & _MASKS[np.minimum(sizes[rows] - at, 8)]
        hashes[rows] += word * _POWERS[len(words)]
        words.append((rows, word))
        rows = rows[sizes[rows] > at + 8]
    groups = pa.array(hashes).dictionary_encode()
    which = groups.indices.to_numpy().astype(np.intp)
    first = np.empty(len(groups.dictionary), np.intp)
    first[which[::-1]] = np.arange(len(which) - 1, -1, -1)  # the last to be written stays
    same = first[which]
    equal = short.all() and (sizes == sizes[same]).all()
    for k, (rows, word) in enumerate(words):
        own = same[rows]
        equal = equal and (word == eight[starts[own] + 8 * k] & _MASKS[np.minimum(sizes[own] - 8 * k, 8)]).all()
    if equal:
        return [joined[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())], which, of_text
    numbers: dict[bytes, int] = {}  # a long run, or two different runs have one hash
    which = np.fromiter((numbers.setdefault(joined[a:b], len(numbers))
                         for a, b in zip(starts.tolist(), ends.tolist())), np.int64, len(starts))
    return list(numbers), which, of_text


_ENCODERS: dict[str, PieceEncoder] = {}  # of this Python worker, for its next tasks


def _encoder(tokenizer_json: str) -> PieceEncoder:
    if tokenizer_json not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[tokenizer_json] = PieceEncoder(tokenizer_json)
    return _ENCODERS[tokenizer_json]


SHARD_SCHEMA = "part int, seq int, n_tokens long, doc_ids array<long>, lengths array<long>, matrix binary"


def _batches(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, list[bytes]]]:
    """Ids and texts, about ``limit`` bytes (or one text) at a time."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            ids.append(doc_id)
            texts.append(text.as_py() or b"")
            size += len(texts[-1]) + 16
            if size >= limit:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def write_ids(docs: DataFrame, path: str, tokenizer_json: str, end_id: int, id_col: str = "doc_id",
              text_col: str = "text", shard_tokens: int = 8 << 20, shard_docs: int = 1 << 20) -> None:
    """Write the files of ``docs`` into the folder ``path``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer_json)  # one vocabulary file, a parameter
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The row's place spreads rows that share an id over several tasks.
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
            .withColumn("place", F.monotonically_increasing_id())
            .repartitionByRange(n, F.col("id").asc_nulls_last(), F.col("place"))
            .sortWithinPartitions(F.col("id").asc_nulls_last(), F.col("place")).select("id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        part, seq = TaskContext.get().partitionId(), 0
        coder = _encoder(shared.value)
        ids, lengths, data, size = [], [], [], 0

        def shard() -> pa.RecordBatch:
            matrix = WaveletMatrix.build(np.concatenate(data))
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([size], pa.int64()),
                 pa.array([ids], pa.list_(pa.int64())), pa.array([np.concatenate(lengths)], pa.list_(pa.int64())),
                 pa.array([matrix], pa.binary())],
                ["part", "seq", "n_tokens", "doc_ids", "lengths", "matrix"])

        for some, texts in _batches(batches, 5 << 18):
            tokens, counts = coder.encode(texts)
            ids += some
            lengths.append(counts + 1)
            data.append(np.insert(tokens, np.cumsum(counts), end_id))
            size += len(data[-1])
            if size >= shard_tokens or len(ids) >= shard_docs:
                yield shard()
                ids, lengths, data, size, seq = [], [], [], 0, seq + 1
        if ids:
            yield shard()

    (rows.mapInArrow(run, SHARD_SCHEMA).write.mode("overwrite")
     .option("maxRecordsPerFile", 1).option("compression", "uncompressed").parquet(path))


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD_SCHEMA).parquet(path)


def _starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, seq, start): tokens in the shards before each."""
    sizes = read_shards(spark, path).select("part", "seq", "n_tokens")

    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row a part; parts are numbers of tasks.
    parts = (sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
             .select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (sizes.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(parts, "part").select("part", "seq", (F.col("_before") + F.col("_inside")).alias("start")))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lengths = np.asarray(batch.column(3)[i].values)
                tokens = WaveletMatrix(batch.column(4)[i].as_py()).decode()
                ends = np.cumsum(lengths)
                sums = [zlib.crc32(tokens[e - n:e].astype("<u4")) for e, n in zip(ends, lengths, strict=True)]
                place = [pa.array(np.full(len(lengths), batch.column(c)[i].as_py(), np.int32)) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*place, batch.column(2)[i].values, pa.array(ends - lengths), batch.column(3)[i].values,
                     pa.array(sums, pa.int64())],
                    ["part", "seq", "doc_id", "inside", "n_tokens", "ids_crc32"])

    found = read_shards(spark, path).select("part", "seq", "doc_ids", "lengths", "matrix").mapInArrow(
        run, "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return found.join(_starts(spark, path), ["part", "seq"]).select(
        "doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def count_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(token, count): how often the token occurs in the files, by rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [WaveletMatrix(m.as_py()).count(token) for m in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(counts, pa.int64())], ["n"])

    found = read_shards(spark, path).select("matrix").mapInArrow(run, "n long")
    return found.agg(F.lit(token).alias("token"), F.coalesce(F.sum("n"), F.lit(0)).alias("count"))


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(doc_id, position): where the token occurs, by select; position counts
    from the start of the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, lengths = batch.column(0)[i].values, np.asarray(batch.column(1)[i].values)
                places = WaveletMatrix(batch.column(2)[i].as_py()).occurrences(token)
                ends = np.cumsum(lengths)
                owner = np.searchsorted(ends, places, side="right")
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(owner)), pa.array(places - (ends - lengths)[owner], pa.int64())],
                    ["doc_id", "position"])

    return read_shards(spark, path).select("doc_ids", "lengths", "matrix").mapInArrow(
        run, "doc_id long, position long")


def new_folder(spark: SparkSession) -> str:
    """A fresh folder in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
