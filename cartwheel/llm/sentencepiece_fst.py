"""SentencePiece encoding and decoding by weighted finite-state transducers.

Three transducers are compiled from a model file:

* the normaliser N, text -> text: blanks become U+2581 and one is put in
  front, as the model's normaliser rule asks for;
* the pieces P, text -> pieces: an arc for every piece that matches at a
  position; for characters that no piece holds, the byte-fallback arcs
  (<0xNN>, one a byte), or the unknown piece if the model has none;
* for BPE models the follower F, an acceptor of piece sequences: piece b may
  follow piece a only if merging the text of both, best-ranked merge first,
  gives a and b again. A sequence of which all neighbours pass is the model's
  own segmentation (the merge order leaves exactly one).

An input is composed with N, P (and F), and the shortest path of the result
in the tropical semiring (min, +) is the encoding: arcs of a unigram model
weigh minus their log probability, arcs of a BPE model 0, or infinity where F
has no arc. States of the composition are positions in the text for unigram
models; (position, last piece) for BPE models, of which one a position is
reachable.

The lattice falls apart where no piece holds two neighbouring characters in a
row: every path passes through that position. Texts are cut there, and the
paths of the short spans between cuts are remembered (a bounded number of
them), since the shortest path of a text is the concatenation of those.

Decoding inverts P (pieces and byte runs to text; bytes that are not UTF-8
become U+FFFD) and N.

Rows: null text has null ids; the empty text has none; texts may be of any
length; repeated rows are encoded alike; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
REMEMBERED = 600_000  # spans and pairs of pieces that a worker remembers


@dataclass(frozen=True)
class Model:
    """What the transducers need of a model file."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    model_type: int
    add_prefix: bool
    collapse_blanks: bool
    reached: frozenset[int] = frozenset()  # BPE: pieces that merging can reach


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            if byte < 128:
                return out
            shift += 7

    while at < len(data):
        key = varint()
        number, wire = key >> 3, key & 7
        if wire == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(wire) or varint()
            yield number, data[at:at + size]
            at += size


def load_model(path: str) -> Model:
    """Read a .model file (pieces, model type, normaliser rule)."""
    with open(path, "rb") as f:
        message = list(_fields(f.read()))
    pieces, scores, kinds = [], [], []
    trainer, normaliser = {}, {}
    for number, value in message:
        if number == 1:
            piece = dict(_fields(value))
            pieces.append(piece[1].decode("utf-8"))
            scores.append(float(np.frombuffer(piece[2], "<f4")[0]) if 2 in piece else 0.0)
            kinds.append(piece.get(3, NORMAL))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normaliser = dict(_fields(value))
    if normaliser.get(2):
        raise ValueError("models with a character map (not the identity rule) are not supported")
    model = Model(tuple(pieces), tuple(scores), tuple(kinds), trainer.get(3, UNIGRAM),
                  bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1)))
    if model.model_type != BPE:
        return model
    coder = Encoder(model)
    return replace(model, reached=frozenset(
        i for p, i in coder.ids.items() if len(p) == 1 or len(coder.merged(p)) == 1))


class Encoder:
    """The compiled transducers of a model, and the paths found so far."""

    def __init__(self, model: Model) -> None:
        self.model = model
        usable = (NORMAL, USER)
        self.ids = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k in usable}
        self.byte_ids = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds))
                         if k == BYTE}
        self.unknown = next((i for i, k in enumerate(model.kinds) if k == UNKNOWN), 0)
        self.longest = max(map(len, self.ids), default=1)
        self.bpe = model.model_type == BPE
        self.paths: dict[str, tuple[int, ...]] = {}
        self.follows: dict[tuple[int, int], bool] = {}
        self._compile_cuts()
        self._compile_arcs()

    # -- normaliser ---------------------------------------------------------

    def normalise(self, text: str) -> str:
        if self.model.collapse_blanks:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        text = text.replace(" ", SPACE)
        return SPACE + text if self.model.add_prefix else text

    # -- pieces -------------------------------------------------------------

    def _compile_cuts(self) -> None:
        """Which two characters stand side by side in a piece: a bit table
        over the characters that pieces hold (class 0: any other)."""
        held = sorted({c for p in self.ids for c in p})
        self.classes = np.zeros(0x110000, np.uint16)
        self.classes[[ord(c) for c in held]] = np.arange(1, len(held) + 1)
        self.bound = np.zeros((len(held) + 1, len(held) + 1), bool)
        for p in self.ids:
            if len(p) > 1:
                at = self.classes[[ord(c) for c in p]]
                self.bound[at[:-1], at[1:]] = True

    def _compile_arcs(self) -> None:
        """Every beginning of a piece -> the piece it is, or -1. In a BPE
        model a piece that merging cannot reach has no arc."""
        self.arcs: dict[str, int] = {}
        for p, i in self.ids.items():
            for end in range(1, len(p)):
                self.arcs.setdefault(p[:end], -1)
            if not self.bpe or i in self.model.reached or len(p) == 1:
                self.arcs[p] = i

    def spans(self, text: str) -> list[str]:
        """The text cut wherever no piece can stand."""
        at = self.classes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        ends = (np.flatnonzero(~self.bound[at[:-1], at[1:]]) + 1).tolist()
        return [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)])]

    def _fallback(self, char: str) -> tuple[int, ...]:
        """The arcs of a character that no piece matches."""
        if not self.byte_ids:
            return (self.unknown,)
        return tuple(self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass"))

    # -- follower -----------------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """Segmentation of a short text by merging, best score first."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                piece = self.ids.get(parts[i] + parts[i + 1])
                if piece is not None and (best is None or self.model.scores[piece] > best):
                    best, at = self.model.scores[piece], i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, a: int, b: int) -> bool:
        """Whether F has an arc from piece a to piece b."""
        key = (a, b)
        known = self.follows.get(key)
        if known is None:
            if len(self.follows) >= REMEMBERED:
                self.follows.clear()
            first, second = self.model.pieces[a], self.model.pieces[b]
            known = self.follows[key] = self.merged(first + second) == [first, second]
        return known

    # -- shortest path ------------------------------------------------------

    def path(self, span: str) -> tuple[int, ...]:
        """The shortest path of one span through the composed transducer."""
        if len(span) == 1:
            piece = self.ids.get(span)
            return self._fallback(span) if piece is None else (piece,)
        return self._bpe_path(span) if self.bpe else self._unigram_path(span)

    def _bpe_path(self, span: str) -> tuple[int, ...]:
        n, arcs, follows = len(span), self.arcs, self.follows
        last = [-1] * (n + 1)  # piece that ends the path to a position; -2: fallback
        back = [-1] * (n + 1)
        back[0] = 0
        for start in range(n):
            if back[start] < 0:
                continue
            before = last[start]
            for end in range(start + 1, n + 1):
                piece = arcs.get(span[start:end])
                if piece is None:  # no piece begins like this
                    if end == start + 1 and span[start] not in self.ids:
                        last[end], back[end] = -2, start
                    break
                if piece < 0 or back[end] >= 0:
                    continue
                if before >= 0:
                    allowed = follows.get((before, piece))
                    if not (self.may_follow(before, piece) if allowed is None else allowed):
                        continue
                last[end], back[end] = piece, start
        out: list[tuple[int, ...]] = []
        at = n
        while at > 0:
            out.append((last[at],) if last[at] >= 0 else self._fallback(span[back[at]:at]))
            at = back[at]
        return tuple(i for arcs in reversed(out) for i in arcs)

    def _unigram_path(self, span: str) -> tuple[int, ...]:
        n, scores = len(span), self.model.scores
        worst = min(scores) - 10.0  # the library's penalty of unknown characters
        cost = [0.0] + [float("inf")] * n
        arcs: list[tuple[int, tuple[int, ...]]] = [(0, ())] * (n + 1)
        for start in range(n):
            single = False
            for end in range(start + 1, min(n, start + self.longest) + 1):
                piece = self.ids.get(span[start:end])
                if piece is None:
                    continue
                single |= end == start + 1
                weight = cost[start] - scores[piece]
                if weight < cost[end]:
                    cost[end], arcs[end] = weight, (start, (piece,))
            if not single and cost[start] - worst < cost[start + 1]:
                cost[start + 1], arcs[start + 1] = cost[start] - worst, (start, self._fallback(span[start]))
        out, at = [], n
        while at > 0:
            out.append(arcs[at][1])
            at = arcs[at][0]
        return tuple(i for arc in reversed(out) for i in arc)

    def encode(self, text: str) -> list[int]:
        text = self.normalise(text)
        if not text:
            return []
        out: list[int] = []
        paths = self.paths
        for span in self.spans(text):
            found = paths.get(span)
            if found is None:
                found = self.path(span)
                if len(span) < 40:
                    if len(paths) >= REMEMBERED:
                        paths.clear()
                    paths[span] = found
            out += found
        return out

    # -- decoding -----------------------------------------------------------

    def decode(self, ids: list[int]) -> str:
        """Text of a piece sequence: the inverse of encoding."""
        parts = self._decoded
        data = b"".join([parts[i] for i in ids])
        text = data.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if self.model.add_prefix and text.startswith(" ") else text

    @property
    def _decoded(self) -> list[bytes]:
        made = self.__dict__.get("_bytes")
        if made is None:
            made = self.__dict__["_bytes"] = [
                bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL
                else " ⁇ ".encode() if k == UNKNOWN else p.encode("utf-8")
                for p, k in zip(self.model.pieces, self.model.kinds)]
        return made


@lru_cache(maxsize=1)
def encoder_of(model: Model) -> Encoder:
    """One encoder a Python worker: tasks that run in it one after another
    share the compiled transducers and the paths found so far."""
    return Encoder(model)


def encode(docs: DataFrame, model: Model, text_col: str = "text",
           columns: tuple[str, ...] = ("doc_id",), ids_col: str = "ids",
           round_trip_col: str | None = None) -> DataFrame:
    """The columns ``columns`` of every row and its piece numbers (array of
    int); with ``round_trip_col``, also whether decoding gives the text back
    (null for null)."""
    # The text is sent to the tasks once, also where it is among the columns.
    inside = list(columns).index(text_col) if text_col in columns else None
    rows = docs.select(*[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(columns)],
                       *([F.col(text_col).cast("string").alias("text")] if inside is None else []))
    n = len(columns)
    # A few megabytes whatever the input: the vocabulary.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder_of(shared.value)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):  # bounded output batches
                batch = whole.slice(start, 256)
                texts = batch.column(n if inside is None else inside).to_pylist()
                ids = [None if t is None else coder.encode(t) for t in texts]
                same = [None if t is None else coder.decode(i) == t for t, i in zip(texts, ids)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:n], pa.array(ids, pa.list_(pa.int32())), pa.array(same, pa.bool_())],
                    [*batch.schema.names[:n], "ids", "same"])

    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:n]],
                        "ids array<int>, same boolean"])
    return rows.mapInArrow(run, schema).select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)], F.col("ids").alias(ids_col),
        *([F.col("same").alias(round_trip_col)] if round_trip_col else []))


def decode(rows: DataFrame, model: Model, ids_col: str = "ids",
           columns: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``columns`` of every row and the text of its piece
    numbers; null stays null."""
    packed = rows.select(F.col(ids_col).alias("ids"),
                         *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(columns)])
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder_of(shared.value)
        for batch in batches:
            texts = [None if i is None else coder.decode(i) for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *batch.columns[1:]],
                                             ["text", *batch.schema.names[1:]])

    schema = ", ".join(["text string", *[f"{f.name} {f.dataType.simpleString()}" for f in packed.schema.fields[1:]]])
    return packed.mapInArrow(run, schema).select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)], F.col("text").alias(text_col))
