"""Language-model scoring with a log-bilinear neural model.

The model (Mnih and Hinton, 2007) predicts the vector of the next token as a
linear function of the vectors of the ``CONTEXT`` tokens before it; the
softmax of its products with the output vectors, plus biases, is the probability
of the next symbol. It is trained by noise-contrastive estimation (Mnih and Teh,
2012) in numpy.

Symbols: half of them are the most frequent training tokens; the other types that
occur twice or more are dealt by hash to the other half (buckets); one more symbol
stands for the types that occur once, and for unseen ones. Their number is
a power of two of at least 4 * sqrt(types), so it grows with the corpus, up to
``MOST_SYMBOLS`` (what 16 bits number, and what bounds the model that tasks are
sent); beyond that, buckets hold more types. Tokens, buckets and the rare symbol are both contexts and
outputs, so the probability of every token, seen or not, depends on its context. The
softmax has two levels: groups of sqrt(symbols) neighbours in that order, then the
symbols of a group; both levels are normalised exactly and trained by their own
noise, and a token costs 2 * sqrt(symbols) products. Inside a bucket a token has
its training frequency. The occurrence of a type that occurs once was that of a new
type, so the model learns where new types come; of the rare symbol's probability
the unseen type (one, as in the base score) has the share once / (once + 2 * twice + 1),
the Good-Turing estimate, and the types that occur once share the rest. So the
probabilities of all types sum to one after any context.

Plan:

1. Map tasks turn texts into numbers of a vocabulary of their own (a chunk:
   about ``chunk_types`` distinct tokens, at most twice as many and those of
   one slice of texts) and write the numbers and, once a
   chunk, each distinct token with its training count.
2. The counts of a token are summed over the chunks and go back to them; no
   key is hot, since a chunk names a token once. Each chunk, streamed past
   its dictionary, yields base scores, tail scores and sequences of model
   numbers, which are written.
3. Training: rows are dealt by hash to parts of about ``part_tokens`` tokens, and
   the parts to rounds, whose number grows with the logarithm of the parts. In a
   round each part trains from the common parameters; parameters and AdaGrad sums
   are then averaged by tokens, block by block. Each training token is used once.
   The parts depend on the rows alone, so the model doesn't depend on the tasks.
4. Scoring: batched matrix products over all tokens of some texts at a time.

Rows: null text counts as empty and has the end token only; texts may be of
any length; repeated rows are scored alike; without training documents every
probability is 1 (score and base 0); an empty table gives an empty result.
"""

from __future__ import annotations

import copy
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import drop_table, id_remainder, stage

FOLDS, HELD_OUT = 10, 0  # crc32(doc_id) mod 10 = 0 is held out
CONTEXT = 2  # tokens
END = b""  # the token that ends a text; no word is empty
NOISE = 64  # noise groups a batch
INNER_NOISE = 4  # noise symbols a token, of its own group
MOST_SYMBOLS = 1 << 15  # and the rare one
BLOCK = 1 << 14  # parameters averaged together
LN10 = float(np.log(10.0))

CHUNK_SCHEMA = ("chunk long, kind int, doc_id long, held_out boolean, ids binary, "
                "token binary, n long, local int")
TEXT_SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
               "tail_score double, ids binary")


# -- counting -----------------------------------------------------------------


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of all texts, one after another, and how many each has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, edges = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
    full = pc.greater(pc.binary_length(words), 0)  # white space at an edge leaves an empty string
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return words.filter(full), np.diff(before[edges])


def _tokenise(chunk_types: int, chunk_tokens: int):
    """(text, doc_id, held_out) -> rows of CHUNK_SCHEMA: kind 1 texts, kind 0 tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in CHUNK_SCHEMA.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.int64(), pa.int32()]
        chunk = TaskContext.get().partitionId() << 24

        def made(columns) -> pa.RecordBatch:
            n = len(columns[0])
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, k) if c is None else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        def flush() -> Iterator[pa.RecordBatch]:
            types = pa.concat_arrays([known.cast(pa.binary()), pa.array([END], pa.binary())])
            sizes = np.concatenate(lengths)
            numbers = np.insert(np.concatenate(coded), np.cumsum(sizes), len(types) - 1)
            held = pa.concat_arrays([r.column(1) for r in rows])
            learnt = np.repeat(~held.to_numpy(zero_copy_only=False).astype(bool), sizes + 1)
            counts = np.bincount(numbers[learnt], minlength=len(types))
            ends = np.concatenate([[0], 4 * np.cumsum(sizes + 1)]).astype(np.int32)
            n = len(sizes)
            texts = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(numbers)])
            yield made([np.full(n, chunk), np.full(n, 1), pa.concat_arrays([r.column(0) for r in rows]), held, texts,
                        None, None, None])
            for i in range(0, len(types), 50_000):
                part = types[i:i + 50_000]
                n = len(part)
                yield made([np.full(n, chunk), np.full(n, 0), None, None, None, part, counts[i:i + n],
                            np.arange(i, i + n)])

        none = pa.array([], pa.string())
        # of the chunk: types, numbers of words, slices whose words have numbers of their own, rows, words a text
        known, coded, slices, rows, lengths = none, [], [], [], []
        size, most = 0, 0  # words, and at most so many types
        for batch in batches:
            for part in _slices(batch, min(chunk_types, chunk_tokens)):
                words, count = _words(part.column(0))
                slices.append(words.dictionary_encode())
                rows.append(part.select([1, 2]))  # not the texts
                lengths.append(count)
                size += len(words) + len(count)
                most += len(slices[-1].dictionary)
                if most >= 2 * chunk_types or size >= chunk_tokens:  # slices share types
                    known, slices = _merged(known, slices, coded), []
                    most = len(known)
                    if most >= chunk_types or size >= chunk_tokens:
                        yield from flush()
                        known, coded, rows, lengths, size, most = none, [], [], [], 0, 0
                        chunk += 1
        if rows:
            known = _merged(known, slices, coded)
            yield from flush()

    return run


def _merged(known: pa.Array, slices: list[pa.DictionaryArray], coded: list[np.ndarray]) -> pa.Array:
    """The known types and, after them, the new ones of the slices, whose numbers
    among all these are put into ``coded``."""
    every = pa.concat_arrays([known, *(s.dictionary for s in slices)]).dictionary_encode()
    numbers, at = every.indices.to_numpy(), len(known)
    for s in slices:
        coded.append(numbers[at:at + len(s.dictionary)].take(s.indices.to_numpy()))
        at += len(s.dictionary)
    return every.dictionary


def _slices(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of texts that have no more than about ``limit`` words together: of
    6 bytes each, or a text alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False)
    sizes = np.cumsum(sizes, dtype=np.int64)
    at, done = 0, 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, done + 6 * limit, side="right")))
        yield batch.slice(at, end - at)
        at, done = end, sizes[end - 1]


@dataclass(frozen=True)
class Counts:
    """What the training tokens as a whole say (a few numbers)."""

    tokens: int  # N
    types: int  # V
    rare_types: int  # that occur once and are not listed
    unseen: float  # share of the unseen type among the rare ones
    slot: np.ndarray  # of a bucket's number: its place among those that hold a type
    bucket_tokens: np.ndarray  # by place

    def base(self, c: np.ndarray) -> np.ndarray:
        """log10 of the base probability of tokens with these counts."""
        return np.log10((c + 0.1) / (self.tokens + 0.1 * (self.types + 1)))

    def tail(self, c: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """log10 of the probability, inside their symbols, of unlisted tokens
        with these counts."""
        new = self.unseen if self.rare_types else 1.0
        rare = np.log10(np.where(c == 0, new, (1.0 - self.unseen) / max(self.rare_types, 1)))
        if not len(self.bucket_tokens):
            return rare
        return np.where(c > 1, np.log10(np.maximum(c, 1) / self.bucket_tokens[self.slot[bucket]]), rare)


def _recode(counts: Counts, listed: int):
    """Rows sorted by 4 * chunk + kind (0 counts and hashes, 1 numbers of listed tokens,
    2 texts) -> rows of TEXT_SCHEMA. Local numbers come in any order."""
    buckets = len(counts.slot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, numbers, tables = None, [], [], None

        def compile_tables():
            c = np.zeros(sum(len(p[0]) for p in parts), np.int64)
            bucket = np.zeros(len(c), np.int32)
            for local, value, code in parts:
                c[local], bucket[local] = value, code % buckets
            model = np.where(c > 1, counts.slot[bucket] + listed + 1, listed).astype(np.uint16)
            tail = counts.tail(c, bucket)
            for local, number in numbers:
                model[local] = number
                tail[local] = 0.0
            return c > 0, counts.base(c), tail, model

        for batch in batches:
            places = batch.column(0).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.diff(places)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(places)]):
                if a == b:
                    continue
                chunk, kind = divmod(int(places[a]), 4)
                if chunk != current:
                    current, parts, numbers, tables = chunk, [], [], None
                part = batch.slice(a, b - a)
                if kind == 0:
                    parts.append((part.column(1).to_numpy(zero_copy_only=False),
                                  part.column(2).to_numpy(zero_copy_only=False),
                                  part.column(6).to_numpy(zero_copy_only=False).astype(np.int32)))
                elif kind == 1:
                    numbers.append((part.column(1).to_numpy(zero_copy_only=False),
                                    part.column(2).to_numpy(zero_copy_only=False)))
                else:
                    tables = tables or compile_tables()
                    known, base, tail, model = tables
                    out = []
                    for data in part.column(5):
                        ids = np.frombuffer(data.as_py(), np.int32)
                        out.append((len(ids), int(known[ids].sum()), float(base[ids].sum()),
                                    float(tail[ids].sum()), model[ids].tobytes()))
                    columns = list(zip(*out, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(3), part.column(4), pa.array(columns[0], pa.int64()),
                         pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64()),
                         pa.array(columns[3], pa.float64()), pa.array(columns[4], pa.binary())],
                        ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "tail_score", "ids"])

    return run


# -- the model ----------------------------------------------------------------


class LogBilinear:
    """Parameters over ``outputs`` symbols; contexts also hold a start mark."""

    TABLES = ("words", "mixers", "targets", "bias", "group_targets", "group_bias")

    def __init__(self, outputs: int, dim: int, log_unigram: np.ndarray, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.outputs, self.dim = outputs, dim
        self.span = int(np.ceil(np.sqrt(outputs)))  # symbols a group
        starts = np.arange(0, outputs, self.span)
        p = np.exp(log_unigram - log_unigram.max())
        p /= p.sum()
        self.mass = np.add.reduceat(p, starts)
        self.log_group = np.log(self.mass).astype(np.float32)
        self.stay, self.other = _aliases(p, self.span)
        self.log_inside = (np.log(p) - np.repeat(np.log(self.mass), self.span)[:outputs]).astype(np.float32)
        self.words = rng.normal(0, 0.1, (outputs + 1, dim)).astype(np.float32)
        self.mixers = np.stack([np.eye(dim) for _ in range(CONTEXT)]).astype(np.float32)
        self.targets = np.zeros((outputs, dim), np.float32)
        self.bias = self.log_inside.copy()
        self.group_targets = np.zeros((len(starts), dim), np.float32)
        self.group_bias = self.log_group.copy()
        # sums of squared gradients
        self.squares = {name: np.full(getattr(self, name).shape, 1e-6, np.float32) for name in self.TABLES}

    def pack(self) -> np.ndarray:
        return np.concatenate([x.ravel() for name in self.TABLES for x in (getattr(self, name), self.squares[name])])

    def unpack(self, flat: np.ndarray) -> LogBilinear:
        at = 0
        for name in self.TABLES:
            shape = getattr(self, name).shape
            size = int(np.prod(shape))
            setattr(self, name, flat[at:at + size].reshape(shape).astype(np.float32))
            self.squares[name] = flat[at + size:at + 2 * size].reshape(shape).astype(np.float32)
            at += 2 * size
        return self

    def contexts(self, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(n, CONTEXT) contexts and the n tokens that follow them."""
        start = np.full(CONTEXT, self.outputs, np.int32)
        padded = np.concatenate([x for s in sequences for x in (start, s.astype(np.int32))])
        token = np.ones(len(padded), bool)
        ends = np.cumsum([len(s) + CONTEXT for s in sequences])
        for j in range(CONTEXT):
            token[np.concatenate([[0], ends[:-1]]) + j] = False
        at = np.flatnonzero(token)
        return np.stack([padded[at - j - 1] for j in range(CONTEXT)], axis=1), padded[at]

    def _noise_inside(self, groups: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """INNER_NOISE symbols of each given group, by their frequencies."""
        first = (groups * self.span)[:, None]
        at = rng.random((len(groups), INNER_NOISE)) * np.minimum(self.span, self.outputs - first)
        drawn = at.astype(np.intp)
        at -= drawn
        drawn += first
        return np.where(at < self.stay.take(drawn), drawn, self.other.take(drawn))

    def train(self, sequences: list[np.ndarray], rate: float, rng: np.random.Generator, batch: int = 8192,
              piece: int = 1024) -> None:
        """One pass of noise-contrastive estimation (AdaGrad steps). A batch's errors
        are found ``piece`` tokens at a time, in the processor's cache."""
        contexts, tokens = self.contexts(sequences)
        order = rng.permutation(len(tokens))
        cumulative = np.cumsum(self.mass)
        group_shift = self.log_group + np.float32(np.log(NOISE))
        shift = self.log_inside + np.float32(np.log(INNER_NOISE))
        for i in range(0, len(order), batch):
            rows = order[i:i + batch]
            n, scale = len(rows), np.float32(1.0 / len(rows))
            h, w = contexts.take(rows, axis=0).T.astype(np.intp, order="C"), tokens.take(rows).astype(np.intp)
            g = w // self.span
            groups = np.minimum(np.searchsorted(cumulative, rng.random(NOISE)), len(self.mass) - 1)
            drawn = np.concatenate([w[:, None], self._noise_inside(g, rng)], axis=1)
            vectors = np.empty((CONTEXT, n, self.dim), np.float32)
            q, d_q = np.empty((n, self.dim), np.float32), np.empty((n, self.dim), np.float32)
            d_true, d = np.empty(n, np.float32), np.empty(drawn.shape, np.float32)
            noise = -self.group_targets[groups]
            group_bias, bias = self.group_bias - group_shift, self.bias - shift
            noise_sums, noise_bias_sums = np.zeros((NOISE, self.dim), np.float32), np.zeros(NOISE, np.float32)
            for a in range(0, n, piece):
                at = slice(a, a + piece)
                for j in range(CONTEXT):
                    np.take(self.words, h[j, at], axis=0, out=vectors[j, at], mode="clip")
                p = sum(v[at] @ m for v, m in zip(vectors, self.mixers))
                # the group against groups drawn for the batch
                true = self.group_targets.take(g[at], axis=0)
                d_true[at] = _missed(np.einsum("nd,nd->n", p, true) + group_bias.take(g[at]))
                wrong = p @ noise.T
                wrong -= group_bias[groups]
                _missed(wrong, wrong)
                noise_sums -= wrong.T @ p
                noise_bias_sums -= wrong.sum(axis=0)
                back = wrong @ noise
                back += d_true[at, None] * true
                # the symbol against symbols drawn from its group
                outputs = self.targets.take(drawn[at], axis=0)
                gap = np.einsum("nkd,nd->nk", outputs, p) + bias.take(drawn[at])
                d[at, 0], d[at, 1:] = _missed(gap[:, 0]), -_missed(-gap[:, 1:])
                back += np.einsum("nk,nkd->nd", d[at], outputs)
                q[at], d_q[at] = p, back
            scaled = _columns(q * scale)
            sums = _sums(g, scaled * d_true, len(self.mass))
            np.add.at(sums, groups, noise_sums * scale)
            self._step("group_targets", sums, rate)
            sums = np.bincount(g, d_true, len(self.mass))
            np.add.at(sums, groups, noise_bias_sums)
            self._step("group_bias", sums * scale, rate)
            drawn, d = drawn.T.ravel(), _columns(d)
            self._step("targets", _sums(drawn, ((d * x).ravel() for x in scaled), self.outputs), rate)
            self._step("bias", np.bincount(drawn, d.ravel(), self.outputs) * scale, rate)
            back = [_columns(d_q @ m.T * scale) for m in self.mixers]
            for j in range(CONTEXT):
                gradient = vectors[j].T @ d_q * scale
                self.squares["mixers"][j] += gradient ** 2
                self.mixers[j] += rate * gradient / np.sqrt(self.squares["mixers"][j])
                self._step("words", _sums(h[j], back[j], self.outputs + 1), rate)

    def _step(self, name: str, sums: np.ndarray, rate: float) -> None:
        """An AdaGrad step by the batch's gradients; where they are zero, nothing moves."""
        table, squares = getattr(self, name), self.squares[name]
        sums = np.asarray(sums, np.float32, order="C")
        change = sums * sums
        squares += change
        np.sqrt(squares, out=change)
        np.divide(sums, change, out=change)
        change *= np.float32(rate)
        table += change

    def log_probabilities(self, sequences: list[np.ndarray], block: int = 1 << 18, piece: int = 1 << 12) -> np.ndarray:
        """Sum of normalised natural log probabilities of each sequence. A block's
        tokens are ordered by symbol, and ``piece`` tokens of one group at a time
        are scored, so that the products stay in the processor's cache."""
        contexts, tokens = self.contexts(sequences)
        mixed = [self.words @ m for m in self.mixers]
        outer = np.ascontiguousarray(self.group_targets.T)
        inner = [np.ascontiguousarray(self.targets[lo:lo + self.span].T) for lo in range(0, self.outputs, self.span)]
        logs = np.empty(len(tokens), np.float64)
        for i in range(0, len(tokens), block):
            order = np.argsort(tokens[i:i + block].astype(np.uint16), kind="stable")
            w, h = tokens[i:i + block].take(order), contexts[i:i + block].take(order, axis=0)
            g = w // self.span
            edges = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1], [True]])).tolist()
            ranked = np.empty(len(w), np.float64)
            for first, last in zip(edges[:-1], edges[1:]):
                group = int(g[first])
                lo = group * self.span
                for a in range(first, last, piece):
                    b = min(last, a + piece)
                    q = sum(m.take(h[a:b, j], axis=0) for j, m in enumerate(mixed))
                    scores = q @ outer
                    scores += self.group_bias
                    ranked[a:b] = _log_softmax_at(scores, group)
                    scores = q @ inner[group]
                    scores += self.bias[lo:lo + self.span]
                    ranked[a:b] += _log_softmax_at(scores, w[a:b] - lo)
            logs[i + order] = ranked
        lengths = np.array([len(s) for s in sequences])
        return np.add.reduceat(logs, np.concatenate([[0], np.cumsum(lengths)[:-1]]))


def _columns(table: np.ndarray) -> np.ndarray:
    """The columns one after another, as bincount adds them."""
    return table.T.astype(np.float64, order="C")


def _sums(rows: np.ndarray, columns: Iterable[np.ndarray], n: int) -> np.ndarray:
    """For each of n rows the sum of its values in each column."""
    return np.array([np.bincount(rows, column, n) for column in columns], np.float32).T


def _aliases(p: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Walker's alias tables of each ``span`` neighbours: with a symbol drawn evenly
    from a group, the chance to stay with it, and else the symbol to go to, so
    that a group's symbols come in proportion to ``p``."""
    stay, other = np.ones(len(p)), np.arange(len(p))
    for first in range(0, len(p), span):
        share = p[first:first + span] / p[first:first + span].mean()
        small, large = np.flatnonzero(share < 1).tolist(), np.flatnonzero(share >= 1).tolist()
        while small and large:
            low, high = small.pop(), large[-1]
            stay[first + low], other[first + low] = share[low], first + high
            share[high] -= 1 - share[low]
            if share[high] < 1:
                small.append(large.pop())
    return stay, other


def _missed(gap: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """1 - sigmoid(gap)."""
    out = np.minimum(gap, np.float32(80.0), out=out)
    np.exp(out, out=out)
    out += 1
    return np.reciprocal(out, out=out)


def _log_softmax_at(scores: np.ndarray, at: np.ndarray | int) -> np.ndarray:
    """log softmax of each row at its column (or one for all); ``scores`` is used up."""
    if scores.max() > 60 or scores.min() < -60:  # else no sum of exponentials leaves the floats
        scores -= scores.max(axis=1, keepdims=True)
    own = scores[np.arange(len(scores)), at]
    return own - np.log(np.exp(scores, out=scores) @ np.ones(scores.shape[1], np.float32))


def _groups(batches: Iterator[pa.RecordBatch], column: int, tokens: int):
    """Slices of the batches with about ``tokens`` tokens, with their sequences."""
    for batch in batches:
        sequences, first, size = [], 0, 0
        for i, data in enumerate(batch.column(column)):
            sequences.append(np.frombuffer(data.as_py(), np.uint16))
            size += len(sequences[-1])
            if size >= tokens:
                yield batch.slice(first, i + 1 - first), sequences
                sequences, first, size = [], i + 1, 0
        if sequences:
            yield batch.slice(first), sequences


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, part, tokens, values) sorted by block -> one weighted sum a block."""
    current, total, weight = None, None, 0

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([current], pa.int32()), pa.array([weight], pa.int64()),
                                           pa.array([total.tobytes()], pa.binary())], ["block", "tokens", "values"])

    for batch in batches:
        for block, tokens, data in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
            values = np.frombuffer(data.as_py(), np.float32) * float(tokens)
            if block != current:
                if current is not None:
                    yield made()
                current, total, weight = block, np.zeros(len(values)), 0
            total += values
            weight += tokens
    if current is not None:
        yield made()


def train_model(texts: DataFrame, model: LogBilinear, tokens: int, rate: float, part_tokens: int) -> LogBilinear:
    """Train on (ids binary, doc_id) rows that hold ``tokens`` tokens, each used
    in one of the parts of one of the rounds."""
    spark = texts.sparkSession
    wanted = max(1, -(-tokens // part_tokens))
    rounds = min(wanted, 1 + int(np.ceil(np.log2(wanted) / 2)))
    slots = -(-wanted // rounds)  # parts a round
    row = F.xxhash64("doc_id", "ids")
    rows = texts.select(row.alias("row"), "ids", F.pmod(row, F.lit(rounds * slots)).alias("part"))
    for number in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, number=number) -> Iterator[pa.RecordBatch]:
            part, own, rng, used = None, None, None, 0

            def made() -> pa.RecordBatch:
                flat = own.pack()
                blocks = [flat[i:i + BLOCK].tobytes() for i in range(0, len(flat), BLOCK)]
                n = len(blocks)
                return pa.RecordBatch.from_arrays(
                    [pa.array(range(n), pa.int32()), pa.array([part] * n, pa.int64()),
                     pa.array([used] * n, pa.int64()), pa.array(blocks, pa.binary())],
                    ["block", "part", "tokens", "values"])

            for batch in batches:
                parts = batch.column(1).to_numpy()
                edges = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1], [True]])) if len(parts) else []
                for a, b in zip(edges[:-1], edges[1:]):
                    if parts[a] != part:
                        if used:
                            yield made()
                        part, used = int(parts[a]), 0
                        own, rng = copy.deepcopy(shared.value), np.random.default_rng([number, part])
                    for _, sequences in _groups([batch.slice(a, b - a)], 0, 500_000):
                        used += sum(map(len, sequences))
                        own.train(sequences, rate, rng)
            if used:
                yield made()

        mine = (rows.filter(F.pmod("part", F.lit(rounds)) == number)
                .repartitionById(slots, F.floor(F.col("part") / rounds).cast("int"))
                .sortWithinPartitions("part", "row", "ids").select("ids", "part"))
        summed = (mine.mapInArrow(run, "block int, part long, tokens long, values binary")
                  .repartition("block").sortWithinPartitions("block", "part")
                  .mapInArrow(_summed, "block int, tokens long, values binary"))
        blocks = summed.orderBy("block").toArrow().to_pylist()  # the model's parameters, in doubles
        shared.unpersist()
        if blocks:
            model = model.unpack(np.concatenate([np.frombuffer(b["values"], np.float64) / b["tokens"]
                                                 for b in blocks]))
    return model


def symbols_for(types: int) -> int:
    """How many symbols, beside the rare one, a corpus of so many types may get."""
    return min(MOST_SYMBOLS, 1 << max(1, int(np.ceil(np.log2(4.0 * np.sqrt(max(types, 1)))))))


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", symbols: int | None = None,
                dim: int = 16, rate: float = 0.05, part_tokens: int = 1_000_000, chunk_types: int = 250_000,
                chunk_tokens: int = 3_000_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score
    of every row; log10 probabilities of whole texts. ``symbols`` (default: by
    the number of types) is a power of two of at most MOST_SYMBOLS."""
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    rows = rows.select("text", "doc_id", (id_remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"))
    chunks, chunks_at = stage(rows.mapInArrow(_tokenise(chunk_types, chunk_tokens), CHUNK_SCHEMA))
    tokens = chunks.filter("kind = 0").select("chunk", "local", "token", "n")
    same = Window.partitionBy("token").orderBy("chunk")  # one order for both, so one sort
    whole = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted, counted_at = stage(
        tokens.withColumn("c", F.sum("n").over(whole))
        .withColumn("lead", F.row_number().over(same) == 1)
        .select("chunk", "local", "c", F.when(F.col("lead"), F.col("token")).alias("token"),
                F.pmod(F.xxhash64("token"), F.lit(MOST_SYMBOLS)).cast("short").alias("hash")))
    types = counted.filter("token IS NOT NULL AND c > 0")
    n, v, once, twice = types.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"),
                                  F.count(F.when(F.col("c") == 1, 1)),
                                  F.count(F.when(F.col("c") == 2, 1))).first()
    symbols = symbols_for(v) if symbols is None else symbols
    buckets = symbols // 2
    # At most half of the symbols; the end of a text is always among them.
    top = (types.orderBy((F.length("token") > 0), F.desc("c"), "token").limit(symbols // 2)
           .select("token", "c", "hash").collect())
    held = np.zeros((2, buckets), np.int64)  # tokens and types of each bucket
    for r in types.filter("c > 1").groupBy((F.col("hash") % buckets).alias("b")).agg(
            F.sum("c").alias("c"), F.count("*").alias("n")).collect():
        held[:, r.b] = r.c, r.n
    for r in top:
        if r.c > 1:
            held[:, r.hash % buckets] -= (r.c, 1)
    rare = once - sum(r.c == 1 for r in top)
    filled = held[1] > 0
    counts = Counts(n, v, rare, once / (once + 2 * twice + 1), np.cumsum(filled) - 1, held[0][filled])
    outputs = len(top) + 1 + len(counts.bucket_tokens)
    listed = docs.sparkSession.createDataFrame([(bytes(r.token), i) for i, r in enumerate(top)],
                                               "token binary, number int")
    numbers = tokens.select("chunk", "local", "token").join(F.broadcast(listed), "token")
    nothing = F.lit(None)
    short = nothing.cast("short")

    def place(kind: int) -> Column:  # one number, which Spark sorts by radix
        return (F.col("chunk") * 4 + kind).alias("place")

    met = (counted.select(place(0), "local", F.col("c").alias("value"),
                          nothing.cast("long").alias("doc_id"), nothing.cast("boolean").alias("held_out"),
                          nothing.cast("binary").alias("ids"), "hash")
           .unionByName(numbers.select(place(1), "local", F.col("number").cast("long").alias("value"),
                                       nothing.cast("long").alias("doc_id"),
                                       nothing.cast("boolean").alias("held_out"),
                                       nothing.cast("binary").alias("ids"), short.alias("hash")))
           .unionByName(chunks.filter("kind = 1").select(
               place(2), nothing.cast("int").alias("local"), nothing.cast("long").alias("value"),
               "doc_id", "held_out", "ids", short.alias("hash"))))
    texts, _ = stage(met.repartition(F.shiftright("place", 2)).sortWithinPartitions("place")
                     .mapInArrow(_recode(counts, len(top)), TEXT_SCHEMA))
    drop_table(docs.sparkSession, chunks_at)
    drop_table(docs.sparkSession, counted_at)

    unigram = np.concatenate([[r.c for r in top], [rare], counts.bucket_tokens]) + 1.0
    model = LogBilinear(outputs, dim, np.log(unigram / unigram.sum()))
    if n:
        model = train_model(texts.filter("NOT held_out").select("ids", "doc_id"), model, n, rate, part_tokens)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch, sequences in _groups(batches, 6, 500_000):
            scores = own.log_probabilities(sequences) / LN10
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(scores)],
                                             [*batch.schema.names[:6], "model_score"])

    scored = texts.mapInArrow(run, TEXT_SCHEMA.replace("ids binary", "model_score double"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                         "base_score", (F.col("model_score") + F.col("tail_score")).alias("score"))
