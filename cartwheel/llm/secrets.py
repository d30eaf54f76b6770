"""Secret scans: fixed patterns, and password guess costs in credential context.

Base spans come from three patterns (assign, access, hex). The method adds
``guess`` spans: a value that stands in credential context (after a
credential word and a separator, after ``Bearer``/``Basic``, or between the
user and host of a URL) is kept if its guess cost is high. The cost is the
minimum over all segmentations of the value into dictionary words (also with
capitals and the usual character substitutions), dates, repeats and
sequences, keyboard walks, and brute-force spans; each segment costs the
log10 of the number of guesses that reach it, and runs are taken to their end.
Dynamic programming over the positions finds it in linear time: brute force
costs a fixed amount a character, repeats and walks are found as runs, and words
and dates have a bounded length. The dictionary is a short list of parts of
passwords and the most common words of the corpus itself. After "is", a bare
run of letters is prose and no value.

Rows: null counts as empty; a text without spans has zero counts and empty
span lists; texts may be of any length; repeated rows are scanned alike; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.sizing import drop_table
from cartwheel.llm.common import stage

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "guess")

# Contexts of the method, after whole words: the value is the last group that
# matched. A value in quotes is what the quotes hold.
_KEYWORD = (r"(?<![A-Za-z0-9])(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|api[_-]?key|access[_-]?key"
            r"|private[_-]?key|client[_-]?secret|credentials?|auth(?:orization)?)[\"']?")
CONTEXT_PATTERN = (
    _KEYWORD + r"\x20*(?:[:=]|=>|\x20(is)\x20)\x20*(?:[\"]([^\s\"<>]{6,})[\"]|[']([^\s'<>]{6,})[']"
    r"|[\"']?([^\s\"'<>,;]{6,}))"
    r"|(?<![A-Za-z0-9])(?:bearer|basic)\x20+([A-Za-z0-9+/_.=~-]{8,})"
    r"|://[^\s/:@\"']+:([^\s/@\"']{6,})@")
CONTEXT = re.compile(CONTEXT_PATTERN, re.IGNORECASE | re.ASCII)
BARE = 4  # the group of a value without quotes
# A text without any of these holds no match of ASSIGN, or of CONTEXT.
ASSIGN_PARTS = ("password", "passwd", "secret", "token", "api")
CONTEXT_PARTS = ("pass", "pwd", "pin", "secret", "token", "key", "credential", "auth", "bearer", "basic", "://")

# Common parts of passwords, most common first (fixed values).
WORDS = (
    "password pass admin root user login welcome letmein monkey dragon master hello "
    "qwerty abc iloveyou sunshine princess football baseball shadow superman batman "
    "secret test guest default changeme example sample demo temp love god money "
    "summer winter spring autumn freedom flower star angel computer internet server "
    "database oracle mysql postgres redis google apple windows linux ubuntu android "
    "token key api access private public client auth service production staging "
    "january february march april may june july august september october november december "
    "monday tuesday wednesday thursday friday saturday sunday "
    "michael jennifer thomas jessica daniel robert charlie andrew michelle jordan "
    "the and you for with null none true false undefined your here insert replace").split()

# Rows of a keyboard (fixed values).
KEYBOARD = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
# Characters that stand for letters (fixed values).
SUBSTITUTES = {"@": "a", "4": "a", "3": "e", "1": "i", "!": "i", "0": "o", "$": "s", "5": "s", "7": "t"}
FULL_DATE = re.compile(r"(?:19|20)\d\d([-/.]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
                       r"|(?:0[1-9]|[12]\d|3[01])([-/.]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d")
YEAR = re.compile(r"(?:19|20)\d\d")
MIN_COST = 10.0  # log10 of guesses from which a value is reported
BOUNDARY = 0.3  # of two segments
DICTIONARY_WORDS = 50_000  # learned from the corpus: a bounded table
PUNCTUATION = ".,;:!?()[]{}\"'"  # around words


class GuessCost:
    """Minimum log10 number of guesses of a value."""

    def __init__(self, words: Sequence[str] = WORDS, learned: Sequence[str] = ()) -> None:
        """``words`` and ``learned`` are ranked lists, most common first."""
        self.rank: dict[str, float] = {}
        for ranked in (words, learned):
            for i, w in enumerate(ranked):
                self.rank[w] = min(self.rank.get(w, math.inf), math.log10(i + 2))
        self.longest = max(map(len, self.rank), default=0)
        self.beginnings = {w[:i] for w in self.rank for i in range(1, len(w) + 1)}
        self.place = {key: (r, i) for r, row in enumerate(KEYBOARD) for i, key in enumerate(row)}
        self.near: dict[str, set[str]] = {}
        for r, row in enumerate(KEYBOARD):
            for i, key in enumerate(row):
                for other in (row[i - 1:i], row[i + 1:i + 2],
                              *(near[j:j + 1] for near in KEYBOARD[max(0, r - 1):r] + KEYBOARD[r + 1:r + 2]
                                for j in (i - 1, i, i + 1) if j >= 0)):
                    if other:
                        self.near.setdefault(key, set()).add(other)

    def __call__(self, value: str) -> float:
        return self.segments(value)[0]

    def segments(self, value: str) -> tuple[float, list[tuple[int, int, str]]]:
        """The cost, and the cheapest segmentation as (start, end, kind)."""
        n = len(value)
        # Two ways to reach each position: the last segment is brute force (a
        # further character just extends it) or another one.
        cost = {"brute": [math.inf] * (n + 1), "other": [0.0] + [math.inf] * n}
        how: dict[str, list] = {"brute": [None] * (n + 1), "other": [None] * (n + 1)}
        lower = value.lower()
        plain = "".join(SUBSTITUTES.get(c, c) for c in lower) if len(lower) == n else lower
        if len(lower) != n:  # some letter has several small ones: nothing is known of it
            lower = plain = value

        def offer(start: int, end: int, guesses: float, kind: str) -> None:
            last = min(("brute", "other"), key=lambda k: cost[k][start])
            # Where segments meet is a guess as well.
            total = cost[last][start] + guesses + (BOUNDARY if start else 0.0)
            if total < cost["other"][end]:
                cost["other"][end], how["other"][end] = total, (start, kind, last)

        per_char = [self._alphabet(c) for c in value]
        repeat_to = self._runs(lower, lambda a, b: a == b)
        step_to = self._runs(lower, lambda a, b: b.isalnum() and abs(ord(a) - ord(b)) == 1)
        walk_to = self._runs(lower, lambda a, b: b in self.near.get(a, ()))
        turns = self._turns(lower)
        for i in range(n):
            # Brute force, one character at a time: a span's cost is their sum.
            for last, more in (("brute", 0.0), ("other", BOUNDARY if i else 0.0)):
                total = cost[last][i] + more + per_char[i]
                if total < cost["brute"][i + 1]:
                    cost["brute"][i + 1], how["brute"][i + 1] = total, (i, "brute", last)
            # A run is taken to its end.
            for runs, kind, start_cost in ((repeat_to, "repeat", 0.0), (step_to, "sequence", 0.5),
                                           (walk_to, "walk", 1.0)):
                end = runs[i]
                if end - i >= 3:
                    bends = 0.3 * (turns[i] - turns[end - 2]) if kind == "walk" else 0.0
                    offer(i, end, per_char[i] + math.log10(end - i) + start_cost + bends, kind)
            for end in range(i + 1, min(n, i + self.longest) + 1):
                if plain[i:end] not in self.beginnings:
                    break
                rank = self.rank.get(plain[i:end])
                if rank is not None and end - i >= 3:
                    offer(i, end, rank + self._disguise(value, lower, plain, i, end), "word")
            if value[i].isdigit():
                if found := FULL_DATE.match(value, i, min(n, i + 10)):
                    offer(i, found.end(), math.log10(365 * 100 * 4), "date")
                if found := YEAR.match(value, i, min(n, i + 4)):
                    offer(i, found.end(), 2.0, "date")
        last = min(("brute", "other"), key=lambda k: cost[k][n])
        total, out, at = cost[last][n], [], n
        while at > 0:
            start, kind, before = how[last][at]
            if out and kind == "brute" == out[-1][2]:
                out[-1] = (start, out[-1][1], kind)
            else:
                out.append((start, at, kind))
            at, last = start, before
        return total, out[::-1]

    @staticmethod
    def _alphabet(c: str) -> float:
        if c.isdigit():
            return 1.0
        return math.log10(26) if c.isalpha() else math.log10(33)

    @staticmethod
    def _runs(text: str, joined) -> list[int]:
        """For each position, where the run that starts there ends."""
        n = len(text)
        out = [n] * n
        for i in range(n - 2, -1, -1):
            out[i] = out[i + 1] if joined(text[i], text[i + 1]) else i + 1
        return out

    def _turns(self, text: str) -> list[int]:
        """For each position, how often steps on the keyboard change direction
        from there to the end of the text."""
        places = [self.place.get(c) for c in text]
        steps = [(c[0] - a[0], c[1] - a[1]) if a and c else None for a, c in zip(places, places[1:])]
        out = [0] * (len(text) + 1)
        for i in range(len(steps) - 2, -1, -1):
            out[i] = out[i + 1] + (steps[i] != steps[i + 1])
        return out

    @staticmethod
    def _disguise(value: str, lower: str, plain: str, start: int, end: int) -> float:
        """Extra guesses for capitals and substitutions."""
        capitals = sum(value[k] != lower[k] for k in range(start, end))
        swaps = sum(lower[k] != plain[k] for k in range(start, end))
        cost = 0.0
        if capitals:
            cost += 0.3 if capitals == end - start or (capitals == 1 and value[start] != lower[start]) else (
                math.log10(math.comb(end - start, capitals)) + 0.3)
        return cost + 0.3 * swaps


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, leftmost and non-overlapping
    per kind; matches that are too short are dropped after they matched."""
    lower = text.lower()
    out = ([(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
           if any(p in lower for p in ASSIGN_PARTS) else [])
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    return out


def guess_spans(text: str, cost: GuessCost, min_cost: float = MIN_COST) -> list[tuple[int, int, str]]:
    """(start, end, "guess") of values in credential context that are
    expensive to guess."""
    out = []
    lower = text.lower()
    if not any(p in lower for p in CONTEXT_PARTS):
        return out
    for m in CONTEXT.finditer(text):
        group = m.lastindex
        value = m[group]
        if group == BARE:
            # One mark that ends a sentence or closes a bracket is not the value's.
            value = value[:-1] if value[-1] in ".:)]}" else value
            if m[1] and value.isalpha():
                continue  # prose: "the token is understood"
        if len(value) >= 6 and cost(value) >= min_cost:
            out.append((m.start(group), m.start(group) + len(value), "guess"))
    return out


def common_words(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY_WORDS) -> list[str]:
    """The ``size`` most common words of the corpus (written in small letters,
    perhaps with a capital, and met more than once), most common first. What
    stands in credential context is left out, so that secrets in copied documents
    are no words. Counted over all documents, merged in each task first; only the
    bounded list comes to the driver. Where words tie at the end, all of them are
    left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: Counter[str] = Counter()

        def words() -> pa.RecordBatch:
            counted: Counter[str] = Counter()
            for piece, n in met.items():
                word = piece.strip(PUNCTUATION)
                if 3 <= len(word) <= 24 and word.isalpha() and word[1:].islower():
                    counted[word.lower()] += n
            return pa.RecordBatch.from_arrays(
                [pa.array(counted.keys(), pa.string()), pa.array(counted.values(), pa.int64())], ["w", "n"])

        for batch in batches:
            for text in batch.column(0):
                text = text.as_py() or ""
                lower = text.lower()
                met.update((CONTEXT.sub(" ", text) if any(p in lower for p in CONTEXT_PARTS) else text).split())
                if len(met) > 200_000:  # bounded: the rest follows
                    yield words()
                    met.clear()
        yield words()

    counted, path = stage(docs.select(F.col(text_col).cast("string")).mapInArrow(run, "w string, n long")
                          .groupBy("w").agg(F.sum("n").alias("n")).filter("n > 1"))
    # The least count that leaves at most ``size`` words, from a table of counts.
    upto = F.sum("words").over(Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0))
    least = (counted.groupBy("n").agg(F.count(F.lit(1)).alias("words")).withColumn("upto", upto)
             .filter(F.col("upto") <= size).agg(F.min("n")).first()[0])
    found = [] if least is None else counted.filter(F.col("n") >= least).collect()
    drop_table(docs.sparkSession, path)
    return [r.w for r in sorted(found, key=lambda r: (-r.n, r.w))]


def written(spans: list[tuple[int, int, str]]) -> str:
    ordered = sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: Sequence[str] = WORDS, min_cost: float = MIN_COST,
                 dictionary_words: int = DICTIONARY_WORDS) -> DataFrame:
    """One row per input row: doc_id, n_assign, n_access, n_hex, n_guess,
    base_sha256 and spans (kind:start:end of all spans in code points, end
    exclusive, by start and kind, joined by commas). The dictionary is ``words``
    and the ``dictionary_words`` most common words of the documents."""
    shared = docs.sparkSession.sparkContext.broadcast(common_words(docs, text_col, dictionary_words))
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost = GuessCost(words, shared.value)
        for batch in batches:
            texts, out = batch.column(0), []
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                base, more = base_spans(text), guess_spans(text, cost, min_cost)
                kinds = [k for _, _, k in base]
                out.append((kinds.count("assign"), kinds.count("access"), kinds.count("hex"), len(more),
                            hashlib.sha256(written(base).encode()).hexdigest(), written(base + more)))
            columns = list(zip(*out, strict=True)) if out else [()] * 6
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"])

    return rows.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, "
                                "base_sha256 string, spans string")
