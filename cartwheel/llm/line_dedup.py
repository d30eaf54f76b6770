"""Line deduplication on content-defined chunks of lines.

A text is cut into lines, every line is hashed, and a rolling polynomial runs
over the hashes of two successive lines with a word (blank lines between them
count with the first). A line of ``long_words`` or more words is several
sentences and is also taken by itself. Chunks are the longest runs of lines
whose rolling hashes all occur more than once in the table: a boundary stands
where that changes, so it depends on the lines next to it only, and lines
inserted or taken away elsewhere shift none. Within chunks, each window (two
lines, or one long line) that is not the first occurrence of its bytes in the table
(smallest id, then hash of the text, then position) loses its lines. So a
passage of two or more lines, or a long line, goes wherever it is repeated; what
occurs first stays whole.

Plan, all of it DataFrame expressions:

1. One narrow row a window (document key, number, hashes of its two parts) is
   written. Rolling hashes are counted in a hash aggregation with
   partial counts, so a passage in a third of all documents is no task's work;
   windows that occur once drop out here, before any text moves.
2. The first occurrence of the others is a partial minimum by the hashes of
   both parts; each document gets the numbers of its candidates and of those
   that go, and is written with them: the only shuffle of whole texts.
3. Byte comparison: the distinct texts of candidates' parts, merged in each task
   first, are counted by hash. Where there is one, all texts with that hash are
   the same. Hashes that stand for several texts (the rule is that there are none)
   send their windows through a comparison by text, and their documents are
   corrected.
4. Texts that lose lines are joined again from the lines that stay.

Rows: null text stays null and has no lines; rows with the same id and text are
one document (they keep the same lines); null ids come last in the order. A
text may become empty. Short single lines stay. An empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.sizing import drop_table
from cartwheel.llm.common import WORD, stage

LINE_BREAK = "\n"
MULTIPLIER = 31  # of the rolling polynomial
MODULUS = 1 << 57  # of its terms: no sum overflows


def _is_long(line: Column, long_words: int) -> Column:
    # Fewer characters cannot hold that many words: no need to count them.
    return (F.length(line) >= 2 * long_words - 1) & (F.regexp_count(line, F.lit(WORD)) >= long_words)


def _with_lines(df: DataFrame, text: str) -> DataFrame:
    """Add ``_lines``, and ``_worded``: the indices of those with a word."""
    return (df.withColumn("_lines", F.split(F.col(text), LINE_BREAK, -1))
            .withColumn("_worded", F.filter(F.sequence(F.lit(0), F.size("_lines") - 1),
                                            lambda i: F.get(F.col("_lines"), i).rlike(WORD))))


def _ends(no: Column) -> tuple[Column, Column]:
    """Indices of the first and last line of a window: 2 j is the pair of
    worded lines j and j + 1, 2 j + 1 is line j by itself."""
    j = F.shiftright(no, 1)
    return F.get(F.col("_worded"), j), F.get(F.col("_worded"), j + 1 - no % 2)


def _parts(no: Column) -> tuple[Column, Column]:
    """Texts of a window's parts: the first line with the blank ones after it,
    and the second line, or the single line and null."""
    first, last = _ends(no)
    size = F.greatest(last - first, F.lit(1))
    return (F.array_join(F.slice(F.col("_lines"), first + 1, size), LINE_BREAK),
            F.when(no % 2 == 0, F.get(F.col("_lines"), last)))


def _hash(text: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(1 << bits)) if bits < 64 else F.xxhash64(text)


def _windows(rows: DataFrame, long_words: int, bits: int) -> DataFrame:
    """(_id, _hash, no, a, b): hashes of the parts of every window of (_id,
    _hash, _text)."""
    def is_window(no: Column) -> Column:
        return F.when(no % 2 == 0, F.shiftright(no, 1) < F.size("_worded") - 1).otherwise(
            _is_long(F.get(F.col("_lines"), _ends(no)[0]), long_words))

    def parts(no: Column) -> Column:
        a, b = _parts(no)
        return F.struct(no.alias("no"), _hash(a, bits).alias("a"),
                        F.when(no % 2 == 0, _hash(b, bits)).alias("b"))

    numbers = F.filter(F.sequence(F.lit(0), F.greatest(2 * F.size("_worded") - 1, F.lit(0))), is_window)
    return _with_lines(rows, "_text").select("_id", "_hash", F.inline(F.transform(numbers, parts)))


def _rolling() -> Column:
    """Rolling hash of a window; that of a single line is negative."""
    a, b = (F.pmod(F.col(c), F.lit(MODULUS)) for c in "ab")
    return F.when(F.col("b").isNull(), -1 - a).otherwise(a * MULTIPLIER + b)


def _first(windows: DataFrame, *by: str) -> DataFrame:
    """``windows`` with ``goes``: not the first of those equal in ``by``."""
    place = F.struct(F.col("_id").isNull(), "_id", "_hash", "no")
    first = windows.groupBy(*by).agg(F.min(place).alias("_first")).select(
        *[F.col(c).alias(f"_by_{c}") for c in by], "_first")
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    return (windows.join(first, same).withColumn("goes", ~place.eqNullSafe(F.col("_first")))
            .drop("_first", *[f"_by_{c}" for c in by]))


def _numbers() -> Column:
    return F.sort_array(F.collect_set(F.when(F.col("goes"), F.col("no"))))


def _marked(docs: DataFrame, id_col: str, text_col: str, long_words: int, bits: int) -> DataFrame:
    """(_row, _did, _dhash, _text, _nos, _removed): the documents, ``_row``
    without the text, with the numbers of their candidates and of those whose
    hashes are not the first; written."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    packed = docs.select(F.struct(*others, F.lit(None).alias("_")).alias("_row"),
                         F.col(id_col).cast("long").alias("_did"), F.xxhash64(text_col).alias("_dhash"),
                         F.col(text_col).alias("_text"))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_hash"),
                       F.col(text_col).alias("_text")).filter(F.col("_text").isNotNull())
    windows, path = stage(_windows(rows, long_words, bits))
    windows = windows.withColumn("r", _rolling())
    repeated = windows.groupBy("r").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("r")
    found = _first(windows.join(repeated, "r", "left_semi"), "a", "b")
    numbers = found.groupBy("_id", "_hash").agg(F.collect_set("no").alias("_nos"), _numbers().alias("_removed"))
    by_doc = packed["_did"].eqNullSafe(numbers["_id"]) & (packed["_dhash"] == numbers["_hash"])
    marked, _ = stage(packed.join(numbers, by_doc, "left").drop("_id", "_hash"))
    drop_table(docs.sparkSession, path)
    return marked


def _corrected(marked: DataFrame, bits: int) -> DataFrame:
    """``marked`` after comparing bytes."""
    def texts(no: Column) -> Column:
        a, b = _parts(no)
        return F.struct(no.alias("no"), a.alias("a"), b.alias("b"))

    candidates = _with_lines(marked.filter(F.size("_nos") > 0), "_text").select(
        F.col("_did").alias("_id"), F.col("_dhash").alias("_hash"), "_removed", F.inline(F.transform("_nos", texts)))
    part = F.explode(F.array("a", "b")).alias("part")
    unequal = (candidates.select(part).filter("part IS NOT NULL").distinct()
               .groupBy(_hash(F.col("part"), bits).alias("h")).agg(F.count(F.lit(1)).alias("n"))
               .filter("n > 1").select("h"))
    unequal, path = stage(unequal)
    if unequal.isEmpty():
        drop_table(marked.sparkSession, path)
        return marked
    held = (candidates.select("_id", "_hash", "no", part).filter("part IS NOT NULL")
            .join(unequal, _hash(F.col("part"), bits) == unequal["h"], "left_semi")
            .select("_id", "_hash", "no").distinct()
            .select(*[F.col(c).alias(f"_u{c}") for c in ("_id", "_hash", "no")]))
    windows = candidates.join(held, F.col("_id").eqNullSafe(F.col("_u_id")) & (F.col("_hash") == F.col("_u_hash"))
                              & (F.col("no") == F.col("_uno")), "left")
    doubtful = windows.filter("_uno IS NOT NULL").select("_id", "_hash", "no", "a", "b")
    sure = windows.filter("_uno IS NULL").select("_id", "_hash", "no",
                                                 F.array_contains("_removed", F.col("no")).alias("goes"))
    numbers = (_first(doubtful, "a", "b").select("_id", "_hash", "no", "goes").unionByName(sure)
               .groupBy("_id", "_hash").agg(_numbers().alias("_right")))
    by_doc = marked["_did"].eqNullSafe(numbers["_id"]) & (marked["_dhash"] == numbers["_hash"])
    return marked.join(numbers, by_doc, "left").withColumn("_removed", F.col("_right")).drop("_id", "_hash", "_right")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None,
               long_words: int = 50, hash_bits: int = 64) -> DataFrame:
    """The rows and columns of ``docs`` with repeated chunks taken out of
    ``text_col``; with ``count_col``, also the number of lines removed.
    ``hash_bits`` weakens line hashes in tests; it changes no result."""
    marked = _corrected(_marked(docs, id_col, text_col, long_words, hash_bits), hash_bits)
    # Texts that lose nothing are not cut again.
    cut = _with_lines(marked.withColumn("_cut", F.when(F.size("_removed") > 0, F.col("_text"))), "_cut")
    gone = F.array_distinct(F.flatten(F.transform("_removed", lambda no: F.sequence(*_ends(no)))))
    cut = cut.withColumn("_gone", F.when(F.col("_cut").isNotNull(), gone))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col("_lines"), i)), LINE_BREAK)
    text = F.when(F.col("_cut").isNull(), F.col("_text")).otherwise(kept)
    columns = [text.alias(c) if c == text_col else F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    if count_col:
        columns.append(F.coalesce(F.size("_gone"), F.lit(0)).cast("int").alias(count_col))
    return cut.select(*columns)


def line_dedup_sql(long_words: int = 50) -> str:
    """DuckDB SQL of the operator over ``documents`` (distinct ids):
    doc_id, removed_lines, n_chars, text_sha256."""
    return rf"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, ls, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM split),
worded AS (
  SELECT doc_id, ls, line, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt
  FROM lines WHERE regexp_matches(line, '{WORD}')),
windows AS (
  SELECT doc_id, i, nxt AS last, 2 AS size, array_to_string(ls[i:nxt], chr(10)) AS t
  FROM worded WHERE nxt IS NOT NULL
  UNION ALL
  SELECT doc_id, i, i, 1, line FROM worded
  WHERE len(regexp_extract_all(line, '{WORD}')) >= {long_words}),
ranked AS (
  SELECT doc_id, i, last, row_number() OVER (PARTITION BY size, t ORDER BY doc_id, i) AS r FROM windows),
gone AS (
  SELECT DISTINCT doc_id, i FROM (
    SELECT doc_id, unnest(generate_series(i, last)) AS i FROM ranked WHERE r > 1) AS x),
rebuilt AS (
  SELECT l.doc_id, count(g.i) AS removed_lines,
         coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS t
  FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(removed_lines, 0)::INTEGER AS removed_lines,
       length(t)::INTEGER AS n_chars, sha256(t) AS text_sha256
FROM documents d LEFT JOIN rebuilt USING (doc_id)
"""
