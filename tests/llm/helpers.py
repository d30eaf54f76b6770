"""Small frames with the awkward rows that every operator must take."""

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 997} number{i}" for i in range(30_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog", "en", "src0", 43),
    (2, "The  quick brown\tfox jumps over the lazy dog", "en", "src0", 44),
    (3, None, None, None, None),
    (4, "", "en", "src1", 0),
    (5, " \n\t ", "de", "src1", 4),
    (6, LONG, "en", "src0", len(LONG)),
    (7, LONG + " tail", "en", "src2", len(LONG) + 5),
    (8, f"first line\n{PASSAGE}\nlast line", "en", "src3", 0),
    (9, f"other line\n{PASSAGE}\nfinal line", "en", "src3", 0),
    (10, "repeat", "fr", "src4", 6),
    (10, "repeat", "fr", "src4", 6),  # the same row twice
    (11, "same id, one text", "fr", "src4", 17),
    (11, "same id, another text", "fr", "src4", 21),
    (None, "no id at all", "es", "src5", 12),
    (None, None, "es", None, None),
    (12, "naïve café ☕ 中文 ▁ 😀", "xx", "src6", 0),
]


def awkward(spark: SparkSession) -> DataFrame:
    """The rows above, with columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ("fingerprint", "component_id", "epoch", "domain", "budget", "ids", "score", "row", "digest",
             "held_out", "_id", "_removed", "h", "no", "kept")
    return spark.createDataFrame(ROWS, SCHEMA).select("*", *[F.lit("x").alias(n) for n in names])


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)
