"""Content similarity of products — TF-IDF over product terms
(category, brand, price band) and the top-k neighbours by cosine.

Terms are binary (tf = 1) with idf = ln((N + 1) / (df + 1)), MLlib's IDF
formula. Products with the same term set have the same vector, so the
similarity is computed between distinct term sets ("signatures"). A product
has at most three terms, hence at most seven non-empty subsets of them: two
signatures meet under the subset that they share. Among the products under
one subset the cosine falls as the neighbour's norm rises, so its k+1
products of smallest norm contain every neighbour it can supply; the work is
linear in the catalog and the result exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.functions.sizing import materialize

TOP_K = 10


def product_terms(products: DataFrame) -> DataFrame:
    """``product_id, terms``: category, brand and log2 price band as terms."""
    band = F.when(F.col("avg_price") > 0, F.floor(F.log2("avg_price")).cast("int"))
    terms = F.array(
        F.concat(F.lit("category="), F.col("main_category_code")),
        F.concat(F.lit("brand="), F.col("main_brand")),
        F.concat(F.lit("band="), band.cast("string")))
    return products.select("product_id", F.array_sort(F.filter(terms, lambda t: t.isNotNull()))
                           .alias("terms"))


def term_idf(terms: DataFrame) -> DataFrame:
    """``term, idf`` with idf = ln((N + 1) / (df + 1))."""
    n = terms.agg(F.count(F.lit(1)).alias("n")).scalar()
    df = terms.select(F.explode("terms").alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("df"))
    return df.select("term", F.log((n + 1.0) / (F.col("df") + 1.0)).alias("idf"))


def _subsets(w: Column) -> Column:
    """Every non-empty subset of at most three weighted terms, as (key, dot):
    the terms as one text, and what they add to a dot product."""
    sep = F.lit("\u0002")
    parts = []
    for picked in ([0], [1], [2], [0, 1], [0, 2], [1, 2], [0, 1, 2]):
        items = [F.get(w, i) for i in picked]
        key, dot = items[0]["term"], items[0]["idf"] * items[0]["idf"]
        for x in items[1:]:
            key, dot = F.concat(key, sep, x["term"]), dot + x["idf"] * x["idf"]
        parts.append(F.struct(key.alias("key"), dot.alias("dot")))
    return F.filter(F.array(*parts), lambda k: k["key"].isNotNull())


def content_similarity(products: DataFrame, k: int = TOP_K) -> DataFrame:
    """Top-``k`` most similar products per product: ``product_id, neighbor_id,
    similarity, rank`` (ties by neighbour id; only similarity > 0)."""
    # Terms and signatures are small tables with several readers each.
    terms = materialize(product_terms(products).filter(F.size("terms") > 0))
    idf = term_idf(terms)
    sep = "\u0001"
    prods = terms.select("product_id", F.array_join("terms", sep).alias("sig"))
    # a signature is its term list joined: split it back (keeps a hash distinct)
    weighted = (prods.select("sig").distinct()
                .select("sig", F.explode(F.split("sig", sep)).alias("term")).join(idf, "term")
                .groupBy("sig").agg(
                    F.sort_array(F.collect_list(F.struct("term", "idf"))).alias("w"))  # three at most
                .withColumn("norm", F.sqrt(F.aggregate("w", F.lit(0.0), lambda s, x: s + x["idf"] * x["idf"])))
                .withColumn("s", F.explode(_subsets(F.col("w"))))
                .select("sig", "w", "norm", "s.key", "s.dot"))
    weighted = materialize(weighted)
    # the k+1 smallest product ids of every signature (k+1: one may be the product itself)
    w_sig = Window.partitionBy("sig").orderBy("product_id")
    heads = (prods.withColumn("_r", F.row_number().over(w_sig)).filter(F.col("_r") <= k + 1)
             .select("sig", F.col("product_id").alias("neighbor_id")))
    # Per subset of terms, the k+1 products of smallest norm (rounded: equal
    # norms reached by different summation orders must tie). Terms that every
    # product has weigh nothing: there all cosines are 0 and the id decides.
    size = F.when(F.col("dot") > 0, F.floor(F.col("norm") * 1e12 + 0.5)).otherwise(F.lit(0))
    w_key = Window.partitionBy("key").orderBy(size, "neighbor_id")
    best = (weighted.join(heads, "sig").withColumn("_r", F.row_number().over(w_key))
            .filter(F.col("_r") <= k + 1)
            .select("key", "neighbor_id", F.col("w").alias("wb"), F.col("norm").alias("nb")))
    met = (weighted.select(F.col("sig").alias("sig_a"), "key", F.col("w").alias("wa"),
                           F.col("norm").alias("na")).join(best, "key")
           .groupBy("sig_a", "neighbor_id").agg(
               F.first("wa").alias("wa"), F.first("na").alias("na"),
               F.first("wb").alias("wb"), F.first("nb").alias("nb")))
    shared = F.filter("wa", lambda x: F.array_contains(F.col("wb.term"), x["term"]))
    dot = F.aggregate(shared, F.lit(0.0), lambda s, x: s + x["idf"] * x["idf"])
    # rank on the similarity rounded to 9 decimals: equal cosines reached by
    # different summation orders must tie
    sims = met.withColumn("similarity", dot / (F.col("na") * F.col("nb"))).withColumn(
        "_key", F.floor(F.col("similarity") * 1e9 + 0.5))
    w_a = Window.partitionBy("sig_a").orderBy(F.desc("_key"), F.asc("neighbor_id"))
    cand = (sims.withColumn("_r", F.row_number().over(w_a)).filter(F.col("_r") <= k + 1)
            .select("sig_a", "neighbor_id", "similarity", "_key"))
    per = prods.select("product_id", F.col("sig").alias("sig_a")).join(cand, "sig_a").filter(
        F.col("neighbor_id") != F.col("product_id"))
    w_p = Window.partitionBy("product_id").orderBy(F.desc("_key"), F.asc("neighbor_id"))
    return (per.withColumn("rank", F.row_number().over(w_p)).filter(F.col("rank") <= k)
            .select("product_id", "neighbor_id", "similarity", "rank"))
