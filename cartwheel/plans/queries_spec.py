"""Registered queries for operators asked for by the requirements."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from cartwheel.operators import (
    affinity,
    behavior,
    content,
    evaluation,
    hybrid,
    incremental,
    products,
    profiling,
    recommend,
    segmentation,
    sessions,
    sketches,
    timeseries,
)
from cartwheel.plans.catalog import register
from cartwheel.plans.oracle import BASE_CTES, CLEANED_CTES, normalized, with_ctes
from cartwheel.plans.queries_batch import cleaned
from cartwheel.plans.queries_model import (
    _REC_CTES,
    _UB_LABEL_CTE,
    ACTIVITY_COLS,
    _labelled_users,
    activity,
    product_table,
    recs,
)
from cartwheel.plans.queries_profile import _ACT_AGGS, _ACT_COLS, _POP_AGGS, _POP_COLS
from cartwheel.schema import clickstream
from cartwheel.sources import points
from cartwheel.streaming.files import day_filter, scratch_dir

# ------------------------------------------------------------------ sessions


def _path_sql(col, n):
    step = f"coalesce(CAST({col} AS VARCHAR), 'NULL')"
    win = "OVER (PARTITION BY user_session ORDER BY event_time, event_id)"
    parts = [step] + [f"lead({step}, {i}) {win}" for i in range(1, n)]
    return (f"SELECT path, count(*) AS count, {n} AS n FROM (SELECT "
            + " || '>' || ".join(parts) + f" AS path, lead(event_id, {n - 1}) {win} AS last_id "
            "FROM {src} WHERE user_session IS NOT NULL) AS t WHERE last_id IS NOT NULL "
            "GROUP BY path")


@register("navigation_paths", normalized(
    _path_sql("event_type", 2).format(src="clickstream"), ["path", "count", "n"], ctes=BASE_CTES))
def q_navigation_paths(spark, sf_dir):
    """Two-step event-type paths inside sessions, with counts."""
    return sessions.navigation_paths(clickstream(spark, sf_dir), 2, "event_type")


@register("navigation_paths_categories", normalized(
    _path_sql("category_code", 3).format(src="cleaned"), ["path", "count", "n"],
    ctes=CLEANED_CTES))
def q_navigation_paths_categories(spark, sf_dir):
    """Three-step category paths inside sessions (cleaned categories)."""
    return sessions.navigation_paths(cleaned(spark, sf_dir), 3, "category_code")


_SESSION_COLS = ["user_session", "user_id", "events", "event_types", "first_event", "last_event",
                 "minutes", "views", "carts", "purchases", "purchase_value"]


@register("session_metrics", normalized(
    "SELECT user_session, min(user_id) AS user_id, count(*) AS events, "
    "count(DISTINCT event_type) AS event_types, min(event_time) AS first_event, "
    "max(event_time) AS last_event, "
    "(epoch_us(max(event_time)) - epoch_us(min(event_time))) / 6.0e7 AS minutes, "
    "count(*) FILTER (WHERE event_type = 'view') AS views, "
    "count(*) FILTER (WHERE event_type = 'cart') AS carts, "
    "count(*) FILTER (WHERE event_type = 'purchase') AS purchases, "
    "sum(CASE WHEN event_type = 'purchase' THEN price ELSE CAST(0 AS DOUBLE) END) AS purchase_value "
    "FROM cleaned WHERE user_session IS NOT NULL GROUP BY user_session",
    _SESSION_COLS, dbl=("minutes", "purchase_value"), tss=("first_event", "last_event"),
    ctes=CLEANED_CTES))
def q_session_metrics(spark, sf_dir):
    """Indicators per session."""
    return sessions.session_metrics(cleaned(spark, sf_dir))


@register("gap_sessions", normalized("""
SELECT user_id, min(event_time) AS visit_start, max(event_time) + INTERVAL '30 minutes' AS visit_end,
       count(*) AS events, count(*) FILTER (WHERE event_type = 'purchase') AS purchases
FROM (SELECT *, sum(CASE WHEN prev IS NULL OR event_time - prev >= INTERVAL '30 minutes'
                         THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_time, event_id)
                  AS visit
      FROM (SELECT user_id, event_time, event_id, event_type,
                   lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time, event_id) AS prev
            FROM clickstream WHERE user_id IS NOT NULL) AS a) AS b
GROUP BY user_id, visit""", ["user_id", "visit_start", "visit_end", "events", "purchases"],
    tss=("visit_start", "visit_end"), ctes=BASE_CTES))
def q_gap_sessions(spark, sf_dir):
    """Visits split by 30 minutes of inactivity (session windows)."""
    return sessions.gap_sessions(clickstream(spark, sf_dir))


@register("funnel", normalized("""
SELECT count(*) AS viewed, count(c.t_cart) AS carted, count(p.t_purchase) AS purchased,
       count(c.t_cart) / CAST(count(*) AS DOUBLE) AS view_to_cart,
       count(p.t_purchase) / CAST(count(c.t_cart) AS DOUBLE) AS cart_to_purchase,
       count(p.t_purchase) / CAST(count(*) AS DOUBLE) AS view_to_purchase
FROM fv v
LEFT JOIN fc c USING (user_id, product_id)
LEFT JOIN fp p USING (user_id, product_id)""",
    ["viewed", "carted", "purchased", "view_to_cart", "cart_to_purchase", "view_to_purchase"],
    dbl=("view_to_cart", "cart_to_purchase", "view_to_purchase"), ctes=BASE_CTES + ["""
fv AS (SELECT user_id, product_id, min(event_time) AS t_view FROM clickstream
       WHERE event_type = 'view' GROUP BY 1, 2),
fc AS (SELECT e.user_id, e.product_id, min(e.event_time) AS t_cart FROM clickstream e
       JOIN fv USING (user_id, product_id)
       WHERE e.event_type = 'cart' AND e.event_time >= fv.t_view GROUP BY 1, 2),
fp AS (SELECT e.user_id, e.product_id, min(e.event_time) AS t_purchase FROM clickstream e
       JOIN fc USING (user_id, product_id)
       WHERE e.event_type = 'purchase' AND e.event_time >= fc.t_cart GROUP BY 1, 2)"""]))
def q_funnel(spark, sf_dir):
    """View → cart → purchase funnel per (user, product)."""
    return sessions.funnel(clickstream(spark, sf_dir))


# ------------------------------------------------------------------ baskets and content


@register("affinity_pairs", normalized("""
SELECT pc.a AS antecedent, pc.b AS consequent, pc.c AS pair_count, pc.c / n.n AS support,
       pc.c / ia.c AS confidence, (pc.c / ia.c) / (ib.c / n.n) AS lift
FROM (SELECT x.item AS a, y.item AS b, count(*) AS c FROM bk x JOIN bk y
      ON x.basket = y.basket AND x.item <> y.item GROUP BY 1, 2 HAVING count(*) >= 2) AS pc
JOIN (SELECT item, CAST(count(*) AS DOUBLE) AS c FROM bk GROUP BY item) AS ia ON ia.item = pc.a
JOIN (SELECT item, CAST(count(*) AS DOUBLE) AS c FROM bk GROUP BY item) AS ib ON ib.item = pc.b
CROSS JOIN (SELECT CAST(count(DISTINCT basket) AS DOUBLE) AS n FROM bk) AS n""",
    ["antecedent", "consequent", "pair_count", "support", "confidence", "lift"],
    dbl=("support", "confidence", "lift"),
    ctes=["bk AS (SELECT DISTINCT l_orderkey AS basket, l_partkey AS item FROM lineitem "
          "WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL)"]))
def q_affinity_pairs(spark, sf_dir):
    """Parts bought together (orders as baskets), support/confidence/lift."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return affinity.affinity_pairs(li, "l_orderkey", "l_partkey", min_count=2)


_SETS_SQL = """
SELECT items, size, count FROM (
  SELECT CAST(item AS VARCHAR) AS items, 1 AS size, count(*) AS count FROM bk GROUP BY item
  UNION ALL
  SELECT x.item || ',' || y.item, 2, count(*) FROM bk x JOIN bk y ON x.basket = y.basket AND x.item < y.item
  GROUP BY x.item, y.item
  UNION ALL
  SELECT x.item || ',' || y.item || ',' || z.item, 3, count(*) FROM bk x
  JOIN bk y ON x.basket = y.basket AND x.item < y.item JOIN bk z ON z.basket = y.basket AND y.item < z.item
  GROUP BY x.item, y.item, z.item) AS s
WHERE count >= 2
"""
_BASKETS = ["bk AS (SELECT DISTINCT l_orderkey AS basket, l_partkey AS item FROM lineitem "
            "WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL)"]


@register("frequent_itemsets", normalized(_SETS_SQL, ["items", "size", "count"], ctes=_BASKETS))
def q_frequent_itemsets(spark, sf_dir):
    """Sets of up to three parts in two orders or more."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    sets = affinity.frequent_itemsets(li, "l_orderkey", "l_partkey", min_count=2, max_size=3)
    return sets.select(F.array_join(F.col("items").cast("array<string>"), ",").alias("items"), "size", "count")


@register("association_rules", normalized("""
SELECT array_to_string(list_filter(s.parts, lambda p: p <> c.item), ',') AS antecedent, c.item AS consequent, s.count,
       s.count / n.n AS support, s.count / CAST(f.count AS DOUBLE) AS confidence,
       (s.count / CAST(f.count AS DOUBLE)) / (t.count / n.n) AS lift
FROM (SELECT items, count, string_split(items, ',') AS parts FROM sets WHERE size > 1) AS s,
     unnest(s.parts) AS c(item)
JOIN sets f ON f.items = array_to_string(list_filter(s.parts, lambda p: p <> c.item), ',')
JOIN sets t ON t.items = c.item
CROSS JOIN (SELECT CAST(count(DISTINCT basket) AS DOUBLE) AS n FROM bk) AS n""",
    ["antecedent", "consequent", "count", "support", "confidence", "lift"],
    dbl=("support", "confidence", "lift"), ctes=_BASKETS + [f"sets AS ({_SETS_SQL})"]))
def q_association_rules(spark, sf_dir):
    """Rules from one or two parts to another."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    rules = affinity.association_rules(li, "l_orderkey", "l_partkey", min_count=2, max_size=3)
    return rules.withColumn("antecedent", F.array_join(F.col("antecedent").cast("array<string>"), ",")).withColumn(
        "consequent", F.col("consequent").cast("string"))


_SEQUENCE_SQL = """
SELECT path, n, count(*) AS count FROM (
  SELECT DISTINCT user_session, part, step AS path, 1 AS n FROM st
  UNION ALL
  SELECT DISTINCT a.user_session, a.part, a.step || '>' || b.step, 2 FROM st a
  JOIN st b ON b.user_session = a.user_session AND b.part = a.part AND a.pos < b.pos
  UNION ALL
  SELECT DISTINCT a.user_session, a.part, a.step || '>' || b.step || '>' || c.step, 3 FROM st a
  JOIN st b ON b.user_session = a.user_session AND b.part = a.part AND a.pos < b.pos
  JOIN st c ON c.user_session = b.user_session AND c.part = b.part AND b.pos < c.pos) AS x
GROUP BY path, n HAVING count(*) >= 2
"""


@register("frequent_sequences", normalized(_SEQUENCE_SQL, ["path", "n", "count"], ctes=BASE_CTES + ["""
st AS (SELECT user_session, pos, (pos - 1) // 8 AS part, step FROM (
  SELECT user_session, coalesce(event_type, 'NULL') AS step,
         row_number() OVER (PARTITION BY user_session ORDER BY event_time, event_id) AS pos
  FROM clickstream WHERE user_session IS NOT NULL) AS s)"""]))
def q_frequent_sequences(spark, sf_dir):
    """Event-type sequences of up to three steps with gaps, in two parts
    (eight events each) of sessions or more."""
    return sessions.frequent_sequences(clickstream(spark, sf_dir), min_count=2, max_length=3, window=8)


_CONTENT_SQL = """
SELECT product_id, neighbor_id, similarity, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY product_id
           ORDER BY floor(similarity * 1e9 + 0.5) DESC, neighbor_id ASC) AS INTEGER) AS rank
  FROM (SELECT d.product_id, d.neighbor_id, d.dot / (na.norm * nb.norm) AS similarity
        FROM (SELECT a.product_id, b.product_id AS neighbor_id, sum(i.idf * i.idf) AS dot
              FROM pt a JOIN pt b ON a.term = b.term AND a.product_id <> b.product_id
              JOIN idf i ON i.term = a.term GROUP BY 1, 2) AS d
        JOIN nrm na ON na.product_id = d.product_id
        JOIN nrm nb ON nb.product_id = d.neighbor_id) AS s) AS r
WHERE rank <= 10
"""
_CONTENT_CTES = _REC_CTES + ["""
terms AS (
  SELECT product_id, list_sort(list_filter([
           'category=' || main_category_code, 'brand=' || main_brand,
           'band=' || CAST(CASE WHEN avg_price > 0 THEN CAST(floor(log2(avg_price)) AS INTEGER) END
                           AS VARCHAR)], lambda t: t IS NOT NULL)) AS terms
  FROM products),
pt AS (SELECT product_id, unnest(terms) AS term FROM terms WHERE len(terms) > 0),
idf AS (SELECT term, ln(((SELECT count(*) FROM terms WHERE len(terms) > 0) + 1.0)
                        / (count(*) + 1.0)) AS idf FROM pt GROUP BY term),
nrm AS (SELECT product_id, sqrt(sum(idf * idf)) AS norm FROM pt JOIN idf USING (term)
        GROUP BY product_id)"""]


@register("content_similarity", normalized(
    _CONTENT_SQL, ["product_id", "neighbor_id", "similarity", "rank"], dbl=("similarity",),
    ctes=_CONTENT_CTES))
def q_content_similarity(spark, sf_dir):
    """Ten most similar products by TF-IDF cosine of product terms."""
    return content.content_similarity(product_table(spark, sf_dir))


# ------------------------------------------------------------------ blends and evaluation

_HYBRID_SQL = """
WITH_SRC
SELECT coalesce(a.user_id, p.user_id) AS user_id, coalesce(a.product_id, p.product_id) AS product_id,
       coalesce(a.s, 0.0) AS affinity, coalesce(p.s, 0.0) AS popularity,
       coalesce(a.s, 0.0) * 0.7 + coalesce(p.s, 0.0) * 0.3 AS hybrid_score
FROM sa a FULL OUTER JOIN sp p ON a.user_id = p.user_id AND a.product_id = p.product_id
"""


def _scaled(src):
    return (f"SELECT user_id, product_id, CASE WHEN (SELECT max(score) FROM {src}) > "
            f"(SELECT min(score) FROM {src}) THEN (score - (SELECT min(score) FROM {src})) / "
            f"((SELECT max(score) FROM {src}) - (SELECT min(score) FROM {src})) ELSE 1.0 END AS s "
            f"FROM {src}")


_HYBRID_CTES = _REC_CTES + [f"""
ra AS (SELECT user_id, product_id, max(rec_score) AS score FROM affinity GROUP BY 1, 2),
rp AS (SELECT u.user_id, p.product_id, max(CAST(p.total_purchases AS DOUBLE)) AS score
       FROM act_users u CROSS JOIN (SELECT product_id, total_purchases FROM products
                                    ORDER BY total_purchases DESC, product_id ASC LIMIT 10) AS p
       GROUP BY 1, 2),
sa AS ({_scaled('ra')}),
sp AS ({_scaled('rp')})"""]


@register("hybrid_scores", normalized(
    _HYBRID_SQL.replace("WITH_SRC", ""),
    ["user_id", "product_id", "affinity", "popularity", "hybrid_score"],
    dbl=("affinity", "popularity", "hybrid_score"), ctes=_HYBRID_CTES))
def q_hybrid_scores(spark, sf_dir):
    """Min-max scaled blend of affinity and popularity scores (0.7/0.3)."""
    act = activity(spark, sf_dir)
    prods = product_table(spark, sf_dir)
    aff = recommend.category_affinity(act, prods).select(
        "user_id", "product_id", F.col("rec_score").alias("score"))
    users = recommend.distinct_users(act.filter(F.col("user_id").isNotNull()))
    best = (prods.orderBy(F.desc("total_purchases"), F.asc("product_id")).limit(recommend.FALLBACK_PRODUCTS)
            .agg(F.collect_list(F.struct("product_id", "total_purchases")).alias("items")).scalar())
    pop = users.select("user_id", F.explode(best).alias("p")).select(
        "user_id", F.col("p.product_id").alias("product_id"),
        F.col("p.total_purchases").cast("double").alias("score"))
    return hybrid.hybrid_scores({"affinity": aff, "popularity": pop},
                                {"affinity": 0.7, "popularity": 0.3})


@register("segment_adjusted_recs", normalized("""
SELECT r.user_id, r.product_id, r.rec_score, r.recommended_category_code, u.segment_id, l.lift,
       r.rec_score * coalesce(l.lift, 1.0) AS adjusted_score
FROM recs r LEFT JOIN ub u ON u.user_id = r.user_id
LEFT JOIN (
  SELECT s.segment_id, s.category_code,
         (s.n / CAST(t.seg_n AS DOUBLE)) / (c.cat_n / CAST((SELECT count(*) FROM cleaned x
                                                           JOIN ub y USING (user_id)) AS DOUBLE))
           AS lift
  FROM (SELECT u.segment_id, e.category_code, count(*) AS n FROM cleaned e JOIN ub u USING (user_id)
        GROUP BY 1, 2) AS s
  JOIN (SELECT u.segment_id, count(*) AS seg_n FROM cleaned e JOIN ub u USING (user_id)
        GROUP BY 1) AS t ON t.segment_id = s.segment_id
  JOIN (SELECT e.category_code, count(*) AS cat_n FROM cleaned e JOIN ub u USING (user_id)
        GROUP BY 1) AS c ON c.category_code = s.category_code) AS l
  ON l.segment_id = u.segment_id AND l.category_code = r.recommended_category_code""",
    ["user_id", "product_id", "rec_score", "recommended_category_code", "segment_id", "lift",
     "adjusted_score"], dbl=("rec_score", "lift", "adjusted_score"),
    ctes=_REC_CTES + _UB_LABEL_CTE))
def q_segment_adjusted_recs(spark, sf_dir):
    """Scores × segment-level category lift (weekday-of-last-visit segments)."""
    from cartwheel.plans.queries_model import _labelled_users
    seg = _labelled_users(spark, sf_dir).select("user_id", "segment_id")
    lift = hybrid.segment_category_lift(cleaned(spark, sf_dir), seg)
    out = hybrid.segment_adjusted_recs(recs(spark, sf_dir), seg, lift)
    return out.select("user_id", "product_id", "rec_score", "recommended_category_code",
                      "segment_id", "lift", "adjusted_score")


def _train_rec_ctes():
    body = _REC_CTES[-1].replace("FROM clickstream", "FROM train_cs").replace(
        "FROM cleaned", "FROM train_cl")
    return CLEANED_CTES + [
        "train_cs AS (SELECT * FROM clickstream WHERE day(event_time) < 24)",
        "train_cl AS (SELECT * FROM cleaned WHERE day(event_time) < 24)", body]


_PRECISION_SQL = """
SELECT count(*) AS users, avg(precision) AS precision_at_k, avg(recall) AS recall_at_k,
       avg(hit) AS hit_rate, avg(ndcg) AS ndcg_at_k, 5 AS k
FROM (
  SELECT n.user_id, coalesce(h.hits, 0) / 5.0 AS precision,
         coalesce(h.hits, 0) / CAST(n.n_relevant AS DOUBLE) AS recall,
         CASE WHEN coalesce(h.hits, 0) > 0 THEN 1.0 ELSE 0.0 END AS hit,
         coalesce(h.dcg, 0.0) / list_sum(list_transform(range(1, least(n.n_relevant, 5) + 1),
                                                          lambda i: 1.0 / log2(i + 1.0))) AS ndcg
  FROM (SELECT user_id, count(*) AS n_relevant FROM rel GROUP BY 1) AS n
  LEFT JOIN (SELECT t.user_id, count(*) AS hits, sum(1.0 / log2(t.rank + 1.0)) AS dcg
             FROM (SELECT * FROM (SELECT user_id, product_id, row_number() OVER (
                     PARTITION BY user_id ORDER BY rec_score DESC, product_id ASC) AS rank
                   FROM recs) AS x WHERE rank <= 5) AS t
             JOIN rel r ON r.user_id = t.user_id AND r.product_id = t.product_id
             GROUP BY 1) AS h ON h.user_id = n.user_id) AS per
"""


@register("precision_at_k", normalized(
    _PRECISION_SQL, ["users", "precision_at_k", "recall_at_k", "hit_rate", "ndcg_at_k", "k"],
    dbl=("precision_at_k", "recall_at_k", "hit_rate", "ndcg_at_k"),
    ctes=_train_rec_ctes() + [
        "rel AS (SELECT DISTINCT user_id, product_id FROM cleaned WHERE day(event_time) >= 24 "
        "AND event_type IN ('cart', 'purchase'))"]))
def q_precision_at_k(spark, sf_dir):
    """Recommendations from days 1-23 against carts/purchases of days 24+."""
    train = day_filter(1, 23)
    cl = cleaned(spark, sf_dir)
    prods = products.product_data(cl.filter(train), with_index=False)
    r = recommend.recommend(activity(spark, sf_dir).filter(train), prods)
    relevant = cl.filter(~train & F.col("event_type").isin("cart", "purchase"))
    return evaluation.precision_at_k(r, relevant, k=5)


# Rolling folds: training days before, test days from .. to.
_FOLDS = [(15, 19), (20, 24), (25, 29)]
_GRID = {"categories_1": 1, "categories_3": 3}


def _fold_sql(number, lo, hi, name, categories):
    *_, body = _train_rec_ctes()
    inner = [f"train_cs AS (SELECT * FROM clickstream WHERE day(event_time) < {lo})",
             f"train_cl AS (SELECT * FROM cleaned WHERE day(event_time) < {lo})",
             body.replace("AS t WHERE rank <= 3", f"AS t WHERE rank <= {categories}"),
             f"rel AS (SELECT DISTINCT user_id, product_id FROM cleaned WHERE day(event_time) BETWEEN {lo} AND {hi} "
             "AND event_type IN ('cart', 'purchase'))"]
    return (f"SELECT {number} AS fold, '{name}' AS candidate, x.* FROM (" + with_ctes(inner, _PRECISION_SQL)
            + ") AS x")


_FOLDS_SQL = " UNION ALL ".join(
    _fold_sql(i, lo, hi, name, n) for i, (lo, hi) in enumerate(_FOLDS) for name, n in _GRID.items())
_FOLD_DBL = ("precision_at_k", "recall_at_k", "hit_rate", "ndcg_at_k", "mean_ndcg")


@register("cross_validated_relevance", normalized(
    f"SELECT *, avg(ndcg_at_k) OVER (PARTITION BY candidate) AS mean_ndcg FROM ({_FOLDS_SQL}) AS f",
    ["fold", "candidate", "users", *_FOLD_DBL, "k"], dbl=_FOLD_DBL, ctes=CLEANED_CTES))
def q_cross_validated_relevance(spark, sf_dir):
    """Rolling time folds (training on all earlier days, test on the next
    five) and a grid over the number of categories a user is served from."""
    grid = {name: functools.partial(recommend.recommend, k_categories=n) for name, n in _GRID.items()}
    folds = [(day_filter(1, lo - 1), day_filter(lo, hi)) for lo, hi in _FOLDS]
    acts = clickstream(spark, sf_dir).select("event_time", *ACTIVITY_COLS)
    return evaluation.cross_validate(cleaned(spark, sf_dir), acts, folds, grid)


_INC_COLS = ["user_id", "total_events", "views", "carts", "purchases", "removes", "monetary",
             "avg_price", "first_seen", "last_seen", "active_days", "unique_products",
             "unique_categories", "unique_brands", "unique_sessions"]


@register("merge_user_aggregates", normalized(
    "SELECT user_id, count(*) AS total_events, "
    "count(*) FILTER (WHERE event_type = 'view') AS views, "
    "count(*) FILTER (WHERE event_type = 'cart') AS carts, "
    "count(*) FILTER (WHERE event_type = 'purchase') AS purchases, "
    "count(*) FILTER (WHERE event_type = 'remove_from_cart') AS removes, "
    "sum(CASE WHEN event_type = 'purchase' THEN price ELSE CAST(0 AS DOUBLE) END) AS monetary, "
    "avg(price) AS avg_price, min(event_time) AS first_seen, max(event_time) AS last_seen, "
    "count(DISTINCT CAST(event_time AS DATE)) AS active_days, "
    "count(DISTINCT product_id) AS unique_products, "
    "count(DISTINCT category_code) AS unique_categories, count(DISTINCT brand) AS unique_brands, "
    "count(DISTINCT user_session) AS unique_sessions FROM cleaned GROUP BY user_id",
    _INC_COLS, dbl=("monetary", "avg_price"), tss=("first_seen", "last_seen"), ctes=CLEANED_CTES))
def q_merge_user_aggregates(spark, sf_dir):
    """The state of days 1-15 is stored, loaded, merged with the other
    days and stored again; it equals a full recompute."""
    cl = cleaned(spark, sf_dir)
    base = scratch_dir(spark, "state")
    first = day_filter(1, 15)
    incremental.update_state(spark, cl.filter(first), base, "20240115_000000")
    state = incremental.update_state(spark, cl.filter(~first), base, "20240131_000000")
    return incremental.finalize(state).select(*_INC_COLS)


def _sketch_state(spark, sf_dir):
    """State of days 1-10, merged with days 11-20 and then with the others."""
    cl, raw = cleaned(spark, sf_dir), clickstream(spark, sf_dir)
    base = scratch_dir(spark, "sketches")
    parts = [day_filter(1, 10), day_filter(11, 20)]
    parts.append(~parts[0] & ~parts[1])
    for i, part in enumerate(parts):
        state = sketches.update_state(spark, cl.filter(part), raw.filter(part), base, f"2024010{i}_000000")
    return cl, raw, state


_SKETCH_EXACT = ["user_id", "total_events", "views", "carts", "purchases", "removes", "monetary", "avg_price",
                 "first_seen", "last_seen"]


@register("sketch_user_aggregates", normalized(
    "SELECT user_id, count(*) AS total_events, "
    "count(*) FILTER (WHERE event_type = 'view') AS views, count(*) FILTER (WHERE event_type = 'cart') AS carts, "
    "count(*) FILTER (WHERE event_type = 'purchase') AS purchases, "
    "count(*) FILTER (WHERE event_type = 'remove_from_cart') AS removes, "
    "sum(CASE WHEN event_type = 'purchase' THEN price ELSE CAST(0 AS DOUBLE) END) AS monetary, "
    "avg(price) AS avg_price, min(event_time) AS first_seen, max(event_time) AS last_seen, "
    "true AS distinct_within_bound FROM cleaned GROUP BY user_id",
    [*_SKETCH_EXACT, "distinct_within_bound"], dbl=("monetary", "avg_price"), tss=("first_seen", "last_seen"),
    ctes=CLEANED_CTES))
def q_sketch_user_aggregates(spark, sf_dir):
    """Three periods merged as stored sketches: exact sums, and five distinct
    counts a user, each within 8 % (5 standard errors) or 1 of the exact count."""
    cl, _, state = _sketch_state(spark, sf_dir)
    exact = incremental.finalize(incremental.partial_state(cl)).select(
        F.col("user_id").alias("_user"), *[F.col(k).alias(f"_{k}") for k in incremental.DISTINCT_KINDS])
    got = sketches.user_estimates(state[0]).join(exact, F.col("user_id").eqNullSafe(F.col("_user")), "left")
    near = [F.abs(F.col(k) - F.col(f"_{k}")) <= F.greatest(F.lit(1.0), F.col(f"_{k}") * 0.08)
            for k in incremental.DISTINCT_KINDS]
    return got.select(*_SKETCH_EXACT, F.coalesce(functools.reduce(lambda a, b: a & b, near), F.lit(False))
                      .alias("distinct_within_bound"))


@register("sketch_cleaning_statistics", normalized(
    "SELECT c.top_cat AS category_code, c.avg_cat_price, f.first_brand, true AS bounds_within_error "
    "FROM cs_cat c JOIN cs_first_brand f ON f.top_cat = c.top_cat",
    ["category_code", "avg_cat_price", "first_brand", "bounds_within_error"], dbl=("avg_cat_price",),
    ctes=CLEANED_CTES))
def q_sketch_cleaning_statistics(spark, sf_dir):
    """What cleaning needs, from the merged sketches of three
    periods: exact means and first brands; quartiles whose exact rank is within 2 %."""
    _, raw, state = _sketch_state(spark, sf_dir)
    stats = sketches.cleaning_statistics(state[1])
    bounds = stats.agg(F.max("q1").alias("q1"), F.max("q3").alias("q3"))
    price, ok = F.col("price").cast("double"), []
    q = bounds.select(F.array("q1", "q3")).scalar()
    for i, rank in enumerate((0.25, 0.75)):
        below, upto = F.avg((price < q[i]).cast("double")), F.avg((price <= q[i]).cast("double"))
        ok.append((below - 0.02 <= rank) & (upto + 0.02 >= rank))
    right = raw.filter(price.isNotNull()).agg((ok[0] & ok[1]).alias("ok")).scalar()
    return stats.select("category_code", "avg_cat_price", "first_brand", right.alias("bounds_within_error"))


@register("visit_frequency", normalized(
    "SELECT user_id, CAST(date_trunc('week', event_time) AS DATE) AS week, "
    "count(DISTINCT user_session) AS sessions, count(DISTINCT CAST(event_time AS DATE)) AS active_days,"
    " count(*) AS events FROM cleaned GROUP BY 1, 2",
    ["user_id", "week", "sessions", "active_days", "events"], ctes=CLEANED_CTES))
def q_visit_frequency(spark, sf_dir):
    """Sessions and active days per user and week."""
    return behavior.visit_frequency(cleaned(spark, sf_dir))


@register("top_viewed", normalized(
    "SELECT product_id, count(*) AS views FROM cleaned WHERE event_type = 'view' "
    "GROUP BY product_id ORDER BY views DESC, product_id ASC LIMIT 10", ["product_id", "views"],
    ctes=CLEANED_CTES))
def q_top_viewed(spark, sf_dir):
    """Most viewed products."""
    return profiling.top_viewed(cleaned(spark, sf_dir), "product_id")


@register("top_viewed_categories", normalized(
    "SELECT category_code, count(*) AS views FROM cleaned WHERE event_type = 'view' "
    "GROUP BY category_code ORDER BY views DESC, category_code ASC LIMIT 10",
    ["category_code", "views"], ctes=CLEANED_CTES))
def q_top_viewed_categories(spark, sf_dir):
    """Most viewed categories."""
    return profiling.top_viewed(cleaned(spark, sf_dir), "category_code")


def _measure_sql(name, src, ts, tags=(), fields=()):
    """Long-form points of a table: one row per tag and per field."""
    parts = [f"SELECT '{name}' AS measurement, {ts} AS ts, 'tag' AS kind, '{c}' AS key, "
             f"CAST({c} AS VARCHAR) AS tag_value, CAST(NULL AS DOUBLE) AS field_value FROM {src} "
             f"WHERE {c} IS NOT NULL" for c in tags]
    parts += [f"SELECT '{name}' AS measurement, {ts} AS ts, 'field' AS kind, '{c}' AS key, "
              f"CAST(NULL AS VARCHAR) AS tag_value, CAST({c} AS DOUBLE) AS field_value FROM {src} "
              f"WHERE {c} IS NOT NULL" for c in fields]
    return " UNION ALL ".join(parts)


_NEWEST = "(SELECT max(event_time) FROM cleaned)"
_METRIC_CTES = _REC_CTES + _UB_LABEL_CTE + [
    "m_hour AS (SELECT strftime(date_trunc('hour', event_time), '%Y-%m-%d %H:00:00') AS hour_bucket, "
    f"date_trunc('hour', event_time) AS t, {_ACT_AGGS} FROM cleaned GROUP BY 1, 2)",
    "m_seg AS (SELECT count(*) AS users, count(*) FILTER (WHERE first_label <> segment_id) AS changed, "
    "count(*) FILTER (WHERE first_label <> segment_id) * 100.0 / count(*) AS changed_pct FROM ub)",
    "m_rec AS (SELECT recommended_category_code, count(*) AS recommendations FROM recs "
    "WHERE recommended_category_code IS NOT NULL GROUP BY 1)",
    f"m_pop AS (SELECT product_id, {_POP_AGGS}, sum(price) AS total_revenue, "
    "sum(CASE WHEN event_type = 'purchase' THEN price END) AS purchase_revenue "
    "FROM cleaned GROUP BY product_id)"]
_METRIC_SQL = " UNION ALL ".join([
    _measure_sql("user_behavior", "m_hour", "t", ["hour_bucket"], _ACT_COLS),
    _measure_sql("segment_evolution", "m_seg", _NEWEST, [], ["users", "changed", "changed_pct"]),
    _measure_sql("recommendation_metrics", "m_rec", _NEWEST, ["recommended_category_code"],
                 ["recommendations"]),
    _measure_sql("product_popularity", "m_pop", _NEWEST, [],
                 _POP_COLS + ["total_revenue", "purchase_revenue"])])


_METRIC_COLS = ["measurement", "ts", "kind", "key", "tag_value", "field_value"]


@register("realtime_metrics", normalized(
    _METRIC_SQL, _METRIC_COLS,
    dbl=("field_value",), tss=("ts",), ctes=_METRIC_CTES))
def q_realtime_metrics(spark, sf_dir):
    """The four dashboard measurements as points (flattened)."""
    cl = cleaned(spark, sf_dir)
    newest = cl.agg(F.max("event_time")).scalar()
    hourly = timeseries.hourly_activity(cl).withColumn(
        "event_time", F.to_timestamp("hour_bucket"))
    pop = products.product_popularity(cl).withColumn("event_time", newest)
    users = _labelled_users(spark, sf_dir)
    before = users.select("user_id", (F.dayofweek("first_seen") - 1).alias("segment_id"))
    seg = segmentation.segment_stability(before, users.select("user_id", "segment_id")).withColumn(
        "event_time", newest)
    rec = (recs(spark, sf_dir).filter(F.col("recommended_category_code").isNotNull())
           .groupBy("recommended_category_code").agg(F.count(F.lit(1)).alias("recommendations"))
           .withColumn("event_time", newest))
    pts = [points.to_points(hourly, "user_behavior"), points.to_points(seg, "segment_evolution"),
           points.to_points(rec, "recommendation_metrics"),
           points.to_points(pop, "product_popularity")]
    out = pts[0]
    for p in pts[1:]:
        out = out.unionByName(p)
    return points.flatten_points(out)
