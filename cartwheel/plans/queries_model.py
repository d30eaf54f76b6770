"""Registered recommender, reporting, segmentation and ALS queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cartwheel.functions.sizing import ensure_checkpoint_dir, materialize
from cartwheel.operators import als, behavior, products, recommend, reporting, segmentation
from cartwheel.operators.indexing import index_table
from cartwheel.plans.catalog import register
from cartwheel.plans.oracle import BASE_CTES, CLEANED_CTES, normalized
from cartwheel.plans.queries_batch import cleaned
from cartwheel.plans.queries_profile import _META_SQL, _POP_AGGS
from cartwheel.schema import clickstream
from cartwheel.streaming.files import day_filter

ACTIVITY_COLS = ["user_id", "product_id", "event_type", "category_code", "brand", "price"]


def activity(spark, sf_dir):
    """Raw events as the streaming job sees them (no cleaning)."""
    return clickstream(spark, sf_dir).select(*ACTIVITY_COLS)


def product_table(spark, sf_dir):
    return products.product_data(cleaned(spark, sf_dir), with_index=False)


def recs(spark, sf_dir, fallback="per_user"):
    return recommend.recommend(activity(spark, sf_dir), product_table(spark, sf_dir), fallback)


_REC_CTES = CLEANED_CTES + [f"""
products AS (
  SELECT m.product_id, p.total_purchases, p.avg_price, m.main_category_code, m.main_brand
  FROM ({_META_SQL}) AS m
  JOIN (SELECT product_id, {_POP_AGGS} FROM cleaned GROUP BY product_id) AS p
    ON p.product_id = m.product_id
),
interest AS (
  SELECT user_id,
         CASE WHEN category_code = '' THEN 'unknown' ELSE split_part(category_code, '.', 1) END
           AS main_category,
         count(*) AS category_interest
  FROM clickstream WHERE category_code IS NOT NULL GROUP BY 1, 2
),
top_cats AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY user_id
                   ORDER BY category_interest DESC, main_category ASC) AS INTEGER) AS rank
                 FROM interest) AS t WHERE rank <= 3
),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY main_category_code
                   ORDER BY total_purchases DESC, product_id ASC) AS r
                 FROM products WHERE total_purchases > 0) AS b WHERE r <= 5
),
cands AS (
  SELECT t.user_id, p.product_id, t.category_interest * p.total_purchases / 100 AS rec_score,
         t.main_category AS recommended_category_code, p.main_brand, p.avg_price
  FROM top_cats t JOIN best p ON p.main_category_code = t.main_category
),
affinity AS (
  SELECT user_id, product_id, rec_score, recommended_category_code, main_brand, avg_price,
         'category_affinity' AS recommendation_type
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rec_score DESC, product_id ASC)
          AS r FROM cands) AS x WHERE r <= 5
),
popular AS (
  SELECT product_id, avg_price, main_category_code, main_brand FROM products
  ORDER BY total_purchases DESC, product_id ASC LIMIT 10
),
act_users AS (SELECT DISTINCT user_id FROM clickstream WHERE user_id IS NOT NULL),
all_fallback AS (
  SELECT u.user_id, p.product_id, CAST(0.1 AS DOUBLE) AS rec_score,
         p.main_category_code AS recommended_category_code, p.main_brand, p.avg_price,
         'popular_fallback' AS recommendation_type
  FROM act_users u CROSS JOIN popular p
),
fallback AS (
  SELECT * FROM all_fallback WHERE user_id NOT IN (SELECT user_id FROM affinity)
),
recs AS (SELECT * FROM affinity UNION ALL SELECT * FROM fallback)
"""]

REC_COLS = recommend.REC_COLUMNS


# ------------------------------------------------------------------ recommender

@register("category_interest", normalized(
    "SELECT user_id, main_category, category_interest FROM interest",
    ["user_id", "main_category", "category_interest"], ctes=_REC_CTES))
def q_category_interest(spark, sf_dir):
    """Events per (user, top category), NULL categories left out."""
    return recommend.category_interest(activity(spark, sf_dir))


@register("user_product_interactions", normalized(
    "SELECT user_id, product_id, count(*) AS interaction_count, "
    "count(*) FILTER (WHERE event_type = 'view') AS views, "
    "count(*) FILTER (WHERE event_type = 'cart') AS carts, "
    "count(*) FILTER (WHERE event_type = 'purchase') AS purchases "
    "FROM clickstream GROUP BY user_id, product_id",
    ["user_id", "product_id", "interaction_count", "views", "carts", "purchases"],
    ctes=BASE_CTES))
def q_user_product_interactions(spark, sf_dir):
    """Per (user, product) interactions (off the scoring path)."""
    return recommend.user_product_interactions(activity(spark, sf_dir))


@register("distinct_users", normalized(
    "SELECT DISTINCT user_id FROM clickstream", ["user_id"], ctes=BASE_CTES))
def q_distinct_users(spark, sf_dir):
    """Distinct user keys."""
    return recommend.distinct_users(activity(spark, sf_dir))


@register("top3_categories_per_user", normalized(
    "SELECT user_id, main_category, category_interest, rank FROM top_cats",
    ["user_id", "main_category", "category_interest", "rank"], ctes=_REC_CTES))
def q_top3_categories_per_user(spark, sf_dir):
    """Three categories of highest interest per user."""
    return recommend.top_categories_per_user(recommend.category_interest(activity(spark, sf_dir)))


@register("join_interest_products", normalized(
    "SELECT t.user_id, p.product_id, t.category_interest * p.total_purchases / 100 AS rec_score, "
    "t.main_category AS recommended_category_code, p.main_brand, p.avg_price "
    "FROM top_cats t JOIN products p ON p.main_category_code = t.main_category "
    "WHERE p.total_purchases > 0", ["user_id", "product_id", "rec_score", "recommended_category_code",
                            "main_brand", "avg_price"], dbl=("rec_score", "avg_price"),
    ctes=_REC_CTES))
def q_join_interest_products(spark, sf_dir):
    """J3 + P20: user top categories ⋈ every product that sold, scored."""
    act = activity(spark, sf_dir)
    top = recommend.top_categories_per_user(recommend.category_interest(act))
    sold = product_table(spark, sf_dir).filter(F.col("total_purchases") > 0)
    j = top.join(sold, top["main_category"] == sold["main_category_code"])
    return j.select("user_id", "product_id",
                    (F.col("category_interest") * F.col("total_purchases") / F.lit(100))
                    .alias("rec_score"),
                    F.col("main_category").alias("recommended_category_code"), "main_brand",
                    "avg_price")


@register("top5_recs_per_user", normalized(
    "SELECT * FROM affinity", REC_COLS, dbl=("rec_score", "avg_price"), ctes=_REC_CTES))
def q_top5_recs_per_user(spark, sf_dir):
    """The category-affinity recommendations (five per user)."""
    return recommend.category_affinity(activity(spark, sf_dir), product_table(spark, sf_dir))


@register("recommend_batch", normalized(
    "SELECT * FROM recs", REC_COLS, dbl=("rec_score", "avg_price"), ctes=_REC_CTES))
def q_recommend_batch(spark, sf_dir):
    """R9 + R10: affinity recommendations plus per-user popular fallback."""
    return recs(spark, sf_dir)


# Every session is served like a user: many saw no product with a category.
_SESSION_CTES = _REC_CTES[:-1] + ["sess AS (SELECT * REPLACE (user_session AS user_id) FROM clickstream)",
                                  _REC_CTES[-1].replace("FROM clickstream", "FROM sess")]


@register("recommend_fallback", normalized(
    "SELECT * FROM fallback", REC_COLS, dbl=("rec_score", "avg_price"), ctes=_SESSION_CTES))
def q_recommend_fallback(spark, sf_dir):
    """Popular products for sessions without an affinity match."""
    sessions = clickstream(spark, sf_dir).withColumn("user_id", F.col("user_session")).select(*ACTIVITY_COLS)
    r = recommend.recommend(sessions, product_table(spark, sf_dir))
    return r.filter(F.col("recommendation_type") == recommend.FALLBACK)


@register("cross_users_popular", normalized(
    "SELECT * FROM all_fallback", REC_COLS, dbl=("rec_score", "avg_price"), ctes=_REC_CTES))
def q_cross_users_popular(spark, sf_dir):
    """Every active user × the 10 most purchased products."""
    users = recommend.distinct_users(activity(spark, sf_dir).filter(F.col("user_id").isNotNull()))
    return recommend.popular_fallback(users, product_table(spark, sf_dir))


# ------------------------------------------------------------------ reporting

def _hist_sql(col):
    return f"""
SELECT b.bin, s.lo + (b.bin - 1) * ((s.hi - s.lo) / 50.0) AS lower,
       s.lo + b.bin * ((s.hi - s.lo) / 50.0) AS upper, coalesce(c.n, 0) AS count
FROM (SELECT range AS bin FROM range(1, 51)) AS b
CROSS JOIN (SELECT min({col}) AS lo, max({col}) AS hi FROM recs WHERE {col} IS NOT NULL) AS s
LEFT JOIN (
  SELECT CASE WHEN s2.hi > s2.lo THEN least(CAST(floor((r.{col} - s2.lo) / (s2.hi - s2.lo) * 50.0)
              AS BIGINT) + 1, 50) ELSE 1 END AS bin, count(*) AS n
  FROM recs r CROSS JOIN (SELECT min({col}) AS lo, max({col}) AS hi FROM recs) AS s2
  WHERE r.{col} IS NOT NULL GROUP BY 1) AS c ON c.bin = b.bin
WHERE s.lo IS NOT NULL
"""


@register("score_histogram", normalized(
    _hist_sql("rec_score"), ["bin", "lower", "upper", "count"], dbl=("lower", "upper"),
    ctes=_REC_CTES))
def q_score_histogram(spark, sf_dir):
    """50-bin histogram of recommendation scores."""
    return reporting.score_histogram(recs(spark, sf_dir))


@register("price_histogram", normalized(
    _hist_sql("avg_price"), ["bin", "lower", "upper", "count"], dbl=("lower", "upper"),
    ctes=_REC_CTES))
def q_price_histogram(spark, sf_dir):
    """50-bin histogram of recommended products' mean price."""
    return reporting.price_histogram(recs(spark, sf_dir))


_KDE_SQL = """
SELECT g.i AS point, g.x, sum(d.w * exp(-0.5 * ((g.x - d.v) / g.h) * ((g.x - d.v) / g.h)))
         * 0.3989422804014327 / (g.n * g.h) AS density
FROM (SELECT i, lo + i * ((hi - lo) / 199.0) AS x, h, n
      FROM (SELECT count(*) AS n, min(rec_score) AS lo, max(rec_score) AS hi,
                   stddev_samp(rec_score) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h
            FROM recs WHERE rec_score IS NOT NULL) AS s,
           (SELECT range AS i FROM range(0, 200)) AS r) AS g
CROSS JOIN (SELECT rec_score AS v, count(*) AS w FROM recs WHERE rec_score IS NOT NULL
            GROUP BY rec_score) AS d
GROUP BY g.i, g.x, g.h, g.n
"""


@register("score_density", normalized(
    _KDE_SQL, ["point", "x", "density"], dbl=("x", "density"), ctes=_REC_CTES))
def q_score_density(spark, sf_dir):
    """Gaussian kernel density of scores on a 200-point grid."""
    return reporting.score_density(recs(spark, sf_dir)).select(
        F.col("point").cast("long").alias("point"), "x", "density")


def _top_count_sql(col):
    return (f"SELECT {col}, count(*) AS recommendations FROM recs WHERE {col} IS NOT NULL "
            f"GROUP BY {col} ORDER BY recommendations DESC, {col} ASC LIMIT 10")


@register("top_recommended_categories", normalized(
    _top_count_sql("recommended_category_code"), ["recommended_category_code", "recommendations"],
    ctes=_REC_CTES))
def q_top_recommended_categories(spark, sf_dir):
    """Categories with most recommendations."""
    return reporting.top_recommended_categories(recs(spark, sf_dir))


@register("top_recommended_brands", normalized(
    _top_count_sql("main_brand"), ["main_brand", "recommendations"], ctes=_REC_CTES))
def q_top_recommended_brands(spark, sf_dir):
    """Brands with most recommendations."""
    return reporting.top_recommended_brands(recs(spark, sf_dir))


@register("top_users_by_recs", normalized(
    _top_count_sql("user_id"), ["user_id", "recommendations"], ctes=_REC_CTES))
def q_top_users_by_recs(spark, sf_dir):
    """Users with most recommendations."""
    return reporting.top_users_by_recs(recs(spark, sf_dir))


def _top_mean_sql(col):
    return (f"SELECT {col}, avg(rec_score) AS mean_rec_score FROM recs WHERE {col} IS NOT NULL "
            f"GROUP BY {col} ORDER BY mean_rec_score DESC, {col} ASC LIMIT 10")


@register("mean_score_by_category", normalized(
    _top_mean_sql("recommended_category_code"), ["recommended_category_code", "mean_rec_score"],
    dbl=("mean_rec_score",), ctes=_REC_CTES))
def q_mean_score_by_category(spark, sf_dir):
    """Highest mean score per category."""
    return reporting.mean_score_by_category(recs(spark, sf_dir))


@register("mean_score_by_brand", normalized(
    _top_mean_sql("main_brand"), ["main_brand", "mean_rec_score"], dbl=("mean_rec_score",),
    ctes=_REC_CTES))
def q_mean_score_by_brand(spark, sf_dir):
    """Highest mean score per brand."""
    return reporting.mean_score_by_brand(recs(spark, sf_dir))


@register("score_vs_price", normalized(
    "SELECT count(*) AS n, corr(avg_price, rec_score) AS correlation, "
    "regr_slope(rec_score, avg_price) AS slope, regr_intercept(rec_score, avg_price) AS intercept "
    "FROM recs WHERE avg_price IS NOT NULL AND rec_score IS NOT NULL",
    ["n", "correlation", "slope", "intercept"], dbl=("correlation", "slope", "intercept"),
    ctes=_REC_CTES))
def q_score_vs_price(spark, sf_dir):
    """Correlation and regression line of score on price."""
    return reporting.score_vs_price(recs(spark, sf_dir))


@register("catalog_coverage", normalized(
    "SELECT (SELECT count(DISTINCT product_id) FROM recs) AS recommended_products, "
    "count(DISTINCT product_id) AS catalog_products, "
    "(SELECT count(DISTINCT product_id) FROM recs) * 100.0 / count(DISTINCT product_id) "
    "AS coverage_pct FROM products",
    ["recommended_products", "catalog_products", "coverage_pct"], dbl=("coverage_pct",),
    ctes=_REC_CTES))
def q_catalog_coverage(spark, sf_dir):
    """Share of the catalog that gets recommended."""
    return reporting.catalog_coverage(recs(spark, sf_dir), product_table(spark, sf_dir))


# ------------------------------------------------------------------ segmentation

def _user_features(spark, sf_dir):
    return behavior.user_features(cleaned(spark, sf_dir))


_FEATS = segmentation.FEATURE_COLS
_UF_CTE = [f"""
uf AS (
  SELECT user_id,
         CAST(date_diff('day', CAST(max(event_time) AS DATE),
              CAST((SELECT max(event_time) FROM cleaned) AS DATE)) AS DOUBLE) AS recency,
         CAST(count(DISTINCT CAST(event_time AS DATE)) AS DOUBLE) AS frequency,
         coalesce(sum(CASE WHEN event_type = 'purchase' THEN price ELSE CAST(0 AS DOUBLE) END), 0)
           AS monetary,
         CASE WHEN count(*) FILTER (WHERE event_type = 'view') > 0
              THEN count(*) FILTER (WHERE event_type = 'purchase')
                   / count(*) FILTER (WHERE event_type = 'view') ELSE CAST(0 AS DOUBLE) END
           AS conversion_rate,
         CASE WHEN count(*) FILTER (WHERE event_type = 'cart') > 0
              THEN (count(*) FILTER (WHERE event_type = 'cart')
                    - count(*) FILTER (WHERE event_type = 'purchase'))
                   / count(*) FILTER (WHERE event_type = 'cart') ELSE CAST(0 AS DOUBLE) END
           AS cart_abandonment,
         CAST(count(DISTINCT product_id) AS DOUBLE) AS unique_products,
         CAST(count(DISTINCT category_code) AS DOUBLE) AS unique_categories,
         coalesce(avg(price), 0) AS avg_price
  FROM cleaned GROUP BY user_id
)"""]


@register("features_null_to_zero", normalized(
    "SELECT user_id, " + ", ".join(_FEATS) + " FROM uf", ["user_id"] + _FEATS, dbl=tuple(_FEATS),
    ctes=CLEANED_CTES + _UF_CTE))
def q_features_null_to_zero(spark, sf_dir):
    """The eight clustering features as doubles, NULL → 0."""
    return segmentation.features_null_to_zero(_user_features(spark, sf_dir)).select(
        "user_id", *_FEATS)


@register("assemble_features", normalized(
    "SELECT user_id, " + ", ".join(f"{c} AS f{i}" for i, c in enumerate(_FEATS)) + " FROM uf",
    ["user_id"] + [f"f{i}" for i in range(8)], dbl=tuple(f"f{i}" for i in range(8)),
    ctes=CLEANED_CTES + _UF_CTE))
def q_assemble_features(spark, sf_dir):
    """M2: the assembled feature vector, one column per slot."""
    v = segmentation.assemble_features(_user_features(spark, sf_dir))
    return v.select("user_id", *[F.col("features_raw")[i].alias(f"f{i}") for i in range(8)])


@register("standardize", normalized(
    "SELECT user_id, " + ", ".join(
        f"CASE WHEN stddev_samp({c}) OVER () = 0 THEN CAST(0 AS DOUBLE) "
        f"ELSE ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () END AS f{i}"
        for i, c in enumerate(_FEATS)) + " FROM uf",
    ["user_id"] + [f"f{i}" for i in range(8)], dbl=tuple(f"f{i}" for i in range(8)),
    ctes=CLEANED_CTES + _UF_CTE))
def q_standardize(spark, sf_dir):
    """M3: standardised features (mean 0, sample stddev 1)."""
    v = segmentation.standardize(_user_features(spark, sf_dir))
    return v.select("user_id", *[F.col("features")[i].alias(f"f{i}") for i in range(8)])


@register("silhouette", normalized("""
SELECT avg(CASE WHEN a IS NULL THEN 0.0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1
                ELSE 0.0 END) AS silhouette, count(*) AS points
FROM (
  SELECT vid, max(m) FILTER (WHERE la = lb) AS a, min(m) FILTER (WHERE la <> lb) AS b
  FROM (
    SELECT p.vec_id AS vid, p.label AS la, q.label AS lb,
           avg(pow(list_distance(p.x, q.x), 2)) AS m
    FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL) AS p
    JOIN (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL) AS q ON p.vec_id <> q.vec_id
    GROUP BY 1, 2, 3) AS d
  GROUP BY vid) AS s
""", ["silhouette", "points"], dbl=("silhouette",)))
def q_silhouette(spark, sf_dir):
    """M5: mean silhouette of the embeddings under their given labels."""
    emb = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return segmentation.silhouette(emb, "embedding", "label")


def _labelled_users(spark, sf_dir, ts="last_seen"):
    ub = behavior.user_behavior(cleaned(spark, sf_dir), with_lists=False)
    return ub.withColumn("segment_id", F.dayofweek(ts) - 1)


_UB_LABEL_CTE = ["""
ub AS (
  SELECT user_id,
         CAST(date_diff('day', CAST(max(event_time) AS DATE),
              CAST((SELECT max(event_time) FROM cleaned) AS DATE)) AS INTEGER) AS recency,
         count(DISTINCT CASE WHEN event_type = 'purchase' THEN date END) AS frequency,
         sum(CASE WHEN event_type = 'purchase' THEN price ELSE CAST(0 AS DOUBLE) END) AS monetary,
         CASE WHEN count(*) FILTER (WHERE event_type = 'view') > 0
              THEN count(*) FILTER (WHERE event_type = 'purchase')
                   / count(*) FILTER (WHERE event_type = 'view') ELSE CAST(0 AS DOUBLE) END
           AS conversion_rate,
         CAST(dayofweek(min(event_time)) AS INTEGER) AS first_label,
         CAST(dayofweek(max(event_time)) AS INTEGER) AS segment_id
  FROM cleaned GROUP BY user_id
),
prof AS (
  SELECT segment_id, avg(recency) AS avg_recency, avg(frequency) AS avg_frequency,
         avg(monetary) AS avg_monetary, avg(conversion_rate) AS avg_conversion,
         count(*) AS segment_size
  FROM ub GROUP BY segment_id
),
named AS (
  SELECT *, CASE
    WHEN avg_monetary > 500 AND avg_frequency > 10 AND avg_recency < 30 THEN 'VIP_Customers'
    WHEN avg_frequency > 5 AND avg_recency < 60 THEN 'Loyal_Customers'
    WHEN avg_recency < 30 AND avg_conversion > 0.1 THEN 'Active_Buyers'
    WHEN avg_recency > 60 AND avg_frequency < 3 THEN 'Dormant_Users'
    ELSE 'Casual_Browsers' END AS segment
  FROM prof
)"""]
_PROF_COLS = ["segment_id", "avg_recency", "avg_frequency", "avg_monetary", "avg_conversion",
              "segment_size"]
_PROF_DBL = ("avg_recency", "avg_frequency", "avg_monetary", "avg_conversion")


@register("segment_profile", normalized(
    "SELECT * FROM prof", _PROF_COLS, dbl=_PROF_DBL, ctes=CLEANED_CTES + _UB_LABEL_CTE))
def q_segment_profile(spark, sf_dir):
    """A18 on a given labelling (weekday of the last visit)."""
    return segmentation.segment_profile(_labelled_users(spark, sf_dir))


@register("name_segments", normalized(
    "SELECT * FROM named", _PROF_COLS + ["segment"], dbl=_PROF_DBL,
    ctes=CLEANED_CTES + _UB_LABEL_CTE))
def q_name_segments(spark, sf_dir):
    """The naming cascade on segment means."""
    return segmentation.name_segments(segmentation.segment_profile(_labelled_users(spark, sf_dir)))


@register("attach_segment_name", normalized(
    "SELECT u.user_id, u.segment_id, n.segment FROM ub u LEFT JOIN named n "
    "ON n.segment_id = u.segment_id", ["user_id", "segment_id", "segment"],
    ctes=CLEANED_CTES + _UB_LABEL_CTE))
def q_attach_segment_name(spark, sf_dir):
    """Segment names joined back to users (joined by size)."""
    users = _labelled_users(spark, sf_dir)
    names = segmentation.name_segments(segmentation.segment_profile(users))
    return segmentation.attach_segment_name(users, names).select("user_id", "segment_id", "segment")


@register("segment_stability", normalized(
    "SELECT count(*) AS users, count(*) FILTER (WHERE first_label <> segment_id) AS changed, "
    "count(*) FILTER (WHERE first_label <> segment_id) * 100.0 / count(*) AS changed_pct FROM ub",
    ["users", "changed", "changed_pct"], dbl=("changed_pct",), ctes=CLEANED_CTES + _UB_LABEL_CTE))
def q_segment_stability(spark, sf_dir):
    """Share of users whose label changed between two labellings
    (weekday of first visit → weekday of last visit)."""
    users = _labelled_users(spark, sf_dir)
    before = users.select("user_id", (F.dayofweek("first_seen") - 1).alias("segment_id"))
    return segmentation.segment_stability(before, users.select("user_id", "segment_id"))


@register("segment_transitions", normalized(
    "SELECT first_label AS from_segment, segment_id AS to_segment, count(*) AS users "
    "FROM ub GROUP BY 1, 2", ["from_segment", "to_segment", "users"],
    ctes=CLEANED_CTES + _UB_LABEL_CTE))
def q_segment_transitions(spark, sf_dir):
    """Transition matrix between the two labellings."""
    users = _labelled_users(spark, sf_dir)
    before = users.select("user_id", (F.dayofweek("first_seen") - 1).alias("segment_id"))
    return segmentation.segment_transitions(before, users.select("user_id", "segment_id"))


def _period_features(spark, sf_dir, lo, hi):
    return behavior.user_features(cleaned(spark, sf_dir).filter(day_filter(lo, hi)))


@register("segment_stability_matched", normalized(
    "SELECT count(DISTINCT user_id) AS users, CAST(0 AS BIGINT) AS changed, CAST(0 AS DOUBLE) AS changed_pct "
    "FROM cleaned WHERE day(event_time) BETWEEN 1 AND 15 AND user_id IS NOT NULL",
    ["users", "changed", "changed_pct"], dbl=("changed_pct",), ctes=CLEANED_CTES))
def q_segment_stability_matched(spark, sf_dir):
    """X10 on K-means segments: a run whose segments are numbered otherwise
    is matched to the stored run by its centres; no user changes segment."""
    model, seg = segmentation.fit_segments(_period_features(spark, sf_dir, 1, 15))
    stored, centers = seg.select("user_id", "segment_id"), segmentation.centers_of(model)
    k = len(centers)
    other = stored.withColumn("segment_id", F.pmod(F.col("segment_id") * 2 + 3, F.lit(k)))
    moved = [None] * k
    for i, c in enumerate(centers):
        moved[(2 * i + 3) % k] = c
    again = segmentation.relabel(other, segmentation.match_centers(centers, moved))
    return segmentation.segment_stability(stored, again)


@register("segment_refit", normalized(
    "SELECT DISTINCT user_id, true AS nearest, true AS settled FROM cleaned "
    "WHERE day(event_time) BETWEEN 16 AND 31", ["user_id", "nearest", "settled"], ctes=CLEANED_CTES))
def q_segment_refit(spark, sf_dir):
    """M4/M7 (property): the segments of days 16-31, continued from those of
    days 1-15: each user's is the nearest centre, and centres are the means of
    their users (Lloyd's fixed point)."""
    model, _ = segmentation.fit_segments(_period_features(spark, sf_dir, 1, 15))
    users = _period_features(spark, sf_dir, 16, 31)
    centers, seg = segmentation.refit_segments(model, users, max_iter=100, tol=1e-6)
    scaled = model.stages[1].transform(model.stages[0].transform(seg)).withColumn("x", vector_to_array("features"))
    width = len(centers[0])
    means = scaled.groupBy("segment_id").agg(F.array(*[F.avg(F.col("x")[j]) for j in range(width)]).alias("m"))
    table = F.array(*[F.array(*[F.lit(v) for v in c]) for c in centers])
    gap = F.aggregate(F.zip_with("m", F.get(table, F.col("segment_id")), lambda a, b: F.abs(a - b)), F.lit(0.0),
                      lambda s, v: s + v)
    settled = means.select("segment_id", (gap < 1e-3).alias("settled"))
    return scaled.join(settled, "segment_id").select(
        "user_id", (segmentation.nearest_center(F.col("x"), centers) == F.col("segment_id")).alias("nearest"),
        "settled")


@register("kmeans_segments", normalized(
    "SELECT DISTINCT user_id, true AS nearest FROM cleaned", ["user_id", "nearest"],
    ctes=CLEANED_CTES))
def q_kmeans_segments(spark, sf_dir):
    """M4 (property): each user's segment is its nearest K-means centre."""
    model, seg = segmentation.fit_segments(_user_features(spark, sf_dir))
    return segmentation.nearest_center_check(model, seg).select("user_id", "nearest")


@register("segment_users", normalized(
    "SELECT DISTINCT user_id, true AS named_by_profile FROM cleaned",
    ["user_id", "named_by_profile"], ctes=CLEANED_CTES))
def q_segment_users(spark, sf_dir):
    """M6 (property): every user has a K-means segment whose name follows
    from the means of its users."""
    _, out = segmentation.segment_users(_user_features(spark, sf_dir))
    again = segmentation.name_segments(segmentation.segment_profile(out.drop("segment")))
    names = again.select("segment_id", F.col("segment").alias("expected"))
    return out.join(names, "segment_id", "left").select(
        "user_id", F.col("segment").eqNullSafe(F.col("expected")).alias("named_by_profile"))


@register("classify_new_users", normalized(
    "SELECT DISTINCT user_id, true AS same_segment FROM cleaned", ["user_id", "same_segment"],
    ctes=CLEANED_CTES))
def q_classify_new_users(spark, sf_dir):
    """M7 + S13: save the fitted pipeline, load it, classify users again;
    ``same_segment`` must be true for every user."""
    import uuid
    from pyspark.ml import PipelineModel
    users = _user_features(spark, sf_dir)
    model, seg = segmentation.fit_segments(users)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/models-{uuid.uuid4().hex}/kmeans"
    model.write().overwrite().save(path)
    again = segmentation.classify_new_users(PipelineModel.load(path), users)
    j = seg.select("user_id", "segment_id").join(
        again.select("user_id", F.col("segment_id").alias("reloaded")), "user_id")
    return j.select("user_id", (F.col("segment_id") == F.col("reloaded")).alias("same_segment"))


# ------------------------------------------------------------------ ALS

def _matrix_with_ids(spark, sf_dir):
    cl = cleaned(spark, sf_dir)
    users = index_table(cl, "user_id", "user_idx")
    prods = index_table(cl, "product_id", "product_idx")
    m = recommend.interaction_matrix(cl, users=users, prods=prods, keep_ids=True)
    return materialize(m), users, prods


_SPLIT_SQL = (
    "SELECT user_id, product_id, CAST('0x' || substr(md5('42|' || user_id || '|' || "
    "CAST(product_id AS VARCHAR)), 1, 8) AS UBIGINT) / 4294967296.0 < 0.8 AS is_train "
    "FROM (SELECT DISTINCT user_id, product_id FROM cleaned "
    "WHERE event_type IN ('view', 'cart', 'purchase')) AS p")
_SPLIT_CTES = CLEANED_CTES + [f"split AS ({_SPLIT_SQL})"]
_TRAINED = "(SELECT count(DISTINCT product_id) FROM split WHERE is_train)"


@register("train_test_split", normalized(
    _SPLIT_SQL,
    ["user_id", "product_id", "is_train"], ctes=CLEANED_CTES))
def q_train_test_split(spark, sf_dir):
    """M8: deterministic hash split of (user, product) pairs, 80/20."""
    pairs = recommend.keep_interactions(cleaned(spark, sf_dir)).select(
        "user_id", "product_id").distinct()
    return als.split_flags(pairs, ("user_id", "product_id")).select(
        "user_id", "product_id", "is_train")


def _fit(spark, sf_dir):
    m, users, prods = _matrix_with_ids(spark, sf_dir)
    train, test = als.train_test_split(m)
    return als.fit_als(train), m, test, users, prods


def _user_of(df, users, idx):
    """The original user of an index column."""
    names = users.select("user_id", F.col("user_idx").cast("int").alias("_idx"))
    return df.join(names, df[idx] == names["_idx"], "left").drop("_idx")


@register("als_fit", normalized(
    "SELECT DISTINCT user_id, CAST(50 AS INTEGER) AS rank, true AS non_negative FROM split "
    "WHERE is_train", ["user_id", "rank", "non_negative"], ctes=_SPLIT_CTES))
def q_als_fit(spark, sf_dir):
    """M9 (property): one non-negative factor vector of rank 50 per trained user."""
    model, _, _, users, _ = _fit(spark, sf_dir)
    return _user_of(model.userFactors, users, "id").select(
        "user_id", F.size("features").alias("rank"),
        F.forall("features", lambda v: v >= 0).alias("non_negative"))


@register("als_rmse", normalized(
    "SELECT count(*) AS n_test, true AS as_evaluated, true AS in_range FROM split WHERE NOT is_train "
    "AND user_id IN (SELECT user_id FROM split WHERE is_train) "
    "AND product_id IN (SELECT product_id FROM split WHERE is_train)",
    ["n_test", "as_evaluated", "in_range"], ctes=_SPLIT_CTES))
def q_als_rmse(spark, sf_dir):
    """The held-out pairs of known users and products; their RMSE is that
    of MLlib's evaluator and lies between 0 and the rating cap."""
    model, _, test, _, _ = _fit(spark, sf_dir)
    pred = materialize(als.predictions(model, test))
    return als.rmse_frame(pred).select(
        "n_test", (F.abs(F.col("rmse") - F.lit(als.rmse(pred))) < 1e-9).alias("as_evaluated"),
        ((F.col("rmse") > 0) & (F.col("rmse") <= recommend.RATING_CAP)).alias("in_range"))


@register("als_top_n", normalized(
    f"SELECT DISTINCT user_id, CAST(least(10, {_TRAINED}) AS INTEGER) AS n_items, "
    "true AS no_repeats, true AS descending FROM split WHERE is_train",
    ["user_id", "n_items", "no_repeats", "descending"], ctes=_SPLIT_CTES))
def q_als_top_n(spark, sf_dir):
    """M11 (property): 10 distinct products per trained user, scores descending."""
    model, m, _, users, _ = _fit(spark, sf_dir)
    return _user_of(als.top_n_properties(als.top_n(model, m)), users, "user_idx").select(
        "user_id", "n_items", "no_repeats", "descending")


@register("als_top_n_pruned", normalized(
    f"SELECT DISTINCT user_id, least(10, {_TRAINED}) AS n_items, true AS agrees FROM split WHERE is_train",
    ["user_id", "n_items", "agrees"], ctes=_SPLIT_CTES))
def q_als_top_n_pruned(spark, sf_dir):
    """The 10 best products per user by pruned inner products have the
    scores, place by place, of MLlib's cross product."""
    model, m, _, users, _ = _fit(spark, sf_dir)
    full = als.top_n(model, m).select("user_idx", F.posexplode("recommendations").alias("_p", "_r")).select(
        "user_idx", (F.col("_p") + 1).alias("rank"), F.col("_r.rating").cast("double").alias("want"))
    got = als.top_n_pruned(model, m, block_items=64)
    both = full.join(got, ["user_idx", "rank"], "full_outer")
    near = F.coalesce(F.abs(F.col("score") - F.col("want")) <= 1e-4, F.lit(False))
    return _user_of(both.groupBy("user_idx").agg(F.count("score").alias("n_items"), F.bool_and(near).alias("agrees")),
                    users, "user_idx").select("user_id", "n_items", "agrees")


@register("recs_to_ids", normalized(
    f"SELECT DISTINCT user_id, least(10, {_TRAINED}) AS n_recs, "
    f"CAST(least(10, {_TRAINED}) AS INTEGER) AS last_rank, true AS known FROM split WHERE is_train",
    ["user_id", "n_recs", "last_rank", "known"], ctes=_SPLIT_CTES))
def q_recs_to_ids(spark, sf_dir):
    """M12 (property): every ALS recommendation has its original ids back."""
    model, m, _, users, prods = _fit(spark, sf_dir)
    flat = als.recs_to_ids(als.top_n(model, m), users, prods)
    return flat.groupBy("user_id").agg(
        F.count_distinct("product_id").alias("n_recs"), F.max("rank").alias("last_rank"),
        F.bool_and(F.col("product_id").isNotNull()).alias("known"))

