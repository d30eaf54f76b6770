"""Registered batch queries over the driver tables, each with its oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartwheel.functions.columns import cart_abandonment, conversion_rate, rfm_score
from cartwheel.operators import behavior, cleaning
from cartwheel.operators.behavior import bag_text
from cartwheel.plans.catalog import register
from cartwheel.plans.oracle import CLEANED_CTES, normalized
from cartwheel.schema import clickstream


def cleaned(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """Clickstream → cleaned events (lazy), exact quartiles (compared with DuckDB)."""
    kw.setdefault("rel_error", 0.0)
    return cleaning.clean_events(clickstream(spark, sf_dir), **kw)


CLEANED_COLUMNS = [
    "event_id", "event_time", "event_type", "product_id", "category_id", "category_code",
    "brand", "price", "user_id", "user_session", "hour", "minute", "second", "day", "month",
    "dayofweek", "date", "hour_bucket",
]


# --------------------------------------------------------------------- cleaning

@register("clean_events", normalized(
    "SELECT * FROM cleaned", CLEANED_COLUMNS, dbl=("price",), tss=("event_time",),
    ctes=CLEANED_CTES))
def q_clean_events(spark, sf_dir):
    """The full cleaned event table."""
    return cleaned(spark, sf_dir).select(*CLEANED_COLUMNS)


# --------------------------------------------------------------------- behaviour

_UB_SQL = """
SELECT c.user_id,
       count(*) AS nb_events,
       count(*) FILTER (WHERE event_type = 'view') AS nb_views,
       count(*) FILTER (WHERE event_type = 'cart') AS nb_carts,
       count(*) FILTER (WHERE event_type = 'purchase') AS nb_purchases,
       count(*) FILTER (WHERE event_type = 'remove_from_cart') AS nb_removes,
       avg(price) AS avg_price,
       avg(CASE WHEN event_type = 'purchase' THEN price END) AS avg_price_purchased,
       count(DISTINCT user_session) AS nb_sessions,
       min(event_time) AS first_seen,
       max(event_time) AS last_seen,
       CAST(date_diff('day', CAST(max(event_time) AS DATE),
            CAST((SELECT max(event_time) FROM cleaned) AS DATE)) AS INTEGER) AS recency,
       count(DISTINCT CASE WHEN event_type = 'purchase' THEN date END) AS frequency,
       sum(CASE WHEN event_type = 'purchase' THEN price ELSE CAST(0 AS DOUBLE) END) AS monetary,
       count(DISTINCT product_id) AS unique_products,
       count(DISTINCT category_code) AS unique_categories,
       count(DISTINCT brand) AS unique_brands,
       arg_min(category_code, event_id) FILTER (
         WHERE event_type = 'view' AND category_code IS NOT NULL) AS main_category
FROM cleaned c
GROUP BY c.user_id
"""

_BAG_SQL = """
SELECT user_id, string_agg(v || ':' || CAST(n AS VARCHAR), ',' ORDER BY v) AS {name}
FROM (SELECT user_id, CAST({col} AS VARCHAR) AS v, count(*) AS n FROM cleaned
      WHERE event_type = 'view' GROUP BY user_id, {col}) AS x
GROUP BY user_id
"""

_UB_FULL = f"""
SELECT u.*, vc.viewed_categories, vb.viewed_brands,
       CASE WHEN nb_views > 0 THEN nb_purchases / nb_views ELSE CAST(0 AS DOUBLE) END AS conversion_rate,
       CASE WHEN nb_carts > 0 THEN (nb_carts - nb_purchases) / nb_carts ELSE CAST(0 AS DOUBLE) END
         AS cart_abandonment,
       CAST(date_diff('day', CAST(first_seen AS DATE), CAST(last_seen AS DATE)) + 1 AS INTEGER)
         AS engagement_days,
       (100 - recency) * CAST(0.3 AS DOUBLE) + frequency * CAST(0.3 AS DOUBLE)
         + (monetary / 100) * CAST(0.4 AS DOUBLE) AS rfm_score
FROM ({_UB_SQL}) AS u
LEFT JOIN ({_BAG_SQL.format(name='viewed_categories', col='category_code')}) AS vc ON vc.user_id = u.user_id
LEFT JOIN ({_BAG_SQL.format(name='viewed_brands', col='brand')}) AS vb ON vb.user_id = u.user_id
"""

UB_COLUMNS = [
    "user_id", "nb_events", "nb_views", "nb_carts", "nb_purchases", "nb_removes", "avg_price",
    "avg_price_purchased", "nb_sessions", "first_seen", "last_seen", "recency", "frequency",
    "monetary", "unique_products", "unique_categories", "unique_brands", "viewed_categories",
    "viewed_brands", "main_category", "conversion_rate", "cart_abandonment", "engagement_days",
    "rfm_score",
]


@register("user_behavior", normalized(
    _UB_FULL, UB_COLUMNS,
    dbl=("avg_price", "avg_price_purchased", "monetary", "conversion_rate", "cart_abandonment",
         "rfm_score"),
    tss=("first_seen", "last_seen"), ctes=CLEANED_CTES))
def q_user_behavior(spark, sf_dir):
    """A11 flagship: per-user behaviour with RFM score and viewed bags."""
    ub = behavior.user_behavior(cleaned(spark, sf_dir))
    return ub.withColumn("viewed_categories", bag_text("viewed_categories")).withColumn(
        "viewed_brands", bag_text("viewed_brands"))


_UF_SQL = """
SELECT user_id, recency, frequency, monetary, total_events, views, carts, purchases, removes,
       unique_products, unique_categories, unique_brands, avg_price, unique_sessions,
       engagement_days,
       CASE WHEN views > 0 THEN purchases / views ELSE CAST(0 AS DOUBLE) END AS conversion_rate,
       CASE WHEN carts > 0 THEN (carts - purchases) / carts ELSE CAST(0 AS DOUBLE) END
         AS cart_abandonment,
       CASE WHEN unique_sessions > 0 THEN total_events / unique_sessions ELSE CAST(0 AS DOUBLE) END
         AS avg_events_per_session,
       (100 - recency) * CAST(0.3 AS DOUBLE) + frequency * CAST(0.3 AS DOUBLE)
         + (monetary / 100) * CAST(0.4 AS DOUBLE) AS rfm_score
FROM (
  SELECT user_id,
         CAST(date_diff('day', CAST(max(event_time) AS DATE),
              CAST((SELECT max(event_time) FROM cleaned) AS DATE)) AS INTEGER) AS recency,
         count(DISTINCT CAST(event_time AS DATE)) AS frequency,
         sum(CASE WHEN event_type = 'purchase' THEN price ELSE CAST(0 AS DOUBLE) END) AS monetary,
         count(*) AS total_events,
         count(*) FILTER (WHERE event_type = 'view') AS views,
         count(*) FILTER (WHERE event_type = 'cart') AS carts,
         count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
         count(*) FILTER (WHERE event_type = 'remove_from_cart') AS removes,
         count(DISTINCT product_id) AS unique_products,
         count(DISTINCT category_code) AS unique_categories,
         count(DISTINCT brand) AS unique_brands,
         avg(price) AS avg_price,
         count(DISTINCT user_session) AS unique_sessions,
         CAST(date_diff('day', CAST(min(event_time) AS DATE), CAST(max(event_time) AS DATE)) + 1
              AS INTEGER) AS engagement_days
  FROM cleaned GROUP BY user_id) AS f
"""

UF_COLUMNS = [
    "user_id", "recency", "frequency", "monetary", "total_events", "views", "carts", "purchases",
    "removes", "unique_products", "unique_categories", "unique_brands", "avg_price",
    "unique_sessions", "engagement_days", "conversion_rate", "cart_abandonment",
    "avg_events_per_session", "rfm_score",
]


@register("user_features", normalized(
    _UF_SQL, UF_COLUMNS,
    dbl=("monetary", "avg_price", "conversion_rate", "cart_abandonment", "avg_events_per_session",
         "rfm_score"), ctes=CLEANED_CTES))
def q_user_features(spark, sf_dir):
    """Training-variant user features (frequency = active days)."""
    return behavior.user_features(cleaned(spark, sf_dir)).select(*UF_COLUMNS)


# ------------------------------------------------- the flagship's columns on their own

def _flagship(cols):
    dbl = tuple(c for c in cols if c in ("conversion_rate", "cart_abandonment", "rfm_score"))
    return normalized(f"SELECT {', '.join(cols)} FROM ({_UB_FULL}) AS f", cols, dbl=dbl,
                      ctes=CLEANED_CTES)


@register("behavior_rates", _flagship(["user_id", "conversion_rate", "cart_abandonment"]))
def q_behavior_rates(spark, sf_dir):
    """Conversion and cart abandonment rates per user."""
    users = behavior.user_behavior(cleaned(spark, sf_dir), with_lists=False)
    return users.select("user_id", conversion_rate("nb_purchases", "nb_views").alias("conversion_rate"),
                        cart_abandonment("nb_carts", "nb_purchases").alias("cart_abandonment"))


@register("recency_engagement", _flagship(["user_id", "recency", "engagement_days"]))
def q_recency_engagement(spark, sf_dir):
    """Days since the last event, and days between first and last."""
    return behavior.user_behavior(cleaned(spark, sf_dir), with_lists=False).select(
        "user_id", "recency", "engagement_days")


@register("rfm_score", _flagship(["user_id", "rfm_score"]))
def q_rfm_score(spark, sf_dir):
    """P10: the weighted recency, frequency and monetary score."""
    users = behavior.user_behavior(cleaned(spark, sf_dir), with_lists=False)
    return users.select("user_id", rfm_score("recency", "frequency", "monetary").alias("rfm_score"))


@register("first_viewed_category", normalized(
    "SELECT user_id, category_code AS main_category FROM (SELECT user_id, category_code, "
    "row_number() OVER (PARTITION BY user_id ORDER BY event_time, event_id) AS r FROM cleaned "
    "WHERE event_type = 'view') AS v WHERE r = 1", ["user_id", "main_category"], ctes=CLEANED_CTES))
def q_first_viewed_category(spark, sf_dir):
    """Category of every user's earliest view."""
    return behavior.first_viewed_category(cleaned(spark, sf_dir))
