"""Registered profiling, product, index and time-series queries."""

from __future__ import annotations

from cartwheel.functions.columns import (
    WEIGHTS_TRAINING,
    interaction_score,
    popularity_score,
    top_category,
)
from cartwheel.operators import cleaning, indexing, products, profiling, timeseries
from cartwheel.operators import recommend
from cartwheel.plans.catalog import register
from cartwheel.plans.oracle import BASE_CTES, CLEANED_CTES, normalized
from cartwheel.plans.queries_batch import cleaned
from cartwheel.schema import clickstream

# ------------------------------------------------------------------ profiling


@register("table_shape", normalized(
    "SELECT count(*) AS n_rows, CAST(10 AS INTEGER) AS n_columns FROM clickstream",
    ["n_rows", "n_columns"], ctes=BASE_CTES))
def q_table_shape(spark, sf_dir):
    """A1: rows and columns of the raw clickstream."""
    return profiling.table_shape(clickstream(spark, sf_dir))


_DESCRIBE_COLS = ["event_id", "product_id", "price"]
_DESCRIBE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, avg(CAST({c} AS DOUBLE)) AS mean, "
    f"stddev_samp(CAST({c} AS DOUBLE)) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
    f"CAST(max({c}) AS DOUBLE) AS max FROM clickstream" for c in _DESCRIBE_COLS)


@register("describe_numeric", normalized(
    _DESCRIBE_SQL, ['"column"', "count", "mean", "stddev", "min", "max"],
    dbl=("mean", "stddev", "min", "max"), ctes=BASE_CTES))
def q_describe_numeric(spark, sf_dir):
    """A2: count, mean, sample stddev, min, max per numeric column."""
    return profiling.describe_numeric(clickstream(spark, sf_dir), _DESCRIBE_COLS)


_MISSING_COLS = ["event_time", "event_type", "product_id", "category_id", "category_code", "brand",
                 "price", "user_id", "user_session"]
_MISSING_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS missing, "
    f"count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) AS missing_pct FROM clickstream"
    for c in _MISSING_COLS)


@register("missing_values", normalized(
    _MISSING_SQL, ['"column"', "missing", "missing_pct"], dbl=("missing_pct",), ctes=BASE_CTES))
def q_missing_values(spark, sf_dir):
    """A3: NULL count and percentage per column, one aggregation."""
    return profiling.missing_values(clickstream(spark, sf_dir), _MISSING_COLS)


@register("event_type_distribution", normalized(
    "SELECT event_type, count(*) AS count, count(*) * 100.0 / sum(count(*)) OVER () AS share_pct "
    "FROM clickstream GROUP BY event_type",
    ["event_type", "count", "share_pct"], dbl=("share_pct",), ctes=BASE_CTES))
def q_event_type_distribution(spark, sf_dir):
    """A4: rows per event type with share."""
    return profiling.event_type_distribution(clickstream(spark, sf_dir))


def _top_sql(col):
    return (f"SELECT {col}, count(*) AS count FROM clickstream GROUP BY {col} "
            f"ORDER BY count DESC, {col} ASC NULLS FIRST LIMIT 10")


@register("top_categories", normalized(_top_sql("category_code"), ["category_code", "count"],
                                       ctes=BASE_CTES))
def q_top_categories(spark, sf_dir):
    """A5: ten most frequent raw category codes."""
    return profiling.top_categories(clickstream(spark, sf_dir))


@register("top_brands", normalized(_top_sql("brand"), ["brand", "count"], ctes=BASE_CTES))
def q_top_brands(spark, sf_dir):
    """Ten most frequent raw brands."""
    return profiling.top_brands(clickstream(spark, sf_dir))


@register("price_summary", normalized(
    "SELECT min(price) AS min_price, max(price) AS max_price, "
    "quantile_disc(price, 0.5) AS median_price FROM cleaned",
    ["min_price", "max_price", "median_price"], dbl=("min_price", "max_price", "median_price"),
    ctes=CLEANED_CTES))
def q_price_summary(spark, sf_dir):
    """min/max/median price after cleaning (exact median)."""
    return profiling.price_summary(cleaned(spark, sf_dir), exact=True)


@register("price_quartiles", normalized(
    "SELECT quantile_disc(price, 0.25) AS q1, quantile_disc(price, 0.75) AS q3 FROM clickstream",
    ["q1", "q3"], dbl=("q1", "q3"), ctes=BASE_CTES))
def q_price_quartiles(spark, sf_dir):
    """Raw price quartiles (exact, rel_error = 0)."""
    return cleaning.price_quartiles(clickstream(spark, sf_dir), rel_error=0.0)


_TOP_CAT_SQL = ("CASE WHEN category_code IS NULL OR category_code = '' THEN 'unknown' "
                "ELSE split_part(category_code, '.', 1) END")


@register("category_mean_price", normalized(
    f"SELECT {_TOP_CAT_SQL} AS category_code, avg(price) AS avg_cat_price FROM clickstream "
    "GROUP BY 1", ["category_code", "avg_cat_price"], dbl=("avg_cat_price",), ctes=BASE_CTES))
def q_category_mean_price(spark, sf_dir):
    """Mean raw price per top-level category."""
    df = cleaning.with_top_category(clickstream(spark, sf_dir))
    return cleaning.category_stats(df).select("category_code", "avg_cat_price")


@register("brand_first_in_category", normalized(
    "SELECT DISTINCT top_cat AS category_code, first_brand FROM cs_first_brand",
    ["category_code", "first_brand"], ctes=CLEANED_CTES))
def q_brand_first_in_category(spark, sf_dir):
    """Brand of each category's earliest event ('' read as NULL)."""
    df = cleaning.with_top_category(clickstream(spark, sf_dir))
    return cleaning.category_stats(df).select("category_code", "first_brand")


@register("events_by_day", normalized(
    "SELECT CAST(day(event_time) AS INTEGER) AS day, count(*) AS events FROM clickstream GROUP BY 1",
    ["day", "events"], ctes=BASE_CTES))
def q_events_by_day(spark, sf_dir):
    """Events per day of month."""
    return profiling.events_by_day(clickstream(spark, sf_dir))


@register("events_by_hour", normalized(
    "SELECT CAST(hour(event_time) AS INTEGER) AS hour, count(*) AS events FROM clickstream "
    "GROUP BY 1", ["hour", "events"], ctes=BASE_CTES))
def q_events_by_hour(spark, sf_dir):
    """Events per hour of day."""
    return profiling.events_by_hour(clickstream(spark, sf_dir))


@register("price_by_event_type", normalized(
    "SELECT event_type, avg(price) AS mean_price, min(price) AS min_price, max(price) AS max_price,"
    " count(price) AS n_priced FROM clickstream GROUP BY event_type",
    ["event_type", "mean_price", "min_price", "max_price", "n_priced"],
    dbl=("mean_price", "min_price", "max_price"), ctes=BASE_CTES))
def q_price_by_event_type(spark, sf_dir):
    """Price statistics per event type (raw prices)."""
    return profiling.price_by_event_type(clickstream(spark, sf_dir))


@register("session_size_summary", normalized(
    "SELECT count(*) AS sessions, avg(n) AS mean, stddev_samp(n) AS stddev, min(n) AS min, "
    "quantile_cont(n, 0.25) AS p25, quantile_cont(n, 0.5) AS median, "
    "quantile_cont(n, 0.75) AS p75, max(n) AS max FROM (SELECT user_session, count(*) AS n "
    "FROM clickstream WHERE user_session IS NOT NULL GROUP BY user_session) AS s",
    ["sessions", "mean", "stddev", "min", "p25", "median", "p75", "max"],
    dbl=("mean", "stddev", "p25", "median", "p75"), ctes=BASE_CTES))
def q_session_size_summary(spark, sf_dir):
    """Distribution of events per session."""
    return profiling.session_size_summary(clickstream(spark, sf_dir))


@register("session_duration", normalized(
    "SELECT avg(m) AS mean_minutes, quantile_cont(m, 0.5) AS median_minutes, count(*) AS sessions "
    "FROM (SELECT user_session, (epoch_us(max(event_time)) - epoch_us(min(event_time))) / 6.0e7 AS m "
    "FROM clickstream WHERE user_session IS NOT NULL GROUP BY user_session) AS s",
    ["mean_minutes", "median_minutes", "sessions"], dbl=("mean_minutes", "median_minutes"),
    ctes=BASE_CTES))
def q_session_duration(spark, sf_dir):
    """Mean and median session length in minutes."""
    return profiling.session_duration(clickstream(spark, sf_dir), exact=True)


# ------------------------------------------------------------------ products

_POP_AGGS = """count(*) AS total_events,
       count(*) FILTER (WHERE event_type = 'view') AS total_views,
       count(*) FILTER (WHERE event_type = 'cart') AS total_carts,
       count(*) FILTER (WHERE event_type = 'purchase') AS total_purchases,
       count(DISTINCT user_id) AS unique_users,
       avg(price) AS avg_price"""

_POP_COLS = ["product_id", "total_events", "total_views", "total_carts", "total_purchases",
             "unique_users", "avg_price"]


@register("product_popularity", normalized(
    f"SELECT product_id, {_POP_AGGS}, sum(price) AS total_revenue, "
    "sum(CASE WHEN event_type = 'purchase' THEN price END) AS purchase_revenue "
    "FROM cleaned GROUP BY product_id",
    _POP_COLS + ["total_revenue", "purchase_revenue"],
    dbl=("avg_price", "total_revenue", "purchase_revenue"), ctes=CLEANED_CTES))
def q_product_popularity(spark, sf_dir):
    """Per-product popularity."""
    return products.product_popularity(cleaned(spark, sf_dir))


def _mode_sql(col, alias):
    return f"""(SELECT product_id, {col} AS {alias} FROM (
        SELECT product_id, {col}, row_number() OVER (PARTITION BY product_id
               ORDER BY count(*) DESC, {col} ASC) AS rn
        FROM cleaned WHERE {col} IS NOT NULL GROUP BY product_id, {col}) AS m WHERE rn = 1)"""


_META_SQL = f"""
SELECT p.product_id, a.main_category_id, b.main_category_code, c.main_brand
FROM (SELECT DISTINCT product_id FROM cleaned) AS p
LEFT JOIN {_mode_sql('category_id', 'main_category_id')} AS a ON a.product_id = p.product_id
LEFT JOIN {_mode_sql('category_code', 'main_category_code')} AS b ON b.product_id = p.product_id
LEFT JOIN {_mode_sql('brand', 'main_brand')} AS c ON c.product_id = p.product_id
"""


@register("product_metadata", normalized(
    _META_SQL, ["product_id", "main_category_id", "main_category_code", "main_brand"],
    ctes=CLEANED_CTES))
def q_product_metadata(spark, sf_dir):
    """Modal category id/code and brand per product."""
    return products.product_metadata(cleaned(spark, sf_dir))


def _index_sql(key, idx, src="cleaned"):
    return (f"SELECT {key}, CAST(row_number() OVER (ORDER BY count(*) DESC, "
            f"CAST({key} AS VARCHAR) ASC) - 1 AS DOUBLE) AS {idx}, count(*) AS frequency "
            f"FROM {src} WHERE {key} IS NOT NULL GROUP BY {key}")


_PRODUCT_DATA_SQL = f"""
SELECT i.product_idx, m.product_id, m.main_category_id, m.main_category_code, m.main_brand,
       p.avg_price, p.total_events, p.total_views, p.total_carts, p.total_purchases,
       p.unique_users, p.total_revenue
FROM ({_META_SQL}) AS m
JOIN (SELECT product_id, {_POP_AGGS}, sum(price) AS total_revenue FROM cleaned
      GROUP BY product_id) AS p ON p.product_id = m.product_id
JOIN ({_index_sql('product_id', 'product_idx')}) AS i ON i.product_id = m.product_id
"""

PRODUCT_DATA_COLS = ["product_idx", "product_id", "main_category_id", "main_category_code",
                     "main_brand", "avg_price", "total_events", "total_views", "total_carts",
                     "total_purchases", "unique_users", "total_revenue"]


@register("product_data", normalized(
    _PRODUCT_DATA_SQL, PRODUCT_DATA_COLS, dbl=("product_idx", "avg_price", "total_revenue"),
    ctes=CLEANED_CTES))
def q_product_data(spark, sf_dir):
    """The 12-column product table (one aggregation + index)."""
    return products.product_data(cleaned(spark, sf_dir))


@register("product_features", normalized(
    f"""SELECT product_id, {_POP_AGGS},
       arg_min(brand, event_id) AS brand,
       CASE WHEN arg_min(category_code, event_id) IS NULL THEN 'unknown'
            ELSE split_part(arg_min(category_code, event_id), '.', 1) END AS category,
       (count(*) FILTER (WHERE event_type = 'purchase') * 3
        + count(*) FILTER (WHERE event_type = 'cart') * 2
        + count(*) FILTER (WHERE event_type = 'view')) / CAST(count(DISTINCT user_id) AS DOUBLE)
         AS enhanced_popularity_score
    FROM cleaned GROUP BY product_id""",
    _POP_COLS + ["brand", "category", "enhanced_popularity_score"],
    dbl=("avg_price", "enhanced_popularity_score"), ctes=CLEANED_CTES))
def q_product_features(spark, sf_dir):
    """A15 + P13: training-variant product features with popularity score."""
    return products.product_features(cleaned(spark, sf_dir))


@register("popular_products", normalized(
    f"SELECT product_id, total_purchases, avg_price, main_category_code, main_brand "
    f"FROM ({_PRODUCT_DATA_SQL}) AS d ORDER BY total_purchases DESC, product_id ASC LIMIT 10",
    ["product_id", "total_purchases", "avg_price", "main_category_code", "main_brand"],
    dbl=("avg_price",), ctes=CLEANED_CTES))
def q_popular_products(spark, sf_dir):
    """Ten most purchased products."""
    return products.popular_products(products.product_data(cleaned(spark, sf_dir), with_index=False))


# ------------------------------------------------------------------ indices

@register("index_ids", normalized(
    _index_sql("user_id", "user_idx"), ["user_id", "user_idx", "frequency"],
    dbl=("user_idx",), ctes=CLEANED_CTES))
def q_index_ids(spark, sf_dir):
    """M1: dense user index (frequency desc, id text asc)."""
    t = indexing.index_table(cleaned(spark, sf_dir), "user_id", "user_idx")
    return t.select("user_id", "user_idx", "frequency")


@register("recommendation_frame", normalized(
    f"""SELECT c.user_id, u.user_idx, c.product_id, p.product_idx, c.event_type, c.price,
           c.event_time,
           CASE c.event_type WHEN 'view' THEN 1 WHEN 'cart' THEN 5 WHEN 'purchase' THEN 10
                ELSE 0 END AS interaction_score
    FROM cleaned c
    JOIN ({_index_sql('user_id', 'user_idx')}) AS u ON u.user_id = c.user_id
    JOIN ({_index_sql('product_id', 'product_idx')}) AS p ON p.product_id = c.product_id
    WHERE c.event_type IN ('view', 'cart', 'purchase')""",
    ["user_id", "user_idx", "product_id", "product_idx", "event_type", "price", "event_time",
     "interaction_score"], dbl=("user_idx", "product_idx", "price"), tss=("event_time",),
    ctes=CLEANED_CTES))
def q_recommendation_frame(spark, sf_dir):
    """M14 (+ P5, P6 preset A): indexed interactions with implicit score."""
    return products.recommendation_frame(cleaned(spark, sf_dir))


_MATRIX_SQL = f"""
SELECT u.user_idx, p.product_idx,
       CASE WHEN sum(w) > 10 THEN CAST(10.0 AS DOUBLE) ELSE sum(w) END AS rating,
       count(*) AS interaction_count
FROM (SELECT user_id, product_id,
             CASE event_type WHEN 'view' THEN CAST(1.0 AS DOUBLE) WHEN 'cart' THEN CAST(3.0 AS DOUBLE)
                  WHEN 'purchase' THEN CAST(5.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS w
      FROM cleaned WHERE event_type IN ('view', 'cart', 'purchase')) AS c
JOIN ({_index_sql('user_id', 'user_idx')}) AS u ON u.user_id = c.user_id
JOIN ({_index_sql('product_id', 'product_idx')}) AS p ON p.product_id = c.product_id
GROUP BY u.user_idx, p.product_idx
"""


@register("interaction_matrix", normalized(
    _MATRIX_SQL, ["user_idx", "product_idx", "rating", "interaction_count"],
    dbl=("user_idx", "product_idx", "rating"), ctes=CLEANED_CTES))
def q_interaction_matrix(spark, sf_dir):
    """A17 + P12: capped implicit ratings per (user, product), preset B."""
    return recommend.interaction_matrix(cleaned(spark, sf_dir))


@register("interaction_score", normalized(
    """SELECT event_id, CASE event_type WHEN 'view' THEN CAST(1.0 AS DOUBLE)
         WHEN 'cart' THEN CAST(3.0 AS DOUBLE) WHEN 'purchase' THEN CAST(5.0 AS DOUBLE)
         ELSE CAST(0.0 AS DOUBLE) END AS rating FROM clickstream""",
    ["event_id", "rating"], dbl=("rating",), ctes=BASE_CTES))
def q_interaction_score(spark, sf_dir):
    """P6 preset B on every raw event (other types weigh 0)."""
    return clickstream(spark, sf_dir).select(
        "event_id", interaction_score(WEIGHTS_TRAINING).alias("rating"))


@register("keep_interactions", normalized(
    "SELECT event_id, event_type FROM clickstream WHERE event_type IN ('view', 'cart', 'purchase')",
    ["event_id", "event_type"], ctes=BASE_CTES))
def q_keep_interactions(spark, sf_dir):
    """P5: only view/cart/purchase rows."""
    return recommend.keep_interactions(clickstream(spark, sf_dir)).select("event_id", "event_type")


# ------------------------------------------------------------------ time series

_ACT_AGGS = """count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
       count(*) FILTER (WHERE event_type = 'view') AS views,
       count(*) FILTER (WHERE event_type = 'cart') AS carts,
       count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
       count(*) FILTER (WHERE event_type = 'remove_from_cart') AS removes,
       avg(price) AS avg_price"""
_ACT_COLS = ["total_events", "unique_users", "views", "carts", "purchases", "removes", "avg_price"]


@register("hourly_activity", normalized(
    f"SELECT strftime(date_trunc('hour', event_time), '%Y-%m-%d %H:00:00') AS hour_bucket, "
    f"{_ACT_AGGS} FROM cleaned GROUP BY 1", ["hour_bucket"] + _ACT_COLS, dbl=("avg_price",),
    ctes=CLEANED_CTES))
def q_hourly_activity(spark, sf_dir):
    """Hourly activity series."""
    return timeseries.hourly_activity(cleaned(spark, sf_dir))


@register("daily_activity", normalized(
    f"SELECT CAST(event_time AS DATE) AS date, {_ACT_AGGS} FROM cleaned GROUP BY 1",
    ["date"] + _ACT_COLS, dbl=("avg_price",), ctes=CLEANED_CTES))
def q_daily_activity(spark, sf_dir):
    """X11: daily activity series."""
    return timeseries.daily_activity(cleaned(spark, sf_dir))


@register("retention_filter", normalized(
    "SELECT event_id, date FROM cleaned WHERE CAST(event_time AS DATE) >= "
    "(SELECT max(CAST(event_time AS DATE)) FROM cleaned) - 6",
    ["event_id", "date"], ctes=CLEANED_CTES))
def q_retention_filter(spark, sf_dir):
    """Events of the last 7 days."""
    return timeseries.retention_filter(cleaned(spark, sf_dir), 7).select("event_id", "date")


# ------------------------------------------------------------------ row-level parts

@register("time_parts", normalized(
    "SELECT event_id, hour, minute, second, day, month, dayofweek FROM cleaned",
    ["event_id", "hour", "minute", "second", "day", "month", "dayofweek"], ctes=CLEANED_CTES))
def q_time_parts(spark, sf_dir):
    """Integer time parts (Sunday = 1)."""
    return cleaning.time_parts(clickstream(spark, sf_dir)).select(
        "event_id", "hour", "minute", "second", "day", "month", "dayofweek")


@register("date_buckets", normalized(
    "SELECT event_id, date, hour_bucket FROM cleaned", ["event_id", "date", "hour_bucket"],
    ctes=CLEANED_CTES))
def q_date_buckets(spark, sf_dir):
    """Day and hour bucket texts."""
    return cleaning.time_parts(clickstream(spark, sf_dir)).select("event_id", "date", "hour_bucket")


@register("top_category", normalized(
    f"SELECT event_id, {_TOP_CAT_SQL} AS category FROM clickstream", ["event_id", "category"],
    ctes=BASE_CTES))
def q_top_category(spark, sf_dir):
    """Top-level category of every raw event."""
    return clickstream(spark, sf_dir).select("event_id", top_category().alias("category"))


@register("clean_price", normalized(
    "SELECT event_id, price FROM cleaned", ["event_id", "price"], dbl=("price",),
    ctes=CLEANED_CTES))
def q_clean_price(spark, sf_dir):
    """P4 + J1: repaired price of every event."""
    return cleaned(spark, sf_dir).select("event_id", "price")


@register("impute_brand", normalized(
    "SELECT event_id, brand FROM cleaned", ["event_id", "brand"], ctes=CLEANED_CTES))
def q_impute_brand(spark, sf_dir):
    """Imputed brand of every event (policy first_row)."""
    df = cleaning.with_top_category(clickstream(spark, sf_dir))
    return cleaning.impute_brand(df).select("event_id", "brand")


@register("join_category_mean", normalized(
    "SELECT t.event_id, c.avg_cat_price FROM cs_top t JOIN cs_cat c ON c.top_cat = t.top_cat",
    ["event_id", "avg_cat_price"], dbl=("avg_cat_price",), ctes=CLEANED_CTES))
def q_join_category_mean(spark, sf_dir):
    """Each event joined with its category mean (joined by size)."""
    df = cleaning.with_top_category(clickstream(spark, sf_dir))
    stats = cleaning.category_stats(df).select("category_code", "avg_cat_price")
    return df.join(stats, "category_code", "left").select("event_id", "avg_cat_price")


@register("join_product_tables", normalized(
    f"SELECT m.product_id, m.main_brand, p.total_events FROM ({_META_SQL}) AS m "
    f"LEFT JOIN (SELECT product_id, count(*) AS total_events FROM cleaned GROUP BY product_id) AS p "
    f"ON p.product_id = m.product_id", ["product_id", "main_brand", "total_events"],
    ctes=CLEANED_CTES))
def q_join_product_tables(spark, sf_dir):
    """Metadata ⟕ popularity, both grouped by the join key."""
    cl = cleaned(spark, sf_dir)
    popularity = products.product_popularity(cl).select("product_id", "total_events")
    return products.product_metadata(cl).join(popularity, "product_id", "left").select(
        "product_id", "main_brand", "total_events")


@register("describe_cleaned", normalized(
    _DESCRIBE_SQL.replace("FROM clickstream", "FROM cleaned"),
    ['"column"', "count", "mean", "stddev", "min", "max"],
    dbl=("mean", "stddev", "min", "max"), ctes=CLEANED_CTES))
def q_describe_cleaned(spark, sf_dir):
    """A2 after cleaning: the same statistics of the cleaned table."""
    return profiling.describe_numeric(cleaned(spark, sf_dir), _DESCRIBE_COLS)


@register("popularity_score", normalized(
    "SELECT product_id, (count(*) FILTER (WHERE event_type = 'purchase') * 3 "
    "+ count(*) FILTER (WHERE event_type = 'cart') * 2 "
    "+ count(*) FILTER (WHERE event_type = 'view')) / CAST(count(DISTINCT user_id) AS DOUBLE) "
    "AS popularity_score FROM cleaned GROUP BY product_id",
    ["product_id", "popularity_score"], dbl=("popularity_score",), ctes=CLEANED_CTES))
def q_popularity_score(spark, sf_dir):
    """Weighted events per distinct user of every product."""
    p = products.product_popularity(cleaned(spark, sf_dir))
    return p.select("product_id", popularity_score(
        "total_purchases", "total_carts", "total_views", "unique_users").alias("popularity_score"))
