"""Activity time series (A16 hourly, X11 daily) and the retention filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.functions.columns import count_type
from cartwheel.operators.cleaning import hour_bucket_text
from cartwheel.schema import CART, PURCHASE, REMOVE, VIEW


def _activity_aggs(exact: bool = True) -> list[Column]:
    cd = F.count_distinct if exact else F.approx_count_distinct
    return [
        F.count(F.lit(1)).alias("total_events"),
        cd("user_id").alias("unique_users"),
        count_type(VIEW).alias("views"),
        count_type(CART).alias("carts"),
        count_type(PURCHASE).alias("purchases"),
        count_type(REMOVE).alias("removes"),
        F.avg("price").alias("avg_price"),
    ]


def activity(df: DataFrame, bucket: Column, name: str, exact: bool = True) -> DataFrame:
    """Per time bucket: events, unique users, per-type counts, mean price."""
    return df.groupBy(bucket.alias(name)).agg(*_activity_aggs(exact)).orderBy(name)


def hourly_activity(cleaned: DataFrame, exact: bool = True) -> DataFrame:
    """Keyed by the text bucket ``yyyy-MM-dd HH:00:00`` (as written)."""
    bucket = hour_bucket_text(F.col("event_time"))
    return activity(cleaned, bucket, "hour_bucket", exact)


def daily_activity(cleaned: DataFrame, exact: bool = True) -> DataFrame:
    """X11: the same measures per day."""
    return activity(cleaned, F.to_date("event_time"), "date", exact)


def retention_filter(df: DataFrame, days: int = 30, date_col: str = "date",
                     ts: str = "event_time") -> DataFrame:
    """Keep the last ``days`` days before the newest event.

    On the cleaned table written partitioned by ``date`` the filter on the
    partition column prunes whole folders.
    """
    newest = df.agg(F.max(F.to_date(ts)).alias("d")).scalar()
    start = F.date_sub(newest, days - 1)
    if date_col in df.columns:
        return df.filter(F.col(date_col) >= F.date_format(start, "yyyy-MM-dd"))
    return df.filter(F.to_date(ts) >= start)
