"""Profiling aggregates.

Each profile is ONE aggregation over the table (the reference ran two jobs
per column for missing values); wide results are turned into long form by
exploding a small array of structs built from the one-row aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions.quantiles import exact_quantiles, quantiles

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def _long_form(one_row: DataFrame, items: list[Column]) -> DataFrame:
    return one_row.select(F.explode(F.array(*items)).alias("s")).select("s.*")


def table_shape(df: DataFrame) -> DataFrame:
    """A1: row and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns"))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A2: count, mean, sample stddev, min, max per numeric column (long form)."""
    cols = list(columns) if columns is not None else numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"mean{i}"),
                 F.stddev_samp(x).alias(f"sd{i}"), F.min(x).alias(f"min{i}"),
                 F.max(x).alias(f"max{i}")]
    one = df.agg(*aggs)
    items = [
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
                 F.col(f"mean{i}").alias("mean"), F.col(f"sd{i}").alias("stddev"),
                 F.col(f"min{i}").alias("min"), F.col(f"max{i}").alias("max"))
        for i, c in enumerate(cols)
    ]
    return _long_form(one, items)


def missing_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A3: per column NULL count and percentage, in one aggregation."""
    cols = list(columns) if columns is not None else df.columns
    aggs = [F.count(F.lit(1)).alias("_n")] + [
        F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)]
    one = df.agg(*aggs)
    items = [
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing"),
                 F.try_divide(F.col(f"m{i}") * 100.0, F.col("_n")).alias("missing_pct"))
        for i, c in enumerate(cols)
    ]
    return _long_form(one, items)


def value_distribution(df: DataFrame, col: str) -> DataFrame:
    """Rows per value with its percentage share (A4 for ``event_type``).

    The share window runs over the grouped rows only (one per value).
    """
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return g.select(col, "count", (F.col("count") * 100.0 / total).alias("share_pct"))


def event_type_distribution(df: DataFrame) -> DataFrame:
    """A4: rows per event type, with percentage share."""
    return value_distribution(df, "event_type")


def top_values(df: DataFrame, col: str, k: int = 10) -> DataFrame:
    """The ``k`` most frequent values (NULL is a group); ties by value."""
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return g.orderBy(F.desc("count"), F.asc_nulls_first(col)).limit(k)


def top_categories(df: DataFrame, k: int = 10) -> DataFrame:
    return top_values(df, "category_code", k)


def top_brands(df: DataFrame, k: int = 10) -> DataFrame:
    return top_values(df, "brand", k)


def price_summary(cleaned: DataFrame, exact: bool = False, accuracy: int = 10000) -> DataFrame:
    """Min, max and median price after cleaning."""
    median = quantiles(cleaned, "price", [0.5], 0.0 if exact else 1.0 / accuracy).scalar()
    return cleaned.agg(F.min("price").alias("min_price"), F.max("price").alias("max_price")).select(
        "min_price", "max_price", median[0].alias("median_price"))


def events_by(df: DataFrame, part: Column, name: str) -> DataFrame:
    return df.groupBy(part.alias(name)).agg(F.count(F.lit(1)).alias("events"))


def events_by_day(df: DataFrame) -> DataFrame:
    """Rows per day of month."""
    return events_by(df, F.dayofmonth("event_time"), "day")


def events_by_hour(df: DataFrame) -> DataFrame:
    """Rows per hour of day."""
    return events_by(df, F.hour("event_time"), "hour")


def price_by_event_type(df: DataFrame) -> DataFrame:
    """Mean, min, max and non-null count of price per event type."""
    return df.groupBy("event_type").agg(
        F.avg("price").alias("mean_price"), F.min("price").alias("min_price"),
        F.max("price").alias("max_price"), F.count("price").alias("n_priced"))


def session_sizes(df: DataFrame, session: str = "user_session") -> DataFrame:
    """Events per session (sessions with a NULL key are left out)."""
    return df.filter(F.col(session).isNotNull()).groupBy(session).agg(
        F.count(F.lit(1)).alias("n_events"))


def session_size_summary(df: DataFrame, session: str = "user_session") -> DataFrame:
    """Count, mean, sample stddev, min, quartiles (interpolated), max."""
    s = session_sizes(df, session)
    n = F.col("n_events")
    return s.agg(
        F.count(F.lit(1)).alias("sessions"), F.avg(n).alias("mean"),
        F.stddev_samp(n).alias("stddev"), F.min(n).alias("min"),
        F.percentile(n, 0.25).alias("p25"), F.percentile(n, 0.5).alias("median"),
        F.percentile(n, 0.75).alias("p75"), F.max(n).alias("max"))


def session_duration(df: DataFrame, session: str = "user_session", exact: bool = False,
                     accuracy: int = 10000) -> DataFrame:
    """Mean and median session length in minutes (last - first event).

    The median is the mean of the two middle lengths (``exact``), else the
    sketch of the given accuracy.
    """
    per = df.filter(F.col(session).isNotNull()).groupBy(session).agg(
        ((F.unix_micros(F.max("event_time")) - F.unix_micros(F.min("event_time"))) / 6.0e7)
        .alias("minutes"))
    if exact:
        low = exact_quantiles(per, "minutes", [0.5]).scalar()[0]
        # the value above the middle: the lower middle of the negated lengths
        high = -exact_quantiles(per.select((-F.col("minutes")).alias("minutes")), "minutes",
                                [0.5]).scalar()[0]
        median = (low + high) / 2
    else:
        median = quantiles(per, "minutes", [0.5], 1.0 / accuracy).scalar()[0]
    return per.agg(F.avg("minutes").alias("mean_minutes"), F.count(F.lit(1)).alias("sessions")).select(
        "mean_minutes", median.alias("median_minutes"), "sessions")


def top_viewed(df: DataFrame, col: str = "product_id", k: int = 10) -> DataFrame:
    """The ``k`` most viewed values of ``col`` (ties by value)."""
    v = df.filter(F.col("event_type") == F.lit("view")).filter(F.col(col).isNotNull())
    g = v.groupBy(col).agg(F.count(F.lit(1)).alias("views"))
    return g.orderBy(F.desc("views"), F.asc(col)).limit(k)
