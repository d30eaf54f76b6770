"""Rows → time-series points (measurement, time, tags, fields).

The original sent every row through the driver to a time-series database.
Here the conversion is one projection: numeric columns become ``fields``
(map<string,double>), the time column becomes ``ts``, every other column
becomes a string ``tag``; NULL values are left out of both maps. The points
are written by a normal distributed sink (Parquet/JSON), from where any
loader can ship them; no network client runs inside Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def _entries(df: DataFrame, cols: list[str], cast: str):
    items = [F.struct(F.lit(c).alias("key"), F.col(c).cast(cast).alias("value")) for c in cols]
    arr = F.array(*items) if items else F.array().cast(
        T.ArrayType(T.StructType([T.StructField("key", T.StringType()),
                                  T.StructField("value", T.StringType() if cast == "string"
                                                else T.DoubleType())])))
    return F.map_from_entries(F.filter(arr, lambda e: e["value"].isNotNull()))


def to_points(df: DataFrame, measurement: str, time_col: str | None = "event_time",
              default_time=None) -> DataFrame:
    """One point per row: ``measurement, ts, tags, fields``.

    ``default_time`` (a Column) is used when the row has no time column
    (e.g. the end of the aggregation window, hazard H17).
    """
    num, txt = [], []
    for f in df.schema.fields:
        if f.name == time_col:
            continue
        if isinstance(f.dataType, NUMERIC):
            num.append(f.name)
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            continue
        else:
            txt.append(f.name)
    if time_col and time_col in df.columns:
        ts = F.col(time_col).cast("timestamp")
    elif default_time is not None:
        ts = default_time
    else:
        ts = F.current_timestamp()
    return df.select(F.lit(measurement).alias("measurement"), ts.alias("ts"),
                     _entries(df, txt, "string").alias("tags"),
                     _entries(df, num, "double").alias("fields"))


def flatten_points(points: DataFrame) -> DataFrame:
    """Long form ``measurement, ts, kind, key, tag_value, field_value``."""
    tags = points.select("measurement", "ts", F.lit("tag").alias("kind"),
                         F.explode("tags").alias("key", "tag_value")).withColumn(
        "field_value", F.lit(None).cast("double"))
    fields = points.select("measurement", "ts", F.lit("field").alias("kind"),
                           F.explode("fields").alias("key", "field_value")).withColumn(
        "tag_value", F.lit(None).cast("string"))
    return tags.unionByName(fields)
