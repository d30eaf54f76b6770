"""Registry of checked queries: name → (Spark builder, DuckDB oracle SQL).

Every builder takes ``(spark, sf_dir)``, reads the driver tables of that
folder and returns a lazy DataFrame whose doubles/timestamps are normalised
the same way as its oracle (see ``plans.oracle``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions.columns import round_half_up, ts_text

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Check:
    name: str
    build: Builder
    sql: str | None


REGISTRY: dict[str, Check] = {}


def normalize(df: DataFrame) -> DataFrame:
    """Round doubles/floats to 6 decimals half-up, timestamps to text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(round_half_up(F.col(f.name)).alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(ts_text(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None, raw: bool = False):
    """Decorator: add a builder to the registry (normalised unless ``raw``)."""

    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")

        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = fn(spark, sf_dir)
            return df if raw else normalize(df)

        build.__name__ = fn.__name__
        build.__doc__ = fn.__doc__
        REGISTRY[name] = Check(name, build, sql)
        return fn

    return deco


def queries() -> dict[str, Builder]:
    _load()
    return {k: v.build for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: v.sql for k, v in REGISTRY.items() if v.sql is not None}


def _load() -> None:
    # Importing the query modules fills the registry.
    from cartwheel.plans import (  # noqa: F401
        queries_batch,
        queries_model,
        queries_profile,
        queries_spec,
        queries_stream,
    )
