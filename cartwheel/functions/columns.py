"""Column expressions shared by the operators (all JVM-side built-ins)."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartwheel.schema import CART, PURCHASE, VIEW

# Implicit-feedback weights of the two presets (view, cart,
# purchase; any other type weighs 0).
WEIGHTS_PREPROCESS = {VIEW: 1, CART: 5, PURCHASE: 10}
WEIGHTS_TRAINING = {VIEW: 1.0, CART: 3.0, PURCHASE: 5.0}

# RFM composite = (100 - recency)*0.3 + frequency*0.3 + monetary/100*0.4
RFM_RECENCY_BASE = 100
RFM_WEIGHTS = (0.3, 0.3, 0.4)
RFM_MONETARY_SCALE = 100

# popularity = (3*purchases + 2*carts + views) / unique users
POPULARITY_WEIGHTS = (3, 2, 1)


def c(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


def is_type(event_type: str, col: str | Column = "event_type") -> Column:
    return c(col) == F.lit(event_type)


def count_type(event_type: str, col: str | Column = "event_type") -> Column:
    """Rows of one event type inside an aggregation (bigint)."""
    return F.count_if(is_type(event_type, col))


def top_category(col: str | Column = "category_code", unknown: str = "unknown") -> Column:
    """NULL or '' → ``unknown``; otherwise the text before the first dot."""
    x = c(col)
    return F.when(x.isNull() | (x == F.lit("")), F.lit(unknown)).otherwise(
        F.substring_index(x, ".", 1)
    )


def interaction_score(weights: Mapping[str, float], col: str | Column = "event_type") -> Column:
    """Weight of each event type; unknown types weigh 0."""
    items = list(weights.items())
    zero = F.lit(0.0) if any(isinstance(w, float) for _, w in items) else F.lit(0)
    expr = None
    for t, w in items:
        expr = (F.when if expr is None else expr.when)(is_type(t, col), F.lit(w))
    return expr.otherwise(zero) if expr is not None else zero


def safe_ratio(num: Column, den: Column) -> Column:
    """num/den when den > 0 else 0 (raw ratio, never clamped: hazard H11)."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def conversion_rate(purchases: str | Column, views: str | Column) -> Column:
    return safe_ratio(c(purchases), c(views))


def cart_abandonment(carts: str | Column, purchases: str | Column) -> Column:
    return safe_ratio(c(carts) - c(purchases), c(carts))


def rfm_score(recency: str | Column, frequency: str | Column, monetary: str | Column) -> Column:
    wr, wf, wm = RFM_WEIGHTS
    return (
        (F.lit(RFM_RECENCY_BASE) - c(recency)) * F.lit(wr)
        + c(frequency) * F.lit(wf)
        + (c(monetary) / F.lit(RFM_MONETARY_SCALE)) * F.lit(wm)
    )


def popularity_score(purchases: str | Column, carts: str | Column, views: str | Column,
                     users: str | Column) -> Column:
    wp, wc, wv = POPULARITY_WEIGHTS
    num = c(purchases) * wp + c(carts) * wc + c(views) * wv
    return F.try_divide(num.cast("double"), c(users).cast("double"))


# Fixed-width order key: (event time, event id) packed into one decimal(38,0)
# = micros * 10^20 + (event_id + 2^63). A NULL time sorts first, as in an
# ascending window order. Unlike a struct, a decimal is a mutable field of
# Spark's aggregation buffer, so min(key) stays in a hash aggregation.
_ID_SHIFT = 2 ** 63
_TIME_SCALE = 10 ** 20
_NULL_TIME = -(10 ** 17)


def _dec(v: int) -> Column:
    return F.lit(Decimal(v)).cast("decimal(38,0)")


def order_key(ts: str = "event_time", key: str = "event_id") -> Column:
    """(time, key) packed into one ``decimal(38,0)``, ordered like the pair."""
    micros = F.coalesce(F.unix_micros(F.col(ts)), F.lit(_NULL_TIME)).cast("decimal(38,0)")
    shifted = (F.col(key).cast("decimal(38,0)") + _dec(_ID_SHIFT)).cast("decimal(38,0)")
    return (micros * _dec(_TIME_SCALE) + shifted).cast("decimal(38,0)")


def earliest_values(df, keys, value: str | Column, name: str, where: Column | None = None,
                    extra=(), skip_null_values: bool = False):
    """Per ``keys``: the ``value`` of the earliest row (optionally among rows
    matching ``where``), as a DataFrame ``keys..., name``.

    Two aggregations: min(order key) per (keys, value) — a hash aggregation
    combined map-side, so a hot group never sits in one task — then, over
    that small table, the value with the smallest key. ``extra`` adds
    aggregate columns computed on the (keys, value) level, as
    ``(level1_column, level2_function)`` pairs keyed by output name.
    ``skip_null_values`` takes the earliest non-NULL value instead.
    """
    src = df if where is None else df.filter(where)
    v = c(value).alias("_v")
    lvl1 = [F.min(order_key()).alias("_k")] + [e[0].alias(f"_{n}") for n, e in dict(extra).items()]
    pairs = src.groupBy(*keys, v).agg(*lvl1)
    # the group's row with the smallest key: one struct per group as buffer
    item = F.struct(F.col("_k"), F.col("_v"))
    if skip_null_values:
        item = F.when(F.col("_v").isNotNull(), item)
    lvl2 = [F.min(item)["_v"].alias(name)] + [e[1](F.col(f"_{n}")).alias(n)
                                              for n, e in dict(extra).items()]
    return pairs.groupBy(*keys).agg(*lvl2)


# Offset of the quantisation boundary used for result comparison. Averages of
# cent amounts are often exact decimals ending in 5 one digit past the kept
# ones, where summation order decides the side of a half-up rounding; a
# boundary at 0.3765433 units (not a short decimal or dyadic fraction) is
# never hit by such values.
COMPARE_OFFSET = 0.6234567


def round_half_up(col: str | Column, digits: int = 6) -> Column:
    """Quantise to ``digits`` decimals with plain IEEE arithmetic (the same
    formula is used by the oracle SQL), boundary moved off the half point."""
    scale = float(10 ** digits)
    x = c(col).cast("double")
    return F.when(F.abs(x) < 1e9, F.floor(x * scale + COMPARE_OFFSET) / scale).otherwise(
        x).cast("double")


def ts_text(col: str | Column) -> Column:
    """Timestamp as fixed-width text (for result comparison)."""
    return F.date_format(c(col), "yyyy-MM-dd HH:mm:ss.SSSSSS")

