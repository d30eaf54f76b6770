"""DuckDB twins of the Spark plans, used as the correctness oracle.

Each oracle query is ``WITH <shared CTEs> <query>``. Results are compared
after the same normalisation on both sides: doubles quantised to 6 decimals
with plain IEEE arithmetic (boundary off the half point), timestamps as
fixed-width text.
"""

from __future__ import annotations

from cartwheel.schema import CLICKSTREAM_SQL

CTE_CLICKSTREAM = f"clickstream AS ({CLICKSTREAM_SQL})"

# Cleaned events with exact quartiles (rel_error = 0 on the Spark side).
CTE_CLEANED = """
cs_top AS (
  SELECT *, CASE WHEN category_code IS NULL OR category_code = '' THEN 'unknown'
                 ELSE split_part(category_code, '.', 1) END AS top_cat
  FROM clickstream
),
cs_bounds AS (
  SELECT quantile_disc(price, 0.25) AS q1, quantile_disc(price, 0.75) AS q3 FROM clickstream
),
cs_first_brand AS (
  SELECT DISTINCT top_cat,
         first_value(nullif(brand, '')) OVER (
           PARTITION BY top_cat ORDER BY event_time, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_brand
  FROM cs_top
),
cs_cat AS (
  SELECT top_cat, avg(price) AS avg_cat_price FROM cs_top GROUP BY top_cat
),
cleaned AS (
  SELECT t.event_id, t.event_time, t.event_type, t.product_id, t.category_id,
         t.top_cat AS category_code,
         CASE WHEN t.brand IS NULL OR t.brand = '' THEN coalesce(f.first_brand, 'generic')
              ELSE t.brand END AS brand,
         CASE WHEN t.price IS NULL OR t.price <= 0 THEN c.avg_cat_price
              WHEN b.q1 IS NULL OR b.q3 IS NULL THEN t.price
              WHEN t.price >= b.q1 * CAST(0.1 AS DOUBLE) AND t.price <= b.q3 * CAST(10.0 AS DOUBLE)
                THEN t.price
              ELSE c.avg_cat_price END AS price,
         t.user_id, t.user_session,
         CAST(hour(t.event_time) AS INTEGER) AS hour,
         CAST(minute(t.event_time) AS INTEGER) AS minute,
         CAST(second(t.event_time) AS INTEGER) AS second,
         CAST(day(t.event_time) AS INTEGER) AS day,
         CAST(month(t.event_time) AS INTEGER) AS month,
         CAST(dayofweek(t.event_time) + 1 AS INTEGER) AS dayofweek,
         strftime(t.event_time, '%Y-%m-%d') AS date,
         strftime(t.event_time, '%Y-%m-%d %H:00:00') AS hour_bucket
  FROM cs_top t
  JOIN cs_cat c ON c.top_cat = t.top_cat
  JOIN cs_first_brand f ON f.top_cat = t.top_cat
  CROSS JOIN cs_bounds b
)
"""

BASE_CTES = [CTE_CLICKSTREAM]
CLEANED_CTES = [CTE_CLICKSTREAM, CTE_CLEANED]


def r6(expr: str) -> str:
    """Quantisation to 6 decimals, identical to ``round_half_up``."""
    x = f"CAST({expr} AS DOUBLE)"
    return (f"CAST(CASE WHEN abs({x}) < 1e9 THEN floor({x} * 1000000.0 + 0.6234567) / 1000000.0 "
            f"ELSE {x} END AS DOUBLE)")


def ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def with_ctes(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


def normalized(inner: str, columns: list[str], dbl: tuple[str, ...] = (), tss: tuple[str, ...] = (),
               ctes: list[str] | None = None) -> str:
    """``SELECT`` the listed columns of ``inner`` with the comparison normalisation."""
    sel = []
    for col in columns:
        if col in dbl:
            sel.append(f"{r6(col)} AS {col}")
        elif col in tss:
            sel.append(f"{ts(col)} AS {col}")
        else:
            sel.append(col)
    body = f"SELECT {', '.join(sel)} FROM ({inner}) AS q"
    return with_ctes(ctes, body) if ctes else body
