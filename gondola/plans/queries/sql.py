"""Shared pieces of the SQL twins (DuckDB dialect)."""

from __future__ import annotations

PLANOGRAM = """retail AS (
  SELECT s.month_key, p.p_partkey AS product_id, p.p_name AS name, p.p_type AS category,
         concat(p.p_brand, '-', CAST(floor(p.p_partkey / 2000) AS BIGINT)) AS rack_id,
         (p.p_retailprice - 900e0) / 10e0 AS price_numeric,
         CAST(20 + p.p_partkey % 31 AS DOUBLE) AS profit_margin_percentage,
         s.sales AS estimated_monthly_sales,
         CAST(p.p_size AS DOUBLE) AS product_width_cm,
         CAST(1 + (p.p_partkey * 7919) % 7 AS INTEGER) AS shelf_level
  FROM (SELECT l_partkey, strftime(l_shipdate, '%Y_%m') AS month_key,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sales
        FROM lineitem GROUP BY 1, 2) s
  JOIN part p ON p.p_partkey = s.l_partkey)"""


def half_up(x: str, places: int) -> str:
    return f"(floor(({x}) * 1e{places} + 0.50001e0) / 1e{places})"


def uniform(seed, *keys: str) -> str:
    text = " || '|' || ".join([f"'{seed}'"] + [f"CAST({k} AS VARCHAR)" for k in keys])
    return f"(CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) / 4294967296e0)"


def mult(s: str) -> str:
    return (f"(CASE WHEN {s} IN (1, 2) THEN 0.7e0 WHEN {s} IN (3, 4, 5) THEN 1.2e0 "
            f"WHEN {s} IN (6, 7) THEN 0.8e0 ELSE 1e0 END)")


def crowd(n: str) -> str:
    return f"(CASE WHEN {n} > 5 THEN greatest(0.5e0, 1e0 - 0.05e0 * ({n} - 5)) ELSE 1e0 END)"


def dim(s: str, w: str) -> str:
    return (f"(CASE WHEN {s} IN (3, 4, 5) AND ({w}) / 300e0 > 0.6e0 "
            f"THEN greatest(0.7e0, 1e0 - 0.5e0 * (({w}) / 300e0 - 0.6e0)) ELSE 1e0 END)")


def tier(p: str, s: str) -> str:
    return (f"(CASE WHEN {p} > 5e0 AND {s} IN (3, 4, 5) THEN 1.1e0 "
            f"WHEN {p} < 2e0 AND {s} IN (1, 2) THEN 1.15e0 "
            f"WHEN {p} > 5e0 AND {s} IN (1, 2) THEN 0.85e0 ELSE 1e0 END)")


def spread(n: str) -> str:
    return f"(1e0 + 0.15e0 * (({n}) / 7e0))"


BASE = "(price_numeric * (profit_margin_percentage / 100e0) * estimated_monthly_sales)"


def rack_profit_cte(source: str, keys: str, name: str = "profits") -> str:
    """Row-wise rack profit with windows, a different route from the operator's."""
    return f"""{name}_rows AS (
  SELECT *, count(*) OVER (PARTITION BY {keys}, shelf_level) AS n_on,
         sum(product_width_cm) OVER (PARTITION BY {keys}, shelf_level) AS w_on
  FROM {source}),
{name} AS (
  SELECT {keys}, count(*) AS n_products, count(DISTINCT shelf_level) AS n_shelves_used,
         {spread('count(DISTINCT shelf_level)')} * sum({BASE} * {mult('shelf_level')}
           * {crowd('n_on')} * {dim('shelf_level', 'w_on')}
           * {tier('price_numeric', 'shelf_level')}) AS profit
  FROM {name}_rows GROUP BY {keys})"""


def query(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body
