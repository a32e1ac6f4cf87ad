"""Price text, seasonal rules, enrichment, sampling, forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ... import rules
from ...functions import demand as D
from ...functions.numbers import half_up
from ...functions.prices import is_eur, parse_eur
from ...functions.stock import month_number
from ...operators import enrich as E, forecast as FC, knowledge as KB, rule_tables as RT
from ...session import shared_dir, written
from ...sources import readers
from .. import tables as T
from . import sql as S

_MONTHS = E.month_keys(2025)


def _monthly(spark, d):
    """The catalogue in every month of 2025."""
    months = F.explode(F.array(*[F.lit(m) for m in _MONTHS]))
    return T.catalog(spark, d).withColumn("month_key", months)


def _seasons(spark, d):
    m = month_number("month_key")
    return _monthly(spark, d).select(
        "product_id", "month_key",
        D.seasonal_multiplier("category", m, rules.SEASONAL_GENERATION).alias("generation"),
        D.seasonal_multiplier("category", m, rules.SEASONAL_FORECAST).alias("forecast"))


def _bands(spark, d):
    return (T.catalog(spark, d)
            .withColumn("b", D.category_band("category", rules.BANDS_GENERATION))
            .withColumn("s", D.category_band("category", rules.BANDS_SIMPLE))
            .select("product_id", "b.m_lo", "b.m_hi", "b.w_lo", "b.w_hi",
                    F.col("s.m_lo").alias("simple_m_lo"), F.col("s.w_hi").alias("simple_w_hi")))


def _rules_of_parts(spark, d):
    """A rule for every part: a piece of some product name, for one month of the year.

    Some hundred patterns are shared by several rules, and every twentieth rule is a default.
    """
    k = F.col("p_partkey")
    piece = F.upper(F.substring(F.col("p_name"), (1 + k % 3).cast("int"), (2 + k % 6).cast("int")))
    return T.table(spark, d, "part").select(
        (1 + k % 13).cast("int").alias("month"), (k * 7919 % 10007).alias("priority"),
        F.when(k % 20 != 0, piece).alias("pattern"), (0.5 + k % 40 / 20).alias("multiplier"))


def _rule_table(spark, d):
    """The first rule of every product and month, by its name and type."""
    rows = T.planogram(spark, d).select(
        "month_key", "product_id", F.concat_ws(" ", "category", "name").alias("title"),
        F.substring("month_key", 6, 2).cast("int").alias("month"))
    return RT.with_first_rule(rows, _rules_of_parts(spark, d), "title", ["month"]).select(
        "month_key", "product_id", "multiplier", "priority")


def _constants_as_tables(spark, d):
    """Season and band of every product and month, with the constants as rule tables."""
    rows = _monthly(spark, d).select("product_id", "month_key", "category",
                                     month_number("month_key").alias("month"))
    seasons = RT.with_first_rule(rows, RT.seasonal_rules(spark, rules.SEASONAL_GENERATION),
                                 "category", ["month"]).drop("priority")
    return RT.with_first_rule(seasons, RT.band_rules(spark, rules.BANDS_GENERATION), "category",
                              missing="nan").select(
        "product_id", "month_key", "multiplier", "m_lo", "m_hi", "w_lo", "w_hi")


_EST = ["estimated_monthly_sales", "profit_margin_percentage", "product_width_cm"]


def _placed(spark, d):
    rows = E.sample_months(T.catalog(spark, d), _MONTHS)
    return written(E.assign_shelf(E.assign_rack(E.enrich_heuristic(rows))).select(
        "month_key", "product_id", *_EST, "rack_id", "shelf_level"))


def _file_order(spark, d):
    """Racks by first appearance in CSV files whose order is not that of any key."""
    path = shared_dir(spark)
    k = F.col("product_id")
    catalog = T.catalog(spark, d).select(
        F.col("category").alias("Category"), "name", k.cast("string").alias("subtitle"),
        "price", F.lit(None).cast("string").alias("discount_price"))
    shuffled = catalog.orderBy((F.col("subtitle").cast("bigint") * 7919) % 2003, "subtitle")
    shuffled.write.option("header", True).option("maxRecordsPerFile", 300).csv(path)
    rows = readers.read_catalog(spark, path).withColumnRenamed("Category", "category")
    return E.assign_rack(rows, part=(), order="row_order").select(
        F.col("subtitle").cast("bigint").alias("product_id"), "category", "row_order", "rack_id")


def _gaps(spark, d):
    """The planogram with sales that are missing (0 or NULL) in a third of its rows."""
    sales = F.col("estimated_monthly_sales")
    k = F.col("product_id") % 6
    return T.planogram(spark, d).withColumn("estimated_monthly_sales", F.when(k == 0, F.lit(0))
                                            .when(k == 3, F.lit(None)).otherwise(sales))


def _base(spark, d):
    """Sampled, enriched rows of 2025 as the base of a forecast, drawn and written once."""
    rows = E.enrich_heuristic(E.sample_months(T.catalog(spark, d), _MONTHS))
    return written(E.assign_rack(rows).select(
        "month_key", "product_id", "category", "rack_id", "estimated_monthly_sales"))


def _forecasted(base):
    return FC.apply_forecast(base, FC.forecast(base, 12))


def _effect(spark, d):
    base = _base(spark, d)
    return FC.forecast_effect(base, _forecasted(base)).select(
        half_up("avg_sales_before", 4).alias("avg_sales_before"),
        half_up("avg_sales_after", 4).alias("avg_sales_after"), "n_products", "n_racks")


QUERIES = {
    "p1_parse_eur": lambda s, d: T.catalog(s, d).select(
        "product_id", parse_eur("price").alias("value"), is_eur("price").alias("is_price")),
    "p9_j2_seasonal_multiplier": _seasons,
    "p10_category_band": _bands,
    "j2_rule_table": _rule_table,
    "j2_constants_as_tables": _constants_as_tables,
    "p11_base_sales": lambda s, d: T.catalog(s, d).select(
        "product_id", D.base_sales("price_numeric").alias("base_sales")),
    "p12_enrich_heuristic": lambda s, d: E.enrich_heuristic(_monthly(s, d)).select(
        "product_id", "month_key", *_EST),
    "p13_enrich_simple": lambda s, d: E.enrich_simple(T.catalog(s, d)).select("product_id", *_EST),
    "p14_j1_assign_rack": lambda s, d: E.assign_rack(T.planogram(s, d).drop("rack_id")).select(
        "month_key", "product_id", "category", "rack_id"),
    "p14_file_order": _file_order,
    "p15_assign_shelf": lambda s, d: E.assign_shelf(T.planogram(s, d)).select(
        "month_key", "product_id", "shelf_level"),
    "p31_fill_estimates": lambda s, d: E.fill_estimates(_gaps(s, d)).select(
        "month_key", "product_id", *_EST),
    "u4_sample_months": lambda s, d: E.sample_months(T.catalog(s, d), _MONTHS).select(
        "month_key", "product_id"),
    "u1_enriched_months": _placed,
    "job_generate_months": lambda s, d: E.generate_months(T.catalog(s, d), _MONTHS).select(
        "month_key", "product_id", *_EST, "rack_id", "shelf_level"),
    "r7_forecast_multipliers": lambda s, d: FC.forecast(
        KB.latest_month(_monthly(s, d)), 7),
    "p16_apply_forecast": lambda s, d: _forecasted(_base(s, d)).select(
        "month_key", "product_id", "estimated_monthly_sales"),
    "t3_top_adjustments": lambda s, d: FC.top_adjustments(FC.forecast(_monthly(s, d), 12)),
    "g26_forecast_effect": _effect,
}

_WORDS = "[" + ", ".join(f"'{w}'" for w in T.CATEGORY_WORDS) + "]"
CATALOG = f"""catalog AS (
  SELECT product_id, category, name, price_numeric, form, cents,
         CASE form WHEN 0 THEN euros || ' €' WHEN 1 THEN '1.' || euros || ' €'
                   WHEN 2 THEN euros || chr(160) || '€' WHEN 3 THEN '  ' ELSE name || ' €' END AS price
  FROM (SELECT p_partkey AS product_id, {_WORDS}[CAST(p_partkey % 12 AS INTEGER) + 1] AS category,
               p_name AS name, (p_retailprice - 900e0) / 10e0 AS price_numeric, p_size % 5 AS form,
               CAST(round(p_retailprice * 100) AS BIGINT) AS cents,
               CAST(cents // 100 AS VARCHAR) || ',' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS euros
        FROM part) t)"""
_MONTHLY = f"""monthly AS (
  SELECT catalog.*, month_key, CAST(substr(month_key, 6, 2) AS INTEGER) AS month
  FROM catalog CROSS JOIN (SELECT unnest({_MONTHS}) AS month_key) m)"""


def _rule_rows(table: dict) -> str:
    return ", ".join(f"({m}, {i}, '{p}', {float(x)}e0)" for m, t in table.items()
                     for i, (p, x) in enumerate(t.items()))


def _season_ctes(name: str, table: dict, source: str) -> str:
    """Rule rows joined by substring; the lowest priority wins, then the default."""
    return f"""{name}_rules AS (SELECT * FROM (VALUES {_rule_rows(table)}) v(month, priority, pattern, mult)),
{name} AS (
  SELECT c.category, c.month, coalesce(
           arg_min(r.mult, r.priority) FILTER (r.pattern <> 'default' AND contains(lower(c.category), r.pattern)),
           max(r.mult) FILTER (r.pattern = 'default'), 1e0) AS mult
  FROM (SELECT DISTINCT category, month FROM {source}) c LEFT JOIN {name}_rules r USING (month)
  GROUP BY 1, 2)"""


def _band_ctes(name: str, bands, source: str) -> str:
    rows = ", ".join(f"({i}, {list(b.patterns) or ['']}, {b.margin[0]}e0, {b.margin[1]}e0, "
                     f"{b.width[0]}e0, {b.width[1]}e0)" for i, b in enumerate(bands))
    return f"""{name}_rules AS (SELECT * FROM (VALUES {rows}) v(priority, patterns, m_lo, m_hi, w_lo, w_hi)),
{name} AS (
  SELECT c.category, r.* FROM (SELECT DISTINCT category FROM {source}) c
  JOIN {name}_rules r ON len(list_filter(r.patterns, lambda p: contains(lower(c.category), p))) > 0
  QUALIFY row_number() OVER (PARTITION BY c.category ORDER BY r.priority) = 1)"""


_GEN = ("season", rules.SEASONAL_GENERATION)


def _heuristic(source: str, *keys: str) -> str:
    """SELECT list of the three estimates over ``source`` joined to season and band."""
    def u(tag: str) -> str:
        return S.uniform(f"42{tag}", *keys)

    base = "greatest(10, CAST(trunc(300e0 / (price_numeric + 0.1e0)) AS INTEGER))"
    noisy = f"trunc({base} * (0.7e0 + 0.6e0 * {u('s')}))"
    margin = S.half_up(f"m_lo + (m_hi - m_lo) * {u('m')}", 1)
    width = S.half_up(f"w_lo + (w_hi - w_lo) * {u('w')}", 1)
    return f"""greatest(1, CAST(trunc({noisy} * mult) AS INTEGER)) AS estimated_monthly_sales,
  {S.half_up(f"{margin} * (0.95e0 + 0.1e0 * {u('x')})", 1)} AS profit_margin_percentage,
  {width} AS product_width_cm"""


_SIMPLE_BASE = "greatest(10, CAST(trunc(300e0 / (price_numeric + 0.1e0)) AS INTEGER))"
_SAMPLED = f"""quotas AS (
  SELECT month_key, greatest(10, CAST(trunc((SELECT count(*) FROM catalog) *
           (0.6e0 + (0.9e0 - 0.6e0) * {S.uniform('42m', 'month_key')})) AS BIGINT)) AS n_keep
  FROM (SELECT DISTINCT month_key FROM monthly) m),
sampled AS (
  SELECT monthly.* FROM monthly JOIN quotas USING (month_key)
  QUALIFY row_number() OVER (PARTITION BY month_key
    ORDER BY {S.uniform('42k', 'month_key', 'product_id')}, product_id) <= any_value(n_keep) OVER (PARTITION BY month_key))"""
_ENRICHED = f"""enriched AS (
  SELECT month_key, product_id, category, {_heuristic('sampled', 'month_key', 'product_id')}
  FROM sampled JOIN season USING (category, month) JOIN band USING (category))"""
_RACKED = """racked AS (
  SELECT e.*, rack_id FROM enriched e JOIN (
    SELECT month_key, category,
           CAST(row_number() OVER (PARTITION BY month_key ORDER BY min(product_id)) - 1 AS INTEGER) AS rack_id
    FROM enriched GROUP BY 1, 2) r USING (month_key, category))"""
_GEN_CTES = (CATALOG, _MONTHLY, _season_ctes("season", rules.SEASONAL_GENERATION, "monthly"),
             _band_ctes("band", rules.BANDS_GENERATION, "catalog"))
_DEC = _season_ctes("december", rules.SEASONAL_FORECAST, "(SELECT category, 12 AS month FROM catalog)")
_SHELF = f"1 + CAST(floor({S.uniform('42f', 'month_key', 'product_id')} * 7) AS INTEGER)"
_DIRECTION = "CASE WHEN mult > 1 THEN 'UP' WHEN mult < 1 THEN 'DOWN' ELSE '--' END"
_NEW_SALES = ("greatest(1, CAST(trunc(estimated_monthly_sales * mult) AS BIGINT))")


def _generated() -> str:
    from .layouts import _REPAIR_ITEMS, _REPAIR_START, _SHIFT, _WORST_CHOICE, _recursive, _steps
    wide = f"wide AS (SELECT *, {_SHELF} AS shelf_level FROM racked)"
    return _recursive(
        "SELECT month_key, product_id, estimated_monthly_sales, profit_margin_percentage, "
        "product_width_cm, rack_id, new_shelf AS shelf_level "
        "FROM wide JOIN steps USING (month_key, rack_id, product_id)",
        *_GEN_CTES, _SAMPLED, _ENRICHED, _RACKED, wide, _REPAIR_ITEMS,
        _steps(_WORST_CHOICE, _REPAIR_START, _SHIFT))


ORACLES = {
    "job_generate_months": _generated(),
    "p1_parse_eur": S.query("""SELECT product_id,
  CASE form WHEN 0 THEN cents / 100e0 WHEN 1 THEN (100000 + cents) / 100e0
            WHEN 2 THEN cents / 100e0 ELSE 0e0 END AS value, form < 3 AS is_price
FROM catalog""", CATALOG),
    "p9_j2_seasonal_multiplier": S.query(
        "SELECT product_id, month_key, g.mult AS generation, f.mult AS forecast FROM monthly "
        "JOIN season g USING (category, month) JOIN later f USING (category, month)",
        CATALOG, _MONTHLY, _season_ctes("season", rules.SEASONAL_GENERATION, "monthly"),
        _season_ctes("later", rules.SEASONAL_FORECAST, "monthly")),
    "p10_category_band": S.query(
        "SELECT product_id, b.m_lo, b.m_hi, b.w_lo, b.w_hi, s.m_lo AS simple_m_lo, "
        "s.w_hi AS simple_w_hi FROM catalog JOIN band b USING (category) "
        "JOIN simple s USING (category)",
        CATALOG, _band_ctes("band", rules.BANDS_GENERATION, "catalog"),
        _band_ctes("simple", rules.BANDS_SIMPLE, "catalog")),
    "j2_rule_table": S.query("""SELECT r.month_key, r.product_id,
  coalesce(f.multiplier, e.multiplier) AS multiplier, coalesce(f.priority, e.priority) AS priority
FROM rows r LEFT JOIN found f USING (title, month) LEFT JOIN defaults e USING (month)""",
        S.PLANOGRAM, """rules AS (
  SELECT CAST(1 + p_partkey % 13 AS INTEGER) AS month, p_partkey * 7919 % 10007 AS priority,
         CASE WHEN p_partkey % 20 <> 0 THEN lower(substr(
           p_name, CAST(1 + p_partkey % 3 AS BIGINT), CAST(2 + p_partkey % 6 AS BIGINT))) END AS pattern,
         0.5e0 + (p_partkey % 40) / 20e0 AS multiplier FROM part),
rows AS (
  SELECT month_key, product_id, category || ' ' || name AS title,
         CAST(substr(month_key, 6, 2) AS INTEGER) AS month FROM retail),
found AS (
  SELECT title, month, arg_min(multiplier, (priority, pattern, multiplier)) AS multiplier,
         min(priority) AS priority
  FROM (SELECT DISTINCT title, month FROM rows) t JOIN rules USING (month)
  WHERE pattern <> '' AND contains(lower(title), pattern) GROUP BY 1, 2),
defaults AS (
  SELECT month, arg_min(multiplier, (priority, multiplier)) AS multiplier, min(priority) AS priority
  FROM rules WHERE coalesce(pattern, '') = '' GROUP BY 1)"""),
    "j2_constants_as_tables": S.query(
        "SELECT product_id, month_key, s.mult AS multiplier, b.m_lo, b.m_hi, b.w_lo, b.w_hi "
        "FROM monthly JOIN season s USING (category, month) JOIN band b USING (category)", *_GEN_CTES),
    "p11_base_sales": S.query(f"SELECT product_id, {_SIMPLE_BASE} AS base_sales FROM catalog", CATALOG),
    "p12_enrich_heuristic": S.query(
        f"SELECT product_id, month_key, {_heuristic('monthly', 'month_key', 'product_id')} "
        "FROM monthly JOIN season USING (category, month) JOIN band USING (category)", *_GEN_CTES),
    "p13_enrich_simple": S.query(f"""SELECT product_id,
  CAST(lo + floor({S.uniform('42s', 'product_id')} * (base + 50 - lo)) AS INTEGER) AS estimated_monthly_sales,
  {S.half_up(f"m_lo + (m_hi - m_lo) * {S.uniform('42m', 'product_id')}", 1)} AS profit_margin_percentage,
  {S.half_up(f"w_lo + (w_hi - w_lo) * {S.uniform('42w', 'product_id')}", 1)} AS product_width_cm
FROM (SELECT *, {_SIMPLE_BASE} AS base, greatest(1, base - 20) AS lo FROM catalog) c
JOIN simple USING (category)""", CATALOG, _band_ctes("simple", rules.BANDS_SIMPLE, "catalog")),
    "p14_j1_assign_rack": S.query("""SELECT month_key, product_id, category,
  CAST(dense_rank() OVER (PARTITION BY month_key ORDER BY first) - 1 AS INTEGER) AS rack_id
FROM (SELECT *, min(product_id) OVER (PARTITION BY month_key, category) AS first FROM retail) t""",
                                  S.PLANOGRAM),
    "p14_file_order": """SELECT product_id, category, row_order,
  CAST(dense_rank() OVER (ORDER BY first) - 1 AS INTEGER) AS rack_id
FROM (SELECT *, min(row_order) OVER (PARTITION BY category) AS first
      FROM (SELECT p_partkey AS product_id, row_number() OVER (
                     ORDER BY (p_partkey * 7919) % 2003, CAST(p_partkey AS VARCHAR)) AS row_order,
                   [""" + ", ".join(f"'{w}'" for w in T.CATEGORY_WORDS) + """][CAST(p_partkey % 12 AS INTEGER) + 1] AS category
            FROM part) p) t""",
    "p15_assign_shelf": S.query(
        f"SELECT month_key, product_id, {_SHELF} AS shelf_level FROM retail", S.PLANOGRAM),
    "p31_fill_estimates": S.query(f"""SELECT month_key, product_id,
  CASE WHEN gap THEN h.estimated_monthly_sales ELSE r.estimated_monthly_sales END AS estimated_monthly_sales,
  CASE WHEN gap THEN h.profit_margin_percentage ELSE r.profit_margin_percentage END AS profit_margin_percentage,
  CASE WHEN gap THEN h.product_width_cm ELSE r.product_width_cm END AS product_width_cm
FROM (SELECT *, product_id % 6 IN (0, 3) AS gap FROM retail) r JOIN (
  SELECT month_key, product_id, {_heuristic('r', 'month_key', 'product_id')}
  FROM (SELECT *, CAST(substr(month_key, 6, 2) AS INTEGER) AS month FROM retail) r
  JOIN season USING (category, month) JOIN band USING (category)) h USING (month_key, product_id)""",
        S.PLANOGRAM,
        _season_ctes("season", rules.SEASONAL_GENERATION,
                     "(SELECT category, CAST(substr(month_key, 6, 2) AS INTEGER) AS month FROM retail)"),
        _band_ctes("band", rules.BANDS_GENERATION, "retail")),
    "u4_sample_months": S.query("SELECT month_key, product_id FROM sampled",
                                CATALOG, _MONTHLY, _SAMPLED),
    "u1_enriched_months": S.query(f"""SELECT month_key, product_id, estimated_monthly_sales,
  profit_margin_percentage, product_width_cm, rack_id, {_SHELF} AS shelf_level FROM racked""",
                                  *_GEN_CTES, _SAMPLED, _ENRICHED, _RACKED),
    "r7_forecast_multipliers": S.query(
        "SELECT category, mult AS multiplier FROM july", CATALOG,
        _season_ctes("july", rules.SEASONAL_FORECAST, "(SELECT category, 7 AS month FROM catalog)")),
    "p16_apply_forecast": S.query(
        f"SELECT month_key, product_id, {_NEW_SALES} AS estimated_monthly_sales "
        "FROM racked JOIN december USING (category)",
        *_GEN_CTES, _SAMPLED, _ENRICHED, _RACKED, _DEC),
    "t3_top_adjustments": S.query(
        f"SELECT category, mult AS multiplier, {_DIRECTION} AS direction FROM december "
        "ORDER BY abs(mult - 1e0) DESC, category LIMIT 10", CATALOG, _DEC),
    "g26_forecast_effect": S.query(f"""SELECT
  {S.half_up('avg(estimated_monthly_sales)', 4)} AS avg_sales_before,
  {S.half_up(f'avg({_NEW_SALES})', 4)} AS avg_sales_after,
  count(*) AS n_products, count(DISTINCT rack_id) AS n_racks
FROM racked JOIN december USING (category)""", *_GEN_CTES, _SAMPLED, _ENRICHED, _RACKED, _DEC),
}
