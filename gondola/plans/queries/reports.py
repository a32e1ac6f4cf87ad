"""Comparison reports, store layout and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import demand as D
from ...functions.numbers import half_up
from ...operators import forecast as FC, layout as L, profit as R, quality as Q, report as RP
from ...operators import sales as SA, store as ST
from ...session import written
from .. import tables as T
from . import sql as S
from .layouts import _GREEDY_CHOICE, _ORDER, _RACKS, _TAKE, _WIDE, _items, _recursive, _steps
from .sales import _STORE, _DAILY, _INVENTORY, _LIFT, _FEATURES


def _wide(spark, d):
    """The planogram with triple widths, written once."""
    return written(T.planogram(spark, d).withColumn(
        "product_width_cm", F.col("product_width_cm") * 3))


def _rounded(df, places, *columns):
    return df.withColumns({c: half_up(c, places) for c in columns})


def _compared(spark, d):
    df = _wide(spark, d)
    return RP.compare_racks(df, L.greedy_layout(df))


_CMP = ("orig_profit", "opt_profit", "lift")


def _raised(df):
    """The forecast of the effects report: every category sells 30 % more."""
    mult = df.select("category").distinct().withColumn("multiplier", F.lit(1.3))
    return FC.apply_forecast(df, mult)


def _effects(spark, d):
    df = _wide(spark, d)
    forecasted = written(_raised(df))
    e = RP.lift_effects(df, forecasted, L.greedy_layout(forecasted))
    return _rounded(e, 4, "base_profit", "forecast_profit", "opt_profit", "forecast_effect",
                    "layout_effect", "lift")


def _models(spark, d):
    """One result row per brand: its MSE-like spread and profits on two layouts."""
    df = _wide(spark, d).withColumn("brand", F.split_part("rack_id", F.lit("-"), F.lit(1)))
    a = R.rack_profit(df, ["brand"]).select(F.col("brand").alias("model"),
                                            F.col("profit").alias("original_profit"))
    b = R.rack_profit(df.withColumn("shelf_level", F.lit(4)), ["brand"]).select(
        F.col("brand").alias("model"), F.col("profit").alias("optimized_profit"))
    m = df.groupBy(F.col("brand").alias("model")).agg(
        F.var_pop("price_numeric").alias("mse"))
    out = RP.compare_models(m.join(a, "model").join(b, "model"))
    return _rounded(out, 2, "original_profit", "optimized_profit", "lift").withColumn(
        "mse", half_up("mse", 6))


def _greedy_results(spark, d):
    return _rounded(RP.greedy_results(_wide(spark, d)), 4, "original_profit", "optimized_profit")


def _metrics(spark, d):
    """The tier multiplier alone as a prediction of the full planogram lift."""
    from .sales import _features
    from ...operators.inventory import with_lift
    tier = F.when(F.col("shelf_tier") == 0, 0.7).when(F.col("shelf_tier") == 1, 0.85).when(
        F.col("shelf_tier") == 2, 1.0).otherwise(1.6)
    df = with_lift(_features(spark, d)).withColumn("prediction", tier)
    return _rounded(RP.regression_metrics(df, "lift"), 6, "mse", "mae", "mape", "r2")


def _iterations(spark, d):
    """Months as iterations: rack profit, and as moves the products on other shelves."""
    df = T.planogram(spark, d)
    n_moves = df.groupBy("month_key", "rack_id").agg(
        F.count(F.when(F.col("shelf_level") > 3, 1)).alias("n_moves"))
    rows = R.rack_profit(df).join(n_moves, ["month_key", "rack_id"])
    return _rounded(RP.iteration_gain(rows).select("month_key", "rack_id", "n_moves", "gain", "roi"),
                    4, "gain", "roi")


def _cross_selling(spark, d):
    store = SA.neighbour_count(T.small_store(spark, d)).select(
        "product_id", D.adjacency_factor("n_neighbours").alias("adjacency"))
    sold = T.daily_sales(spark, d).select("product_id", "units_sold").join(store, "product_id")
    return RP.cross_selling_share(sold).select(
        half_up("cross_selling_share", 6).alias("cross_selling_share"))


def _rotation(spark, d):
    df = T.inventory_days(spark, d).withColumn("units_sold", F.col("demand"))
    return _rounded(RP.stock_rotation(df), 6, "rotation", "mean_stock")


_FIELDS = ("profit_before", "profit_after", "delta_pct", "impact", "occupancy", "avg_margin",
           "total_sales", "sales_before", "sales_last")
_NAMES = ("month_key", "rack_id", "product_id", "category")


def _report(spark, d):
    """The report with its JSON payloads taken apart."""
    df = _wide(spark, d)
    optimised = written(L.greedy_layout(df))
    report = RP.optimisation_report(df, optimised, falling=RP.falling_products(df))

    def field(c, t):
        return F.get_json_object("payload", f"$.{c}").cast(t).alias(c)

    return report.select("section", "rank", *[field(c, "string") for c in _NAMES],
                         *[field(c, "double") for c in _FIELDS])


def _cells(spark, d):
    """Grid cells from suppliers: 40 columns; every third nation's cells are shelves."""
    k = F.col("s_suppkey")
    return T.table(spark, d, "supplier").select(
        k.alias("cell_id"), (k % 40).cast("int").alias("x"),
        F.floor(k / 40).cast("int").alias("y"),
        F.when(k == 0, "door").when(F.col("s_nationkey") % 3 == 0, "shelf").otherwise("aisle")
        .alias("kind"), (1 + k % 5).cast("int").alias("level"))


def _categories(spark, d):
    """Nations as categories; bonuses with the next two nations."""
    k, r = F.col("n_nationkey"), F.col("n_regionkey")

    def name(step):
        return F.concat(F.lit("NATION_"), ((k + step) % 25).cast("string"))

    return T.table(spark, d, "nation").select(F.col("n_name").alias("name"), F.create_map(
        name(1), (r + 1) * 0.05, name(2), (r + 1) * 0.02).alias("adjacency_bonus"))


def _neighbours(spark, d):
    """Categories whose suppliers follow each other by key."""
    s = T.table(spark, d, "supplier")
    a = s.select(F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("name"),
                 (F.col("s_suppkey") + 1).alias("k"))
    b = s.select(F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string"))
                 .alias("neighbour"), F.col("s_suppkey").alias("k"))
    return a.join(b, "k").select("name", "neighbour").distinct()


def _heatmap(spark, d):
    """Two stores, odd and even cells; the nations are the centres of traffic."""
    k = F.col("n_nationkey")
    centres = T.table(spark, d, "nation").select(
        (k % 2).alias("store_id"), (k * 7 % 40).cast("double").alias("x"),
        (k % 5).cast("double").alias("y"), (k % 4 + 3).cast("double").alias("sigma"),
        ((k % 3 + 1) / 4).alias("weight"))
    cells = _cells(spark, d).withColumn("store_id", F.col("cell_id") % 2)
    return ST.traffic_heatmap(cells, centres)


def _profit_map(spark, d):
    """Documented demand and position profit of every product on its grid shelf."""
    k = F.col("product_id")
    day = F.col("day")
    rows = T.placements(spark, d).join(T.products(spark, d), "product_id").withColumns({
        "amp": F.lit(0.1) + (k % 5) / 50.0, "trend": (k % 3) / 10000.0,
        "wave": D.season_wave(day % 365 + 1, 30.0), "promo": k % 11 == 0,
        "level": (1 + k % 5).cast("int"), "x": (k % 12).cast("int"), "y": (k % 10).cast("int")})
    demand = D.expected_demand("base_demand", "amp", "wave", "trend", "day", F.lit(0.01),
                               "base_price", F.lit(12.0), "promo", F.lit(0.3))
    traffic = D.traffic_factor("x", "y", F.lit(0), F.lit(0))
    profit = D.position_profit("margin_pct", demand, traffic, D.level_visibility("level"))
    return rows.select("product_id", "day", half_up(demand, 6).alias("demand"),
                       half_up(traffic, 6).alias("traffic"), half_up(profit, 6).alias("profit"))


def _seasonal_profile(spark, d):
    df = T.planogram(spark, d).select("product_id", F.col("estimated_monthly_sales").alias("sales"),
                                      F.substring("month_key", 6, 2).cast("int").alias("month"))
    p = ST.seasonal_profile(df)
    return p.select("product_id", *[half_up(F.col("profile")[m], 6).alias(f"m{m + 1:02d}")
                                    for m in range(12)])


def _transitions(spark, d):
    m = ST.transition_matrix(T.table(spark, d, "events"), "user_id", ["ts", "event_id"],
                             "event_type")
    return _rounded(m, 6, "probability")


def _rank_match(spark, d):
    part = T.table(spark, d, "part")
    k = F.col("p_partkey")
    products = part.select(k.alias("product_id"), F.col("p_type").alias("category"),
                           (F.col("p_retailprice") * (k % 40) / 100).alias("margin"))
    slots = part.select(k.alias("slot_id"), F.col("p_type").alias("category"),
                        D.level_visibility((1 + k % 5)).alias("visibility"))
    return ST.rank_match(products, slots).select("category", "product_id", "slot_id", "rank")


def _placement(spark, d):
    """Every part on a slot, with some broken rules."""
    k = F.col("p_partkey")
    return T.table(spark, d, "part").select(
        k.alias("product_id"), F.col("p_type").alias("category"),
        F.col("p_brand").alias("shelf_id"),
        F.when(k % 50 == 0, "OTHER").otherwise(F.col("p_type")).alias("shelf_category"),
        (1 + k % 7).cast("int").alias("level"), F.floor(k / 7 % 9).cast("int").alias("slot"),
        F.col("p_size").cast("double").alias("width_cm"),
        (10 + k % 45).cast("double").alias("height_cm"),
        ((k % 30) / 2).cast("double").alias("weight_kg"),
        F.lit(50.0).alias("max_height_cm"), F.lit(14.0).alias("max_weight_kg"))


def _validation(spark, d):
    pairs = T.table(spark, d, "part").select(F.col("p_type").alias("category")).distinct()
    bad = spark.createDataFrame([("ECONOMY", "PROMO"), ("SMALL", "LARGE")],
                                "category string, other string")
    return ST.validate_layout(_placement(spark, d), bad.join(pairs, "category", "left_semi"),
                              250.0)


def _expiry(spark, d):
    price = D.expiry_discount("l_extendedprice", F.lit("1998-06-01").cast("date"),
                              F.to_date("l_shipdate"), [(0, 0.8), (7, 0.5), (30, 0.2)])
    return T.table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", half_up(price, 4).alias("price"))


def _quality(spark, d):
    df = T.planogram(spark, d)
    sales, width = F.col("estimated_monthly_sales"), F.col("product_width_cm")
    broken = df.withColumns({
        "estimated_monthly_sales": F.when(F.col("product_id") % 97 == 0, -sales).otherwise(sales),
        "product_width_cm": F.when(F.col("product_id") % 89 == 0, None).otherwise(width)})
    return Q.quality_report(broken)


QUERIES = {
    "g5_j5_compare_racks": lambda s, d: _rounded(_compared(s, d), 4, *_CMP),
    "g5_top_racks": lambda s, d: _rounded(RP.top_racks(_compared(s, d)), 4, *_CMP),
    "g5_totals": lambda s, d: _rounded(RP.compare_totals(_compared(s, d)), 2, *_CMP, "lift_pct"),
    "g5_lift_effects": _effects,
    "g17_compare_models": _models,
    "g17_greedy_results": _greedy_results,
    "g19_regression_metrics": _metrics,
    "g22_space_kpis": lambda s, d: _rounded(
        RP.space_kpis(T.planogram(s, d)), 6, "occupancy", "empty_share"),
    "g22_stock_rotation": _rotation,
    "g22_cross_selling_share": _cross_selling,
    "g23_iteration_gain": _iterations,
    "g24_optimisation_report": _report,
    "g21_seasonal_profile": _seasonal_profile,
    "g25_consolidate_prices": lambda s, d: _rounded(ST.consolidate_prices(
        T.table(s, d, "part"), "p_name", "p_retailprice"), 4, "mean_price"),
    "g27_transition_matrix": _transitions,
    "j8_adjacency_bonus": lambda s, d: _rounded(
        ST.adjacency_bonus(_categories(s, d), _neighbours(s, d)), 6, "factor"),
    "j9_grid_neighbours": lambda s, d: ST.grid_neighbours(_cells(s, d)),
    "j9_shelf_access": lambda s, d: ST.shelf_access(_cells(s, d)),
    "p27_shelf_traffic": lambda s, d: _rounded(ST.shelf_traffic(_cells(s, d)), 6,
                                               "traffic", "position_factor"),
    "p32_traffic_heatmap": lambda s, d: _rounded(
        _heatmap(s, d), 6, "heat").select("store_id", "cell_id", "heat"),
    "p26_p28_position_profit": _profit_map,
    "p33_facing_capacity": lambda s, d: ST.facing_capacity(
        T.planogram(s, d), ["month_key", "rack_id", "shelf_level"]),
    "a7_rank_match": _rank_match,
    "f7_validate_layout": _validation,
    "f8_orphans": lambda s, d: ST.orphans(
        T.table(s, d, "documents"), T.table(s, d, "labels"), "doc_id").select("doc_id", "source"),
    "f6_catalog_report": lambda s, d: Q.catalog_report(T.catalog(s, d)),
    "f6_quality_report": _quality,
    "w6_expiry_discount": _expiry,
}

_GREEDY = (_items("wide", _ORDER), _steps(_GREEDY_CHOICE, _RACKS, _TAKE),
           "placed AS (SELECT w.* REPLACE (st.new_shelf AS shelf_level) FROM wide w "
           "JOIN steps st USING (month_key, rack_id, product_id))")
_RACK = "month_key, rack_id"
_COMPARE = (S.PLANOGRAM, _WIDE, *_GREEDY, S.rack_profit_cte("wide", _RACK, "orig"),
            S.rack_profit_cte("placed", _RACK, "opt"),
            """compared AS (
  SELECT a.month_key, a.rack_id, a.profit AS orig_profit, b.profit AS opt_profit,
         b.profit - a.profit AS lift, c.category
  FROM orig a JOIN opt b USING (month_key, rack_id) JOIN (
    SELECT month_key, rack_id, arg_min(category, product_id) AS category FROM wide GROUP BY 1, 2) c
  USING (month_key, rack_id))""")


def _r(places: int, *columns: str) -> str:
    return ", ".join(f"{S.half_up(c, places)} AS {c}" for c in columns)


_FORECAST_WIDE = ("wide AS (SELECT * REPLACE (product_width_cm * 3 AS product_width_cm, "
                  "greatest(1, CAST(trunc(estimated_monthly_sales * 1.3e0) AS BIGINT)) "
                  "AS estimated_monthly_sales) FROM retail)")
_BRANDS = ("brands AS (SELECT *, split_part(rack_id, '-', 1) AS brand FROM wide)")
_CELLS = """cells AS (
  SELECT s_suppkey AS cell_id, CAST(s_suppkey % 40 AS INTEGER) AS x,
         CAST(s_suppkey // 40 AS INTEGER) AS y,
         CASE WHEN s_suppkey = 0 THEN 'door' WHEN s_nationkey % 3 = 0 THEN 'shelf' ELSE 'aisle' END AS kind,
         CAST(1 + s_suppkey % 5 AS INTEGER) AS level FROM supplier)"""
_VIS = "(CASE {0} WHEN 1 THEN 0.7e0 WHEN 2 THEN 0.85e0 WHEN 3 THEN 1.2e0 WHEN 4 THEN 0.95e0 ELSE 0.75e0 END)"
_PLACEMENT = """placement AS (
  SELECT p_partkey AS product_id, p_type AS category, p_brand AS shelf_id,
         CASE WHEN p_partkey % 50 = 0 THEN 'OTHER' ELSE p_type END AS shelf_category,
         CAST(1 + p_partkey % 7 AS INTEGER) AS level,
         CAST(floor((p_partkey / 7e0) % 9) AS INTEGER) AS slot,
         CAST(p_size AS DOUBLE) AS width_cm, 10e0 + p_partkey % 45 AS height_cm,
         (p_partkey % 30) / 2e0 AS weight_kg FROM part)"""



def _section(name: str, source: str, rank: str = "CAST(NULL AS INTEGER)", **fields: str) -> str:
    columns = [f"{fields.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in _NAMES]
    columns += [f"CAST({fields.get(c, 'NULL')} AS DOUBLE) AS {c}" for c in _FIELDS]
    return f"SELECT '{name}' AS section, {rank} AS rank, {', '.join(columns)} FROM {source}"


_SECTIONS = [
    _section("summary", "(SELECT sum(orig_profit) AS o, sum(opt_profit) AS n FROM compared) t",
             "1", profit_before=S.half_up("o", 2), profit_after=S.half_up("n", 2),
             delta_pct=S.half_up("(n - o) / o * 100", 2)),
    _section("relocation", f"""(
  SELECT month_key, rack_id, product_id, i,
         CAST(row_number() OVER (ORDER BY i DESC, month_key, rack_id, product_id) AS INTEGER) AS rk
  FROM (SELECT w.month_key, w.rack_id, w.product_id,
               {S.BASE} * ({S.mult('st.new_shelf')} - {S.mult('w.shelf_level')}) AS i
        FROM wide w JOIN steps st ON st.month_key = w.month_key AND st.rack_id = w.rack_id
             AND st.product_id = w.product_id WHERE st.new_shelf <> w.shelf_level) m
  QUALIFY rk <= 10) r""", "rk", month_key="month_key", rack_id="rack_id",
             product_id="CAST(product_id AS VARCHAR)", impact=S.half_up("i", 2)),
    _section("category", """(SELECT category, sum(estimated_monthly_sales) AS t,
  avg(profit_margin_percentage) AS m FROM wide GROUP BY 1) c""", category="category",
             total_sales="t", avg_margin=S.half_up("m", 2)),
    _section("underused_rack", """(SELECT month_key, rack_id, sum(product_width_cm) / 2100e0 AS o
  FROM wide GROUP BY 1, 2 HAVING sum(product_width_cm) / 2100e0 < 0.2e0) u""",
             month_key="month_key", rack_id="rack_id", occupancy=S.half_up("o", 4)),
    _section("falling_product", """(SELECT product_id, estimated_monthly_sales AS s1,
  lag(estimated_monthly_sales) OVER (PARTITION BY product_id ORDER BY month_key) AS s0
  FROM wide QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY month_key DESC) = 1
  AND s1 < s0) f""", product_id="CAST(product_id AS VARCHAR)", sales_before="s0",
             sales_last="s1"),
]

ORACLES = {
    "g5_j5_compare_racks": _recursive(
        f"SELECT month_key, rack_id, category, {_r(4, *_CMP)} FROM compared", *_COMPARE),
    "g5_top_racks": _recursive(
        f"SELECT month_key, rack_id, category, {_r(4, *_CMP)} FROM compared "
        "ORDER BY compared.lift DESC, month_key, rack_id LIMIT 15", *_COMPARE),
    "g5_totals": _recursive(f"""SELECT {_r(2, *_CMP)}, {S.half_up('lift / orig_profit * 100', 2)} AS lift_pct
FROM (SELECT sum(orig_profit) AS orig_profit, sum(opt_profit) AS opt_profit,
             sum(opt_profit) - sum(orig_profit) AS lift FROM compared) t""", *_COMPARE),
    "g5_lift_effects": _recursive(f"""SELECT month_key, rack_id,
  {_r(4, 'base_profit', 'forecast_profit', 'opt_profit')},
  {S.half_up('forecast_profit - base_profit', 4)} AS forecast_effect,
  {S.half_up('opt_profit - forecast_profit', 4)} AS layout_effect,
  {S.half_up('opt_profit - base_profit', 4)} AS lift
FROM (SELECT month_key, rack_id, a.profit AS base_profit, b.profit AS forecast_profit,
             c.profit AS opt_profit FROM base a JOIN forecasted b USING (month_key, rack_id)
      JOIN opt c USING (month_key, rack_id)) t""",
        S.PLANOGRAM, _WIDE.replace("wide AS", "first AS"), _FORECAST_WIDE, *_GREEDY,
        S.rack_profit_cte("first", _RACK, "base"), S.rack_profit_cte("wide", _RACK, "forecasted"),
        S.rack_profit_cte("placed", _RACK, "opt")),
    "g17_compare_models": S.query(f"""SELECT model, {S.half_up('mse', 6)} AS mse,
  {_r(2, 'original_profit', 'optimized_profit')},
  {S.half_up('optimized_profit - original_profit', 2)} AS lift,
  model = (SELECT brand FROM brands GROUP BY 1 ORDER BY var_pop(price_numeric), 1 LIMIT 1) AS lowest_mse,
  model = (SELECT brand FROM b ORDER BY profit DESC, 1 DESC LIMIT 1) AS highest_profit
FROM (SELECT a.brand AS model, a.profit AS original_profit, b.profit AS optimized_profit,
             (SELECT var_pop(price_numeric) FROM brands x WHERE x.brand = a.brand) AS mse
      FROM a JOIN b USING (brand)) t""", S.PLANOGRAM, _WIDE, _BRANDS,
        S.rack_profit_cte("brands", "brand", "a"),
        "eye AS (SELECT * REPLACE (4 AS shelf_level) FROM brands)",
        S.rack_profit_cte("eye", "brand", "b")),
    "g17_greedy_results": _recursive(
        f"SELECT 'Greedy' AS model, CAST(NULL AS DOUBLE) AS mse, "
        f"{S.half_up('(SELECT profit FROM orig)', 4)} AS original_profit, "
        f"{S.half_up('(SELECT profit FROM opt)', 4)} AS optimized_profit",
        S.PLANOGRAM, """wide AS (
  SELECT * REPLACE (product_width_cm * 3 AS product_width_cm) FROM retail
  WHERE (month_key, rack_id) = (SELECT (month_key, rack_id) FROM retail GROUP BY month_key, rack_id
                                ORDER BY count(*) DESC, month_key, rack_id LIMIT 1)
  ORDER BY product_id LIMIT 40)""", *_GREEDY,
        S.rack_profit_cte("wide", _RACK, "orig"), S.rack_profit_cte("placed", _RACK, "opt")),
    "g19_regression_metrics": S.query(f"""SELECT {S.half_up('avg((y - p) * (y - p))', 6)} AS mse,
  {S.half_up('avg(abs(y - p))', 6)} AS mae, {S.half_up('avg(abs((y - p) / (y + 1e-6)))', 6)} AS mape,
  {S.half_up('1e0 - avg((y - p) * (y - p)) / var_pop(y)', 6)} AS r2
FROM (SELECT {_LIFT} AS y, CASE shelf_tier WHEN 0 THEN 0.7e0 WHEN 1 THEN 0.85e0 WHEN 2 THEN 1e0
             ELSE 1.6e0 END AS p FROM features) t""", _STORE, _DAILY, _FEATURES),
    "g22_space_kpis": S.query(f"""SELECT month_key, rack_id, {S.half_up('w', 6)} AS occupancy,
  {S.half_up('greatest(0e0, 1e0 - w)', 6)} AS empty_share
FROM (SELECT month_key, rack_id, sum(product_width_cm) / 2100e0 AS w FROM retail GROUP BY 1, 2) t""",
                              S.PLANOGRAM),
    "g22_stock_rotation": S.query(f"""SELECT product_id, sum(demand) AS units,
  {S.half_up('avg(stock)', 6)} AS mean_stock, {S.half_up('sum(demand) / avg(stock)', 6)} AS rotation
FROM inv GROUP BY 1""", _STORE, _DAILY, _INVENTORY),
    "g22_cross_selling_share": S.query(
        f"SELECT {S.half_up('sum(units_sold * (1e0 - 1e0 / f)) / sum(units_sold)', 6)} AS cross_selling_share "
        "FROM daily JOIN (SELECT product_id, 1e0 + least((count(*) OVER (PARTITION BY shelf_id, category) - 1) "
        "* 0.05e0, 0.15e0) AS f FROM store) n USING (product_id)", _STORE, _DAILY),
    "g23_iteration_gain": S.query(f"""SELECT month_key, rack_id, n_moves,
  {S.half_up('(profit - prev) / nullif(prev, 0)', 4)} AS gain,
  {S.half_up('(profit - prev - n_moves) / nullif(n_moves, 0)', 4)} AS roi
FROM (SELECT p.*, lag(profit) OVER (PARTITION BY rack_id ORDER BY month_key) AS prev, n_moves
      FROM profits p JOIN (SELECT month_key, rack_id, count(*) FILTER (shelf_level > 3) AS n_moves
                           FROM retail GROUP BY 1, 2) m USING (month_key, rack_id)) t""",
                                  S.PLANOGRAM, S.rack_profit_cte("retail", _RACK)),
    "g24_optimisation_report": _recursive(" UNION ALL ".join(_SECTIONS), *_COMPARE),
    "g21_seasonal_profile": S.query("SELECT product_id, " + ", ".join(
        S.half_up(f"sum(CASE WHEN CAST(substr(month_key, 6, 2) AS INTEGER) = {m} "
                  "THEN estimated_monthly_sales ELSE 0 END) / (sum(estimated_monthly_sales) / 12e0)", 6)
        + f" AS m{m:02d}" for m in range(1, 13)) + " FROM retail GROUP BY 1", S.PLANOGRAM),
    "g25_consolidate_prices": f"""SELECT p_name, {S.half_up('avg(p_retailprice)', 4)} AS mean_price,
  count(*) AS n_offers FROM part GROUP BY 1""",
    "g27_transition_matrix": f"""SELECT from_section, to_section, n,
  {S.half_up('n / sum(n) OVER (PARTITION BY from_section)', 6)} AS probability
FROM (SELECT from_section, to_section, count(*) AS n FROM (
        SELECT lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS from_section,
               event_type AS to_section FROM events) a
      WHERE from_section IS NOT NULL GROUP BY 1, 2) b""",
    "j8_adjacency_bonus": f"""SELECT n_name AS name, {S.half_up('1e0 + coalesce(sum(bonus), 0e0)', 6)} AS factor
FROM nation LEFT JOIN (
  SELECT DISTINCT a.s_nationkey AS k, b.s_nationkey AS other,
         CASE (b.s_nationkey - a.s_nationkey + 25) % 25 WHEN 1 THEN 0.05e0 ELSE 0.02e0 END * (n.n_regionkey + 1) AS bonus
  FROM supplier a JOIN supplier b ON b.s_suppkey = a.s_suppkey + 1
  JOIN nation n ON n.n_nationkey = a.s_nationkey
  WHERE (b.s_nationkey - a.s_nationkey + 25) % 25 IN (1, 2)) p ON p.k = n_nationkey GROUP BY 1""",
    "j9_grid_neighbours": S.query("""SELECT a.cell_id, b.cell_id AS neighbour_id, b.kind AS neighbour_kind
FROM cells a JOIN cells b ON abs(a.x - b.x) + abs(a.y - b.y) = 1""", _CELLS),
    "j9_shelf_access": S.query("""SELECT a.cell_id, EXISTS (SELECT 1 FROM cells b WHERE b.kind = 'aisle'
  AND abs(a.x - b.x) + abs(a.y - b.y) = 1) AS accessible FROM cells a WHERE a.kind = 'shelf'""", _CELLS),
    "p27_shelf_traffic": S.query(f"""SELECT *, {S.half_up('1e0 / (1e0 + 0.15e0 * (x + y))', 6)} AS traffic,
  {S.half_up('1e0 / (1e0 + 0.15e0 * (x + y)) * ' + _VIS.format('level'), 6)} AS position_factor FROM cells""",
                                 _CELLS),
    "p32_traffic_heatmap": S.query(f"""SELECT store_id, cell_id,
  {S.half_up('h / max(h) OVER (PARTITION BY store_id)', 6)} AS heat
FROM (SELECT c.cell_id % 2 AS store_id, c.cell_id, sum((n_nationkey % 3 + 1) / 4e0 * exp(
        -((c.x - n_nationkey * 7 % 40) ** 2 + (c.y - n_nationkey % 5) ** 2)
        / (2e0 * (n_nationkey % 4 + 3) ** 2))) AS h
      FROM cells c JOIN nation n ON n_nationkey % 2 = c.cell_id % 2 GROUP BY 1, 2) t""", _CELLS),
    "p26_p28_position_profit": S.query(f"""SELECT product_id, day, {S.half_up('demand', 6)} AS demand,
  {S.half_up('traffic', 6)} AS traffic,
  {S.half_up("margin_pct * demand * traffic * " + _VIS.format('(1 + product_id % 5)'), 6)} AS profit
FROM (SELECT product_id, day, margin_pct,
             (2e0 + product_id % 18) * (1e0 + (0.1e0 + (product_id % 5) / 50e0)
               * sin(2e0 * pi() * (day % 365 + 1 - 30e0) / 365e0))
             * (1e0 + (product_id % 3) / 10000e0 * day) * (1e0 - 0.01e0 * (base_price - 12e0))
             * CASE WHEN product_id % 11 = 0 THEN 1.3e0 ELSE 1e0 END AS demand,
             1e0 / (1e0 + 0.15e0 * (product_id % 12 + product_id % 10)) AS traffic
      FROM features) t""", _STORE, _DAILY, _FEATURES),
    "p33_facing_capacity": S.query("""SELECT month_key, rack_id, shelf_level,
  CAST(floor(120e0 / avg(product_width_cm)) AS BIGINT) AS facings FROM retail GROUP BY 1, 2, 3""",
                                   S.PLANOGRAM),
    "a7_rank_match": f"""SELECT category, product_id, slot_id, rank
FROM (SELECT p_type AS category, p_partkey AS product_id,
             row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice * (p_partkey % 40) / 100 DESC, p_partkey) AS rank
      FROM part) a
JOIN (SELECT p_type AS category, p_partkey AS slot_id,
             row_number() OVER (PARTITION BY p_type ORDER BY {_VIS.format('(1 + p_partkey % 5)')} DESC, p_partkey) AS rank
      FROM part) b USING (category, rank)""",
    "f7_validate_layout": S.query("""SELECT 'slot_taken_twice' AS "check", shelf_id || '/' || level || '/' || slot AS subject,
  CAST(count(*) AS DOUBLE) AS value FROM placement GROUP BY shelf_id, level, slot HAVING count(*) > 1
UNION ALL SELECT 'wrong_category', CAST(product_id AS VARCHAR), 1e0 FROM placement WHERE category <> shelf_category
UNION ALL SELECT 'level_too_wide', shelf_id || '/' || level, sum(width_cm) FROM placement
  GROUP BY shelf_id, level HAVING sum(width_cm) > 250
UNION ALL SELECT 'too_high', CAST(product_id AS VARCHAR), height_cm FROM placement WHERE height_cm > 50
UNION ALL SELECT 'too_heavy', CAST(product_id AS VARCHAR), weight_kg FROM placement WHERE weight_kg > 14
UNION ALL SELECT 'category_split', shelf_id || '/' || level || '/' || category,
  CAST(max(slot) - min(slot) + 1 - count(DISTINCT slot) AS DOUBLE) FROM placement
  GROUP BY shelf_id, level, category HAVING max(slot) - min(slot) + 1 > count(DISTINCT slot)
UNION ALL SELECT 'incompatible_neighbours', a.shelf_id || '/' || a.level || '/' || a.slot, 1e0
  FROM (SELECT DISTINCT shelf_id, level, slot, category FROM placement) a
  JOIN (SELECT DISTINCT shelf_id, level, slot, category FROM placement) b ON b.shelf_id = a.shelf_id AND b.level = a.level AND b.slot = a.slot + 1
  WHERE (a.category, b.category) IN (('ECONOMY', 'PROMO'), ('SMALL', 'LARGE'))""", _PLACEMENT),
    "f8_orphans": "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "f6_catalog_report": """SELECT count(*) AS n_rows, 12 AS n_categories,
  count(*) FILTER (p_size % 5 = 3) AS n_blank_prices, count(*) FILTER (p_size % 5 = 4) AS n_bad_prices,
  0 AS n_null_category FROM part""".replace("12 AS", "CAST(12 AS BIGINT) AS").replace(
      "0 AS n_null", "CAST(0 AS BIGINT) AS n_null"),
    "f6_quality_report": S.query("""SELECT count(*) AS n_rows, count(DISTINCT category) AS n_categories,
  count(*) FILTER (price_numeric IS NULL) AS n_missing_price_numeric,
  count(*) FILTER (price_numeric < 0) AS n_negative_price_numeric,
  count(*) FILTER (estimated_monthly_sales IS NULL) AS n_missing_estimated_monthly_sales,
  count(*) FILTER (product_id % 97 = 0 AND estimated_monthly_sales > 0) AS n_negative_estimated_monthly_sales,
  count(*) FILTER (profit_margin_percentage IS NULL) AS n_missing_profit_margin_percentage,
  count(*) FILTER (profit_margin_percentage < 0) AS n_negative_profit_margin_percentage,
  count(*) FILTER (product_id % 89 = 0) AS n_missing_product_width_cm,
  count(*) FILTER (product_width_cm < 0) AS n_negative_product_width_cm,
  count(*) FILTER (shelf_level NOT BETWEEN 1 AND 7) AS n_bad_shelves FROM retail""", S.PLANOGRAM),
    "w6_expiry_discount": f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  {S.half_up('''l_extendedprice * (1e0 - CASE WHEN d <= 0 THEN 0.8e0 WHEN d <= 7 THEN 0.5e0
    WHEN d <= 30 THEN 0.2e0 ELSE 0e0 END)''', 4)} AS price
FROM (SELECT *, date_diff('day', DATE '1998-06-01', CAST(l_shipdate AS DATE)) AS d FROM lineitem) t""",
}
