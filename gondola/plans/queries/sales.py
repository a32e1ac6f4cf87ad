"""Daily sales, runs and inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import demand as D, stock as ST
from ...functions.numbers import half_up
from ...operators import inventory as I, sales as SA
from ...session import shared_dir
from ...sources import readers, sinks
from .. import tables as T
from . import sql as S


def _double(df, *columns):
    """Decimal columns as doubles, for a comparison by value."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


_TOTALS = ("total_revenue", "total_profit")


def _store(spark, d):
    return (T.small_store(spark, d).withColumn("price", F.col("price_cents") / 100)
            .withColumn("margin", F.col("margin_pct") / 100)
            .withColumn("popularity", F.col("popularity_pct") / 100))


def _expected(spark, d):
    df = SA.expected_sales(_store(spark, d))
    return _double(df, "revenue", "profit").select(
        "product_id", "n_neighbours", "adjacency", "units_sold", "revenue", "profit")


def _top(spark, d):
    return SA.top_per_run(T.run_sales(spark, d))


def _profile(spark, d):
    df = SA.top_profile(_top(spark, d))
    return df.select(*[half_up(c, 6).alias(c) for c in df.columns])


def _dominant(spark, d):
    top = _top(spark, d)
    order = ["sim_id", "rank"]
    return SA.dominant(top, "category", order).unionByName(
        SA.dominant(top, "shelf_id", order)).unionByName(
        SA.dominant(top, "rack_level", order)).unionByName(SA.dominant(top, "name", order))


def _in_all(spark, d):
    """Parts sold in all ten runs."""
    sold = (T.run_sales(spark, d).select("sim_id", F.col("product_id").cast("string")
                                         .alias("name")).distinct())
    return SA.in_all_runs(sold, 10)


def _daily_int(spark, d):
    day = F.datediff(F.col("sale_date"), F.lit("1995-01-01").cast("date"))
    return T.daily_sales(spark, d).select(
        day.alias("day"), F.col("product_id").cast("int").alias("product_id"), "name", "category",
        "shelf_id", "rack_level", F.col("units_sold").cast("int").alias("units_sold"),
        "revenue", "profit")


def _daily_files(fmt):
    def run(spark, d):
        path = shared_dir(spark)
        sinks.write_daily(_daily_int(spark, d), path, fmt)
        return _double(readers.read_daily(spark, path, fmt), "revenue", "profit")
    return run


def _rolling(spark, d):
    day = F.datediff(F.col("sale_date"), F.lit("1995-01-01").cast("date"))
    return I.rolling_sales(T.daily_sales(spark, d).withColumn("day", day))


_R = ("profit_term", "holding_term", "penalty_term", "reward")


def _rewards(spark, d):
    df = I.daily_reward(T.inventory_days(spark, d))
    return df.select("product_id", "day", "units_sold", "inventory_after", "stockout",
                     *[half_up(c, 4).alias(c) for c in _R])


def _episodes(spark, d):
    df = I.daily_reward(T.inventory_days(spark, d)).withColumn(
        "month_key", F.date_format("sale_date", "yyyy_MM"))
    episodes = I.episode_rewards(df, ["month_key"])
    return episodes.select("month_key", *[half_up(c, 2).alias(c) for c in _R])


def _reward_summary(spark, d):
    df = I.daily_reward(T.inventory_days(spark, d)).withColumn(
        "month_key", F.date_format("sale_date", "yyyy_MM"))
    s = I.reward_summary(df, ["month_key"])
    return s.select("n_episodes", *[half_up(c, 2).alias(c) for c in s.columns[1:]])


def _features(spark, d):
    return I.lift_features(T.placements(spark, d), T.products(spark, d), T.positions(spark, d))


def _normalised(spark, d):
    """Observation features: rolling sales, restock age and lift of every product-day."""
    days = T.inventory_days(spark, d)
    rolling = I.rolling_sales(days.withColumn("units_sold", F.col("demand")))
    age = I.days_since_restock(days).select("product_id", "day", "days_since_restock")
    lifts = I.with_lift(_features(spark, d)).select("product_id", "day", "lift")
    keys = ["product_id", "day"]
    rows = (days.join(rolling, keys).join(age, keys).join(lifts, keys)
            .withColumn("inventory", F.col("stock_before")))
    out = [c for c in I.normalise_features(rows).columns if c.endswith("_norm")]
    return I.normalise_features(rows).select(*keys, *[half_up(c, 6).alias(c) for c in out])


def _positions_norm(spark, d):
    return I.normalise_positions(T.positions(spark, d), T.placements(spark, d)).withColumn(
        "tier_norm", half_up("tier_norm", 6))


def _premium(spark, d):
    return T.positions(spark, d).select(
        "position_id", D.is_premium("tier", F.col("is_end_cap")).alias("is_premium"))


def _margins(spark, d):
    return T.products(spark, d).select(
        "product_id",
        half_up(D.margin_abs("base_price", "margin_pct"), 6).alias("margin_abs"),
        half_up(D.unit_margin("base_price", F.col("base_price") * 0.75), 6).alias("unit_margin"))


QUERIES = {
    "j3_neighbour_count": lambda s, d: SA.neighbour_count(T.small_store(s, d)).select(
        "product_id", "n_neighbours"),
    "p18_p19_expected_sales": _expected,
    "g10_product_totals": lambda s, d: _double(
        SA.product_totals(T.daily_sales(s, d)), *_TOTALS),
    "g11_store_totals": lambda s, d: _double(
        SA.store_totals(T.daily_sales(s, d)), *_TOTALS).withColumn(
            "margin_pct", half_up("margin_pct", 6)),
    "g12_frequency": lambda s, d: SA.frequency(
        T.run_sales(s, d), ["name", "category", "shelf_id", "rack_level"]),
    "g12_top_frequency": lambda s, d: SA.frequency(
        _top(s, d), ["name", "category", "shelf_id", "rack_level"]),
    "g13_top_profile": _profile,
    "g14_dominant": _dominant,
    "g14_level_share": lambda s, d: SA.level_share(T.run_sales(s, d)).select(
        half_up("share_pct", 6).alias("share_pct")),
    "j10_in_all_runs": _in_all,
    "t1_top_products": lambda s, d: _double(
        SA.top_products(T.daily_sales(s, d), 20), "total_profit"),
    "t2_top_per_run": lambda s, d: _double(_top(s, d), *_TOTALS),
    "k4_daily_csv": _daily_files("csv"),
    "k4_daily_json": _daily_files("json"),
    "w1_rolling_sales": _rolling,
    "w2_days_since_restock": lambda s, d: I.days_since_restock(T.inventory_days(s, d)),
    "p21_p22_daily_reward": _rewards,
    "g20_episode_rewards": _episodes,
    "g20_reward_summary": _reward_summary,
    "p23_normalised_products": _normalised,
    "p23_normalised_positions": _positions_norm,
    "p24_day_features": lambda s, d: T.inventory_days(s, d).select(
        "product_id", "day", ST.day_of_week("day").alias("day_of_week"),
        ST.week_of_year("day").alias("week_of_year")),
    "p29_is_premium": _premium,
    "p30_margins": _margins,
    "j7_lift_features": _features,
    "p20_planogram_lift": lambda s, d: I.with_lift(_features(s, d)).select(
        "product_id", "day", half_up("lift", 6).alias("lift")),
    "j11_placement_summary": lambda s, d: I.placement_summary(
        T.placements(s, d), T.products(s, d), T.positions(s, d)).withColumn(
            "lift", half_up("lift", 2)),
}

_STORE = """store AS (
  SELECT p_partkey AS product_id, p_name AS name, p_type AS category,
         CAST(round(p_retailprice * 100) AS BIGINT) % 1000 + 90 AS cents,
         15 + p_partkey % 26 AS mpct, 45 + p_partkey % 46 AS ppct, p_brand AS shelf_id,
         CAST(1 + p_partkey % 4 AS INTEGER) AS rack_level FROM part)"""


def _daily(name: str, extra: str = "") -> str:
    run = "1 + l_suppkey % 10 AS sim_id, " if extra else ""
    return f"""{name} AS (
  SELECT {extra} product_id, sale_date, units AS units_sold, name, category, shelf_id, rack_level,
         units * cents AS revenue_cents, (units * cents * mpct + 50) // 100 AS profit_cents,
         cents / 100e0 AS price, mpct / 100e0 AS margin, ppct / 100e0 AS popularity,
         date_diff('day', DATE '1995-01-01', sale_date) AS day
  FROM (SELECT {run} l_partkey AS product_id, CAST(l_shipdate AS DATE) AS sale_date,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units
        FROM lineitem GROUP BY ALL) u JOIN store USING (product_id))"""


_DAILY = _daily("daily")
_RUNS = _daily("runs", "sim_id,")
_ATTRS = "product_id, name, category, price, margin, popularity, shelf_id, rack_level"
_SUMS = """CAST(sum(units_sold) AS BIGINT) AS total_units,
  CAST(sum(revenue_cents) AS BIGINT) / 100e0 AS total_revenue,
  CAST(sum(profit_cents) AS BIGINT) / 100e0 AS total_profit"""
_TOP = f"""top AS (
  SELECT sim_id, {_ATTRS}, {_SUMS},
         CAST(row_number() OVER (PARTITION BY sim_id ORDER BY sum(profit_cents) DESC, product_id) AS INTEGER) AS rank,
         sim_id + 99 AS seed
  FROM runs GROUP BY sim_id, {_ATTRS} QUALIFY rank <= 5)"""
_INVENTORY = """inv AS (
  SELECT product_id, sale_date, CAST(day AS INTEGER) AS day, CAST(units_sold AS DOUBLE) AS demand,
         CAST((product_id * 13 + day * 7) % 60 AS DOUBLE) AS stock,
         floor(price * margin * 1e4 + 0.5e0) / 1e4 AS margin_abs, price AS base_price,
         margin AS margin_pct, 2e0 + product_id % 18 AS base_demand,
         30 + product_id % 90 AS max_inventory, (product_id + day) % 7 = 0 AS restocked
  FROM daily)"""
_REWARDS = """rewards AS (
  SELECT *, profit_term - holding_term - penalty_term AS reward FROM (
    SELECT *, margin_abs * units_sold AS profit_term, 0.02e0 * inventory_after AS holding_term,
           CASE stockout WHEN 'met' THEN 0e0 WHEN 'partial' THEN 2e0 * margin_abs
                ELSE 5e0 * margin_abs END AS penalty_term
    FROM (SELECT *, least(demand, stock) AS units_sold, stock - least(demand, stock) AS inventory_after,
                 CASE WHEN demand < 1e-6 OR least(demand, stock) / demand >= 1 - 1e-6 THEN 'met'
                      WHEN least(demand, stock) / demand >= 0.5 THEN 'partial' ELSE 'full' END AS stockout
          FROM inv) a) b)"""
_FEATURES = """features AS (
  SELECT d.product_id, d.product_id AS position_id, CAST(d.day AS INTEGER) AS day,
         CAST(d.product_id * 31 % 4 AS INTEGER) AS shelf_tier,
         CAST(1 + d.product_id % 4 AS INTEGER) AS facing_count,
         CAST(d.product_id % 7 = 0 AS INTEGER) AS is_end_cap,
         CAST(d.product_id % 10 = 0 AS INTEGER) AS is_checkout, 0 AS adjacency_promo,
         CAST(d.product_id % 10 AS INTEGER) AS product_category,
         (p_retailprice - 899e0) / 4e0 AS base_price,
         (10 + d.product_id % 56) / 100e0 AS margin_pct,
         CAST((d.product_id + d.day) % 15 AS INTEGER) AS days_since_restock,
         CAST(d.day % 7 AS INTEGER) AS day_of_week,
         CAST((d.day // 7) % 52 + 1 AS INTEGER) AS week_of_year,
         CAST(d.units_sold AS DOUBLE) AS inventory
  FROM daily d JOIN part ON p_partkey = d.product_id)"""
_LIFT = """least(greatest(
    CASE shelf_tier WHEN 0 THEN 0.70e0 WHEN 1 THEN 0.85e0 WHEN 2 THEN 1e0 ELSE 1.60e0 END
    * (1e0 + 0.12e0 * sqrt(facing_count - 1)) * (1e0 + 0.5e0 * is_end_cap)
    * (1e0 + 0.3e0 * is_checkout * CAST(product_category < 4 AS INTEGER))
    * (1e0 + 0.2e0 * adjacency_promo) * (1e0 + 0.15e0 * CAST(day_of_week >= 5 AS INTEGER))
    * (1e0 - 0.03e0 * least(days_since_restock, 10)), 0.3e0), 4e0)"""


def _freq(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS dimension, CAST({c} AS VARCHAR) AS value, count(*) AS n "
        f"FROM {source} GROUP BY {c}" for c in ("name", "category", "shelf_id", "rack_level"))


def _mode(column: str) -> str:
    return (f"(SELECT '{column}' AS dimension, CAST({column} AS VARCHAR) AS value, count(*) AS n "
            f"FROM top GROUP BY {column} ORDER BY n DESC, min(sim_id * 10 + rank) LIMIT 1)")


def _unit(x: str, name: str) -> str:
    return f"{S.half_up(f'least(greatest({x}, 0e0), 1e0)', 6)} AS {name}"


_ADJ = "(1e0 + least(n_neighbours * 0.05e0, 0.15e0))"
_LEVEL = "(CASE rack_level WHEN 1 THEN 0.5e0 WHEN 2 THEN 0.75e0 WHEN 3 THEN 1e0 ELSE 0.65e0 END)"
_MONTH = "strftime(sale_date, '%Y_%m')"
_R_SQL = ", ".join(f"{S.half_up(f'sum({c})', 2)} AS {c}" for c in _R)
_PROFILE_COLUMNS = (("avg(price)", "avg_price"), ("avg(margin)", "avg_margin"),
                    ("avg(popularity)", "avg_popularity"), ("avg(total_profit)", "avg_profit"),
                    ("min(price)", "min_price"), ("max(price)", "max_price"),
                    ("min(margin)", "min_margin"), ("max(margin)", "max_margin"))
_DAILY_FILE = """SELECT CAST(day AS INTEGER) AS day, CAST(product_id AS INTEGER) AS product_id,
  name, category, shelf_id, rack_level, CAST(units_sold AS INTEGER) AS units_sold,
  revenue_cents / 100e0 AS revenue, profit_cents / 100e0 AS profit FROM daily"""

ORACLES = {
    "j3_neighbour_count": S.query(
        "SELECT a.product_id, (SELECT count(*) FROM store b WHERE b.shelf_id = a.shelf_id "
        "AND b.category = a.category AND b.product_id <> a.product_id) AS n_neighbours "
        "FROM store a", _STORE),
    "p18_p19_expected_sales": S.query(f"""SELECT product_id, n_neighbours, {_ADJ} AS adjacency, units AS units_sold,
  units * cents / 100e0 AS revenue, (units * cents * mpct + 50) // 100 / 100e0 AS profit
FROM (SELECT *, greatest(1, CAST(round_even(20e0 * (ppct / 100e0) * {_LEVEL} * {_ADJ}, 0) AS BIGINT)) AS units
      FROM (SELECT *, count(*) OVER (PARTITION BY shelf_id, category) - 1 AS n_neighbours FROM store) a) b""",
                                      _STORE),
    "g10_product_totals": S.query(
        f"SELECT {_ATTRS}, {_SUMS} FROM daily GROUP BY {_ATTRS}", _STORE, _DAILY),
    "g11_store_totals": S.query(
        f"SELECT *, {S.half_up('total_profit * 100 / total_revenue', 6)} AS margin_pct "
        f"FROM (SELECT {_SUMS} FROM daily) t", _STORE, _DAILY),
    "g12_frequency": S.query(_freq("runs"), _STORE, _RUNS),
    "g12_top_frequency": S.query(_freq("top"), _STORE, _RUNS, _TOP),
    "g13_top_profile": S.query("SELECT " + ", ".join(
        f"{S.half_up(x, 6)} AS {n}" for x, n in _PROFILE_COLUMNS) + " FROM top",
        _STORE, _RUNS, _TOP),
    "g14_dominant": S.query(" UNION ALL ".join(
        _mode(c) for c in ("category", "shelf_id", "rack_level", "name")), _STORE, _RUNS, _TOP),
    "g14_level_share": S.query(
        f"SELECT {S.half_up('100e0 * count(*) FILTER (rack_level = 3) / count(*)', 6)} AS share_pct "
        "FROM runs", _STORE, _RUNS),
    "j10_in_all_runs": """SELECT CAST(l_partkey AS VARCHAR) AS name FROM lineitem
GROUP BY l_partkey HAVING count(DISTINCT l_suppkey % 10) = 10""",
    "t1_top_products": S.query("""SELECT product_id, name, CAST(sum(profit_cents) AS BIGINT) / 100e0 AS total_profit
FROM daily GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 20""", _STORE, _DAILY),
    "t2_top_per_run": S.query("SELECT * FROM top", _STORE, _RUNS, _TOP),
    "k4_daily_csv": S.query(_DAILY_FILE, _STORE, _DAILY),
    "k4_daily_json": S.query(_DAILY_FILE, _STORE, _DAILY),
    "w1_rolling_sales": S.query("""SELECT product_id, CAST(day AS INTEGER) AS day, units_sold,
  CAST(sum(units_sold) OVER (w ROWS 6 PRECEDING) AS BIGINT) / 7e0 AS avg_7,
  CAST(sum(units_sold) OVER (w ROWS 29 PRECEDING) AS BIGINT) / 30e0 AS avg_30
FROM daily WINDOW w AS (PARTITION BY product_id ORDER BY day)""", _STORE, _DAILY)
    .replace("OVER (w ROWS", "OVER (PARTITION BY product_id ORDER BY day ROWS")
    .replace(" WINDOW w AS (PARTITION BY product_id ORDER BY day)", ""),
    "w2_days_since_restock": S.query("""SELECT product_id, day, restocked, CAST(day - coalesce(
  (SELECT max(b.day) FROM inv b WHERE b.product_id = a.product_id AND b.day <= a.day AND b.restocked),
  (SELECT min(b.day) FROM inv b WHERE b.product_id = a.product_id) - 1) AS INTEGER) AS days_since_restock
FROM inv a""", _STORE, _DAILY, _INVENTORY),
    "p21_p22_daily_reward": S.query("SELECT product_id, day, units_sold, inventory_after, stockout, "
        + ", ".join(f"{S.half_up(c, 4)} AS {c}" for c in _R) + " FROM rewards",
        _STORE, _DAILY, _INVENTORY, _REWARDS),
    "g20_episode_rewards": S.query(
        f"SELECT {_MONTH} AS month_key, {_R_SQL} FROM rewards GROUP BY 1",
        _STORE, _DAILY, _INVENTORY, _REWARDS),
    "g20_reward_summary": S.query(f"""SELECT count(*) AS n_episodes,
  {S.half_up('avg(r)', 2)} AS mean_reward, {S.half_up('stddev_pop(r)', 2)} AS std_reward,
  {S.half_up('min(r)', 2)} AS min_reward, {S.half_up('max(r)', 2)} AS max_reward
FROM (SELECT {_MONTH} AS m, sum(reward) AS r FROM rewards GROUP BY 1) t""",
        _STORE, _DAILY, _INVENTORY, _REWARDS),
    "p23_normalised_products": S.query(f"""SELECT i.product_id, i.day,
  {_unit('stock / max_inventory', 'inv_norm')},
  {_unit('avg7 / greatest(base_demand * 3, 1e0)', 'avg_7_norm')},
  {_unit('avg30 / greatest(base_demand * 3, 1e0)', 'avg_30_norm')},
  {_unit('i.base_price / 50e0', 'price_norm')}, {_unit('i.margin_pct', 'margin_norm')},
  {_unit('age / 14e0', 'restock_norm')}, {_unit(_LIFT + ' / 4e0', 'lift_norm')}
FROM (SELECT *, sum(demand) OVER (PARTITION BY product_id ORDER BY day ROWS 6 PRECEDING) / 7e0 AS avg7,
             sum(demand) OVER (PARTITION BY product_id ORDER BY day ROWS 29 PRECEDING) / 30e0 AS avg30,
             day - coalesce(max(CASE WHEN restocked THEN day END) OVER (PARTITION BY product_id ORDER BY day),
                            min(day) OVER (PARTITION BY product_id) - 1) AS age FROM inv) i
JOIN features f ON f.product_id = i.product_id AND f.day = i.day""",
        _STORE, _DAILY, _INVENTORY, _FEATURES),
    "p23_normalised_positions": f"""SELECT p_partkey AS position_id,
  CASE WHEN p_partkey IN (SELECT l_partkey FROM lineitem) THEN 1e0 ELSE 0e0 END AS is_occupied,
  {S.half_up('(p_partkey * 31 % 4) / 3e0', 6)} AS tier_norm,
  CASE WHEN p_partkey * 31 % 4 = 3 OR p_partkey % 7 = 0 THEN 1e0 ELSE 0e0 END AS is_premium FROM part""",
    "p24_day_features": S.query("""SELECT product_id, day, CAST(day % 7 AS INTEGER) AS day_of_week,
  CAST((day // 7) % 52 + 1 AS INTEGER) AS week_of_year FROM inv""", _STORE, _DAILY, _INVENTORY),
    "p29_is_premium": "SELECT p_partkey AS position_id, p_partkey * 31 % 4 = 3 OR p_partkey % 7 = 0 AS is_premium FROM part",
    "p30_margins": f"""SELECT p_partkey AS product_id,
  {S.half_up('(p_retailprice - 899e0) / 4e0 * ((10 + p_partkey % 56) / 100e0)', 6)} AS margin_abs,
  {S.half_up('(p_retailprice - 899e0) / 4e0 * 0.25e0', 6)} AS unit_margin FROM part""",
    "j7_lift_features": S.query("SELECT * EXCLUDE (inventory) FROM features", _STORE, _DAILY, _FEATURES),
    "p20_planogram_lift": S.query(
        f"SELECT product_id, day, {S.half_up(_LIFT, 6)} AS lift FROM features",
        _STORE, _DAILY, _FEATURES),
    "j11_placement_summary": S.query(f"""SELECT position_id AS position, product_id AS product, day,
  shelf_tier AS tier, shelf_tier = 3 OR is_end_cap = 1 AS is_premium,
  {S.half_up(f'round({_LIFT}, 3)', 2)} AS lift, round(inventory, 1) AS inventory FROM features""",
        _STORE, _DAILY, _FEATURES),
}
