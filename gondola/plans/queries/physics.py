"""Rack physics, profit, violations and what-if lifts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...functions import physics as P
from ...functions.numbers import half_up, uniform
from ...operators import profit as R, whatif as W
from ...session import written
from .. import tables as T
from . import sql as S


# Every factor of one planogram row: query name -> (column, expression, SQL).
_FACTORS = {
    "p2_shelf_multiplier": ("multiplier", P.shelf_multiplier, ("shelf_level",),
                            S.mult("shelf_level")),
    "p3_basic_profit": ("basic_profit", lambda: half_up(P.basic_profit(), 4), (),
                        S.half_up(f"{S.BASE} * {S.mult('shelf_level')}", 4)),
    "p4_base_profit": ("base_profit", lambda: half_up(P.base_profit(), 4), (),
                       S.half_up(S.BASE, 4)),
    "p5_crowding": ("crowding", lambda: P.crowding(F.col("product_id") % 21), (),
                    S.crowd("(product_id % 21)")),
    "p6_diminishing": ("diminishing",
                       lambda: P.diminishing("shelf_level", F.col("product_width_cm") * 9), (),
                       S.dim("shelf_level", "product_width_cm * 9")),
    "p7_price_tier": ("price_tier", P.price_tier, ("price_numeric", "shelf_level"),
                      S.tier("price_numeric", "shelf_level")),
    "p8_spread": ("spread", lambda: P.spread(F.col("product_id") % 8), (),
                  S.spread("product_id % 8")),
    "p17_shelf_band": ("band", P.shelf_band, ("shelf_level",),
                       "CASE WHEN shelf_level IN (1, 2) THEN 'bottom' "
                       "WHEN shelf_level IN (3, 4, 5) THEN 'eye' "
                       "WHEN shelf_level IN (6, 7) THEN 'top' END"),
}


def _factor(name):
    column, expression, arguments, _ = _FACTORS[name]
    return lambda spark, d: T.planogram(spark, d).select(
        "month_key", "product_id", expression(*arguments).alias(column))


def _profit(df, *columns):
    return df.select(*columns, half_up("profit", 4).alias("profit"))


def _moves(spark, d):
    return (W.move_lift(T.planogram(spark, d))
            .withColumn("profit_lift", half_up("profit_lift", 4)))


def _training(spark, d):
    df = written(T.planogram(spark, d))
    n = max(20_000, 3 * df.count())
    sample = W.training_sample(df, n, seed=42)
    return sample.select("draw_id", "month_key", "rack_id", "product_id", "original_shelf",
                         "new_shelf", half_up("profit_lift", 4).alias("profit_lift"))


def _split(spark, d):
    train, test = W.split(T.planogram(spark, d), 0.85, 42, ["month_key", "product_id"])
    return (train.withColumn("part", F.lit("train"))
            .unionByName(test.withColumn("part", F.lit("test")))
            .groupBy("month_key", "part").agg(F.count(F.lit(1)).alias("n")))


def _month_split(spark, d):
    train, test = W.split_by_month(T.planogram(spark, d), "2000_01")
    return (train.withColumn("part", F.lit("train"))
            .unionByName(test.withColumn("part", F.lit("test")))
            .groupBy("part").agg(F.count(F.lit(1)).alias("n"),
                                 F.min("month_key").alias("first_month"),
                                 F.max("month_key").alias("last_month")))


def _noise(spark, d):
    return T.planogram(spark, d).select(
        "month_key", "product_id", uniform(42, "month_key", "product_id").alias("u"))


QUERIES = {
    **{name: _factor(name) for name in _FACTORS},
    "g1_shelf_stats": lambda s, d: R.shelf_stats(T.planogram(s, d)),
    "g2_rack_profit": lambda s, d: _profit(
        R.rack_profit(T.planogram(s, d)),
        "month_key", "rack_id", "n_products", "n_shelves_used"),
    "g2_rack_profit_all_months": lambda s, d: R.rack_profit(
        T.planogram(s, d), ["rack_id"]).select(
            "rack_id", "n_products", "n_shelves_used", half_up("profit", 2).alias("profit")),
    "g3_shelf_profit": lambda s, d: _profit(
        R.shelf_profit(T.planogram(s, d)),
        "month_key", "rack_id", "shelf_level", "band", "n_products", "width_cm"),
    "g3_shelf_profit_single": lambda s, d: _profit(
        R.shelf_profit(T.planogram(s, d), spread="single"),
        "month_key", "rack_id", "shelf_level", "band", "n_products", "width_cm"),
    "f1_filtered_rows": lambda s, d: T.planogram(s, d).filter(
        (F.col("shelf_level") == 4) & (F.col("category") == "ECONOMY")),
    "f3_shelf_violations": lambda s, d: R.shelf_violations(T.planogram(s, d)),
    "f4_racks_with_min_products": lambda s, d: R.racks_with(T.planogram(s, d), 25).select(
        "month_key", "rack_id", "product_id"),
    "g15_largest_rack": lambda s, d: R.largest_rack(T.planogram(s, d)),
    "t5_head_of_rack": lambda s, d: R.head_of_rack(T.planogram(s, d), 20).select(
        "month_key", "rack_id", "product_id", "row_no"),
    "s6_head_n": lambda s, d: R.head_n(
        T.planogram(s, d), 100, ["month_key", "product_id"]).select("month_key", "product_id"),
    "m1_j6_move_lift": _moves,
    "m2_training_sample": _training,
    "m6_uniform_noise": _noise,
    "u5_hash_split": _split,
    "u5_month_split": _month_split,
}

_V = S.BASE
_MONTH_RACK = "month_key, rack_id"


def _shelf_oracle(n_shelves: str) -> str:
    value = (f"{S.mult('shelf_level')} * {S.crowd('count(*)')} "
             f"* {S.dim('shelf_level', 'sum(product_width_cm)')} "
             f"* sum({_V} * {S.tier('price_numeric', 'shelf_level')})")
    return S.query(f"""SELECT month_key, rack_id, shelf_level,
  CASE WHEN shelf_level <= 2 THEN 'bottom' WHEN shelf_level <= 5 THEN 'eye' ELSE 'top' END AS band,
  n_products, width_cm, {S.half_up(f"{S.spread(n_shelves)} * v", 4)} AS profit
FROM (SELECT month_key, rack_id, shelf_level, count(*) AS n_products,
             sum(product_width_cm) AS width_cm, {value} AS v
      FROM retail GROUP BY 1, 2, 3) t""", S.PLANOGRAM)


# Brute-force what-if: the whole rack is re-rated for every product and shelf.
_MOVES = f"""shelves AS (
  SELECT month_key, rack_id, shelf_level, count(*) AS c, sum(product_width_cm) AS w,
         sum({_V} * {S.tier('price_numeric', 'shelf_level')}) AS v
  FROM retail GROUP BY 1, 2, 3),
racks AS (
  SELECT month_key, rack_id, sum(c) AS n, count(*) AS used FROM shelves GROUP BY 1, 2),
grid AS (
  SELECT r.month_key, r.rack_id, r.n, r.used, CAST(g.s AS INTEGER) AS s,
         coalesce(c, 0) AS c, coalesce(w, 0e0) AS w, coalesce(v, 0e0) AS v
  FROM racks r CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5, 6, 7]) AS s) g
  LEFT JOIN shelves x ON x.month_key = r.month_key AND x.rack_id = r.rack_id
       AND x.shelf_level = g.s),
before AS (
  SELECT month_key, rack_id,
         {S.spread("sum(CAST(c > 0 AS INTEGER))")} * sum({S.mult('s')} * {S.crowd('c')} * {S.dim('s', 'w')} * v) AS p
  FROM grid GROUP BY 1, 2),
moved AS (
  SELECT f.month_key, f.rack_id, f.product_id, f.price_numeric, f.profit_margin_percentage,
         f.estimated_monthly_sales, f.product_width_cm, f.shelf_level AS original_shelf,
         b.s AS new_shelf, g.s, g.n, g.used, g.c AS c0,
         g.c - CAST(g.s = f.shelf_level AS INTEGER) + CAST(g.s = b.s AS INTEGER) AS c,
         CASE WHEN b.s = f.shelf_level THEN g.w ELSE
           g.w - CASE WHEN g.s = f.shelf_level THEN f.product_width_cm ELSE 0e0 END
               + CASE WHEN g.s = b.s THEN f.product_width_cm ELSE 0e0 END END AS w,
         CASE WHEN b.s = f.shelf_level THEN g.v ELSE
           g.v - CASE WHEN g.s = f.shelf_level THEN {_V} * {S.tier('price_numeric', 'g.s')} ELSE 0e0 END
               + CASE WHEN g.s = b.s THEN {_V} * {S.tier('price_numeric', 'g.s')} ELSE 0e0 END END AS v
  FROM retail f JOIN grid g ON g.month_key = f.month_key AND g.rack_id = f.rack_id
  CROSS JOIN (SELECT CAST(unnest([1, 2, 3, 4, 5, 6, 7]) AS INTEGER) AS s) b),
after AS (
  SELECT month_key, rack_id, product_id, original_shelf, new_shelf,
         any_value(price_numeric) AS price_numeric,
         any_value(profit_margin_percentage) AS profit_margin_percentage,
         any_value(estimated_monthly_sales) AS estimated_monthly_sales,
         any_value(product_width_cm) AS product_width_cm,
         CAST(max(CASE WHEN s = original_shelf THEN c0 END) AS BIGINT) AS n_products_on_original_shelf,
         CAST(max(CASE WHEN s = new_shelf THEN c0 END) AS BIGINT) AS n_products_on_new_shelf,
         any_value(used) AS n_shelves_used, CAST(any_value(n) AS BIGINT) AS rack_product_count,
         {S.spread("sum(CAST(c > 0 AS INTEGER))")} * sum(CASE WHEN c > 0 THEN
           {S.mult('s')} * {S.crowd('c')} * {S.dim('s', 'w')} * v ELSE 0e0 END) AS p
  FROM moved GROUP BY 1, 2, 3, 4, 5),
lifts AS (
  SELECT a.* EXCLUDE (p), CASE WHEN new_shelf = original_shelf THEN 0e0 ELSE a.p - b.p END AS lift
  FROM after a JOIN before b USING (month_key, rack_id))"""

_SAMPLE = f"""numbered_racks AS (
  SELECT month_key, rack_id, count(*) AS size,
         row_number() OVER (ORDER BY month_key, rack_id) AS rack_no
  FROM retail GROUP BY 1, 2),
numbered AS (
  SELECT month_key, rack_id, product_id,
         row_number() OVER (PARTITION BY month_key, rack_id ORDER BY product_id) AS product_no
  FROM retail),
draws AS (
  SELECT d AS draw_id,
         CAST(floor({S.uniform('42r', 'd')} * (SELECT count(*) FROM numbered_racks)) AS BIGINT) + 1 AS rack_no,
         {S.uniform('42p', 'd')} AS up,
         CAST(floor({S.uniform('42s', 'd')} * 7) AS INTEGER) + 1 AS new_shelf
  FROM (SELECT unnest(range(greatest(20000, 3 * (SELECT count(*) FROM retail)))) AS d))
"""

ORACLES = {
    **{name: S.query(f"SELECT month_key, product_id, {sql} AS {column} FROM retail", S.PLANOGRAM)
       for name, (column, _, _, sql) in _FACTORS.items()},
    "g1_shelf_stats": S.query("""SELECT month_key, rack_id, shelf_level, count(*) AS n_products,
  sum(product_width_cm) AS width_cm,
  count(*) OVER (PARTITION BY month_key, rack_id) AS n_shelves_used
FROM retail GROUP BY 1, 2, 3""", S.PLANOGRAM),
    "g2_rack_profit": S.query(
        f"SELECT month_key, rack_id, n_products, n_shelves_used, {S.half_up('profit', 4)} AS profit "
        "FROM profits", S.PLANOGRAM, S.rack_profit_cte("retail", _MONTH_RACK)),
    "g2_rack_profit_all_months": S.query(
        f"SELECT rack_id, n_products, n_shelves_used, {S.half_up('profit', 2)} AS profit "
        "FROM profits", S.PLANOGRAM, S.rack_profit_cte("retail", "rack_id")),
    "g3_shelf_profit": _shelf_oracle("count(*) OVER (PARTITION BY month_key, rack_id)"),
    "g3_shelf_profit_single": _shelf_oracle("1"),
    "f1_filtered_rows": S.query(
        "SELECT * FROM retail WHERE shelf_level = 4 AND category = 'ECONOMY'", S.PLANOGRAM),
    "f3_shelf_violations": S.query("""SELECT month_key, rack_id, shelf_level,
  sum(product_width_cm) AS total_cm FROM retail
GROUP BY 1, 2, 3 HAVING sum(product_width_cm) > 300""", S.PLANOGRAM),
    "f4_racks_with_min_products": S.query("""SELECT month_key, rack_id, product_id FROM retail
QUALIFY count(*) OVER (PARTITION BY month_key, rack_id) >= 25""", S.PLANOGRAM),
    "g15_largest_rack": S.query("""SELECT month_key, rack_id, count(*) AS n_products
FROM retail GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 1""", S.PLANOGRAM),
    "t5_head_of_rack": S.query("""SELECT month_key, rack_id, product_id,
  CAST(row_number() OVER (PARTITION BY month_key, rack_id ORDER BY product_id) AS INTEGER) AS row_no
FROM retail QUALIFY row_no <= 20""", S.PLANOGRAM),
    "s6_head_n": S.query(
        "SELECT month_key, product_id FROM retail ORDER BY 1, 2 LIMIT 100", S.PLANOGRAM),
    "m1_j6_move_lift": S.query(
        f"SELECT * EXCLUDE (lift), {S.half_up('lift', 4)} AS profit_lift FROM lifts",
        S.PLANOGRAM, _MOVES),
    "m2_training_sample": S.query(f"""SELECT draw_id, n.month_key, n.rack_id, n.product_id,
  l.original_shelf, l.new_shelf, {S.half_up('lift', 4)} AS profit_lift
FROM draws JOIN numbered_racks r USING (rack_no)
JOIN numbered n ON n.month_key = r.month_key AND n.rack_id = r.rack_id
     AND n.product_no = CAST(floor(up * size) AS BIGINT) + 1
JOIN lifts l ON l.month_key = n.month_key AND l.rack_id = n.rack_id
     AND l.product_id = n.product_id AND l.new_shelf = draws.new_shelf""",
                                  S.PLANOGRAM, _MOVES, _SAMPLE),
    "m6_uniform_noise": S.query(
        f"SELECT month_key, product_id, {S.uniform(42, 'month_key', 'product_id')} AS u FROM retail",
        S.PLANOGRAM),
    "u5_hash_split": S.query(f"""SELECT month_key,
  CASE WHEN {S.uniform(42, 'month_key', 'product_id')} < 0.85e0 THEN 'train' ELSE 'test' END AS part,
  count(*) AS n FROM retail GROUP BY 1, 2""", S.PLANOGRAM),
    "u5_month_split": S.query("""SELECT CASE WHEN month_key < '2000_01' THEN 'train' ELSE 'test' END AS part,
  count(*) AS n, min(month_key) AS first_month, max(month_key) AS last_month
FROM retail GROUP BY 1""", S.PLANOGRAM),
}
