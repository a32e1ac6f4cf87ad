"""Overflow repair, greedy, scored and ensemble layouts, and their comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from ... import constants as K
from ...functions.numbers import half_up
from ...operators import layout as L, whatif as W
from ...operators.profit import rack_profit, shelf_counts
from ...session import written
from .. import tables as T
from . import sql as S
from .physics import _MOVES

_OUT = ["month_key", "rack_id", "product_id", "shelf_level"]


def _wide(spark, d):
    """The planogram with triple widths, so that most racks overflow; written once."""
    return written(T.planogram(spark, d).withColumn(
        "product_width_cm", F.col("product_width_cm") * 3))


def _scored_rows(spark, d):
    scored = W.with_move_scores(T.planogram(spark, d))
    return written(scored.withColumn("scores", F.transform("scores", lambda x: half_up(x, 4))))


def _greedy(spark, d):
    return L.greedy_layout(_wide(spark, d))


def _aligned(spark, d):
    df = _wide(spark, d)
    return L.align_layouts(df, L.greedy_layout(df))


def _layouts(spark, d):
    """Original, greedy and repaired layouts in one table."""
    df = _wide(spark, d)
    return (df.withColumn("model", F.lit("Original"))
            .unionByName(L.greedy_layout(df).withColumn("model", F.lit("GREEDY")))
            .unionByName(L.repair(df, "worst_fit").withColumn("model", F.lit("REPAIRED"))))


def _best(spark, d):
    return L.best_layout(_layouts(spark, d)).select("model", half_up("profit", 2).alias("profit"))


def _baseline(spark, d):
    return L.random_baseline(_wide(spark, d), 5, 42).select(
        "month_key", "rack_id", half_up("mean_profit", 4).alias("mean_profit"),
        half_up("valid_share", 4).alias("valid_share"))


def _marginal(spark, d):
    return rack_profit(L.marginal_layout(_wide(spark, d))).select(
        "month_key", "rack_id", half_up("profit", 4).alias("profit"))


def _masked(spark, d):
    """Scores that leave out every third shelf, a different third per product."""
    rows = _scored_rows(spark, d)
    return rows.withColumn("scores", F.transform("scores", lambda x, i: F.when(
        (F.col("product_id") + i) % 3 != 0, x)))


def _unknown_shelves(spark, d):
    """Every fifth product stands on a shelf that the rack does not have."""
    return _wide(spark, d).withColumn("shelf_level", F.when(
        F.col("product_id") % 5 == 0, 9).otherwise(F.col("shelf_level")))


def _narrow(spark, d):
    """Every fourth product is half a centimetre wide, every seventh has no width."""
    return _wide(spark, d).withColumn("product_width_cm", F.when(
        F.col("product_id") % 7 == 0, None).when(F.col("product_id") % 4 == 0, 0.5).otherwise(
        F.col("product_width_cm")))


QUERIES = {
    "a1_narrow_widths": lambda s, d: L.repair(_narrow(s, d), "first_fit").select(_OUT),
    "a3_unknown_shelf": lambda s, d: L.greedy_layout(_unknown_shelves(s, d)).select(_OUT),
    "a4_masked_scores": lambda s, d: L.scored_layout(_masked(s, d)).select(_OUT),
    "a1_repair_first_fit": lambda s, d: L.repair(_wide(s, d), "first_fit").select(_OUT),
    "a2_repair_worst_fit": lambda s, d: L.repair(_wide(s, d), "worst_fit").select(_OUT),
    "f9_repair_report": lambda s, d: L.repair_report(_wide(s, d)),
    "a3_w4_greedy_layout": lambda s, d: _greedy(s, d).select(_OUT),
    "a3_greedy_layout_repaired": lambda s, d: L.greedy_layout(
        _wide(s, d).drop("name", "category"), repair_after=True).select(_OUT),
    "a4_scored_layout": lambda s, d: L.scored_layout(_scored_rows(s, d)).select(_OUT),
    "a4_marginal_layout": _marginal,
    "a5_ensemble_layout": lambda s, d: L.ensemble_layout(_scored_rows(s, d)).select(_OUT),
    "a6_random_baseline": _baseline,
    "j4_align_layouts": lambda s, d: _aligned(s, d),
    "g16_shelf_transitions": lambda s, d: L.shelf_transitions(_aligned(s, d)),
    "g4_shelf_counts": lambda s, d: shelf_counts(
        written(_layouts(s, d).select("model", "shelf_level")),
        ["Original", "GREEDY", "REPAIRED"]),
    "g18_best_layout": _best,
}

_WIDE = """wide AS (SELECT * REPLACE (product_width_cm * 3 AS product_width_cm) FROM retail)"""
_ROOM = "[300e0, 300e0, 300e0, 300e0, 300e0, 300e0, 300e0]"


def _items(source: str, order: str, where: str = "TRUE", extra: str = "",
           rack: str = "month_key, rack_id") -> str:
    return f"""items AS MATERIALIZED (
  SELECT {rack}, product_id, shelf_level AS s, product_width_cm AS w{extra},
         row_number() OVER (PARTITION BY {rack} ORDER BY {order}) AS rn
  FROM {source} WHERE {where})"""


def _steps(choice: str, start: str, update: str, rack: str = "month_key, rack_id",
           extra: str = "", prefix: str = "") -> str:
    """A recursive walk over the items of every rack."""
    on = " AND ".join(f"i.{k.strip()} = st.{k.strip()}" for k in rack.split(","))
    cols = ", ".join(f"i.{k.strip()}" for k in rack.split(","))
    return f"""{prefix}steps AS (
  SELECT {rack}, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS product_id, 0 AS new_shelf,
         {start}
  UNION ALL
  SELECT {rack}, rn, product_id, to_shelf,
         list_transform([1, 2, 3, 4, 5, 6, 7], lambda z: {update})
  FROM (SELECT {cols}, i.rn, i.product_id, i.s, i.w, st.room, {choice} AS to_shelf
        FROM steps st JOIN items i ON {on} AND i.rn = st.rn + 1) x)"""


_RACKS = f"{_ROOM} AS room FROM (SELECT DISTINCT month_key, rack_id FROM items)"
_TAKE = "room[z] - CASE WHEN z = to_shelf THEN w ELSE 0e0 END"

_GREEDY_CHOICE = """CASE WHEN i.s IN (3, 4, 5) THEN i.s
  WHEN st.room[3] >= i.w THEN 3 WHEN st.room[4] >= i.w THEN 4 WHEN st.room[5] >= i.w THEN 5
  WHEN i.s IN (1, 2) AND st.room[6] >= i.w THEN 6
  WHEN i.s IN (1, 2) AND st.room[7] >= i.w THEN 7 ELSE i.s END"""

_FIRST_CHOICE = ("CASE WHEN st.room[i.s] >= 0 THEN i.s "
                 + " ".join(f"WHEN i.s <> {z} AND st.room[{z}] >= i.w THEN {z}"
                            for z in K.SHELVES) + " ELSE i.s END")
_MOST = "greatest(" + ", ".join(
    f"CASE WHEN i.s <> {z} THEN st.room[{z}] END" for z in K.SHELVES) + ")"
_WORST_CHOICE = (f"CASE WHEN st.room[i.s] >= 0 OR {_MOST} < i.w THEN i.s "
                 + " ".join(f"WHEN i.s <> {z} AND st.room[{z}] = {_MOST} THEN {z}"
                            for z in K.SHELVES) + " ELSE i.s END")
_TOP_SCORE = "greatest(" + ", ".join(
    f"CASE WHEN st.room[{z}] >= i.w THEN i.sc[{z}] END" for z in K.SHELVES) + ")"
_SCORE_CHOICE = ("CASE " + " ".join(
    f"WHEN st.room[{z}] >= i.w AND i.sc[{z}] = {_TOP_SCORE} THEN {z}" for z in K.SHELVES)
    + " ELSE i.s END")

_ORDER = f"{S.BASE} DESC, product_id"
_FREE = ", ".join(
    S.half_up(f"300e0 - coalesce(sum(product_width_cm) FILTER (shelf_level = {z}), 0e0)", 4)
    for z in K.SHELVES)
_REPAIR_START = (f"room FROM (SELECT month_key, rack_id, [{_FREE}] AS room "
                 "FROM wide GROUP BY 1, 2)")

_SHIFT = (f"CASE WHEN to_shelf <> s AND z = s THEN {S.half_up('room[z] + w', 4)} "
          f"WHEN to_shelf <> s AND z = to_shelf THEN {S.half_up('room[z] - w', 4)} ELSE room[z] END")
_REPAIR_ITEMS = _items("wide", "shelf_level, product_width_cm DESC, product_id")
_GREEDY_CTES = (_items("wide", _ORDER), _steps(_GREEDY_CHOICE, _RACKS, _TAKE))
_RESULT = ("SELECT month_key, rack_id, product_id, new_shelf AS shelf_level "
           "FROM steps WHERE rn > 0")


def _recursive(body: str, *ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + body


def _repaired(choice: str, body: str = _RESULT, *more: str) -> str:
    return _recursive(body, S.PLANOGRAM, _WIDE, _REPAIR_ITEMS,
                      _steps(choice, _REPAIR_START, _SHIFT), *more)


def _greedy_sql(body: str, *more: str) -> str:
    return _recursive(body, S.PLANOGRAM, _WIDE, *_GREEDY_CTES, *more)


_ALIGNED = """aligned AS (
  SELECT o.month_key, o.rack_id, o.product_id, o.name, o.product_width_cm,
         o.shelf_level AS orig_shelf, st.new_shelf, o.shelf_level <> st.new_shelf AS moved
  FROM wide o JOIN steps st ON st.month_key = o.month_key AND st.rack_id = o.rack_id
       AND st.product_id = o.product_id)"""

# The greedy walk and the worst-fit repair side by side with the original.
_SECOND_ITEMS = _REPAIR_ITEMS.replace("items AS", "items2 AS")
_SECOND_STEPS = (_steps(_WORST_CHOICE, _REPAIR_START, _SHIFT)
                 .replace("steps AS (", "steps2 AS (").replace("FROM steps st", "FROM steps2 st")
                 .replace("JOIN items i", "JOIN items2 i"))
_LAYOUTS = """layouts AS (
  SELECT 'Original' AS model, * FROM wide
  UNION ALL
  SELECT 'GREEDY', w.* REPLACE (st.new_shelf AS shelf_level)
  FROM wide w JOIN steps st USING (month_key, rack_id, product_id)
  UNION ALL
  SELECT 'REPAIRED', w.* REPLACE (st.new_shelf AS shelf_level)
  FROM wide w JOIN steps2 st USING (month_key, rack_id, product_id))"""

_SCORES = f"""scored AS (
  SELECT f.*, l.sc FROM retail f JOIN (
    SELECT month_key, rack_id, product_id, list({S.half_up('lift', 4)} ORDER BY new_shelf) AS sc
    FROM lifts GROUP BY 1, 2, 3) l USING (month_key, rack_id, product_id))"""


def _normal(shelf: int) -> str:
    """Normals 1-4 come from the hash with suffix 0, 5-7 from the one with suffix 1."""
    part, place = divmod(shelf - 1, 4)
    keys = ("month_key", "rack_id", "product_id", "candidate", str(part))
    text = " || '|' || ".join(["'42'"] + [f"CAST({k} AS VARCHAR)" for k in keys])

    def u(i: int) -> str:
        return f"(CAST(('0x' || substr(md5({text}), {8 * i + 1}, 8)) AS BIGINT) / 4294967296e0)"

    pair = 2 * (place // 2)
    turn = "cos" if place % 2 == 0 else "sin"
    return f"(sqrt(-2e0 * ln(1e0 - {u(pair)})) * {turn}(6.283185307179586e0 * {u(pair + 1)}))"


_NOISY = "[" + ", ".join(
    f"sc[{z}] + candidate * 5e0 * {_normal(z)}" for z in K.SHELVES) + "]"
_CANDIDATE_RACK = "month_key, rack_id, candidate"
_CANDIDATES = f"""candidates AS (
  SELECT scored.* REPLACE (CASE WHEN candidate = 0 THEN sc ELSE {_NOISY} END AS sc), candidate
  FROM scored CROSS JOIN (SELECT unnest([0, 1, 2, 3, 4]) AS candidate) c)"""

_BASELINE = f"""runs AS (
  SELECT retail.* REPLACE (product_width_cm * 3 AS product_width_cm,
         1 + CAST(floor({S.uniform(42, 'run', 'month_key', 'rack_id', 'product_id')} * 7) AS INTEGER) AS shelf_level),
         run FROM retail CROSS JOIN (SELECT unnest([1, 2, 3, 4, 5]) AS run) r)"""

_UNKNOWN = ("odd AS (SELECT * REPLACE (CASE WHEN product_id % 5 = 0 THEN 9 ELSE shelf_level END "
            "AS shelf_level) FROM wide)")
_NARROW = """narrow AS (SELECT * REPLACE (CASE WHEN product_id % 7 = 0 THEN NULL
  WHEN product_id % 4 = 0 THEN 0.5e0 ELSE product_width_cm END AS product_width_cm) FROM wide)"""
_MASKED = """masked AS (SELECT * REPLACE (list_transform(sc, lambda x, i:
  CASE WHEN (product_id + i - 1) % 3 <> 0 THEN x END) AS sc) FROM scored)"""

def _marginal_steps() -> str:
    """The marginal walk: every option's rack profit from the shelf sums so far."""
    def value(n: str, w: str, v: str) -> str:
        return (f"CASE WHEN {n} > 0 THEN {S.mult('z')} * {S.crowd(n)} * {S.dim('z', w)} * ({v}) "
                "ELSE 0e0 END")

    own = "base * " + S.tier("price", "z")
    gained = value("(n[z] + 1)", "(sw[z] + w)", f"v[z] + {own}")
    opens = "used + CASE WHEN n[z] > 0 THEN 0 ELSE 1 END"
    profit = S.half_up(f"{S.spread(opens)} * (total - g[z] + {gained})", 4)
    shelves = "[1, 2, 3, 4, 5, 6, 7]"
    zero = "[0e0, 0e0, 0e0, 0e0, 0e0, 0e0, 0e0]"

    def added(name: str, amount: str) -> str:
        return (f"list_transform({shelves}, lambda z: {name}[z] + "
                f"CASE WHEN z = best THEN {amount} ELSE 0 END)")

    return f"""steps AS (
  SELECT month_key, rack_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS product_id,
         0 AS new_shelf, {_ROOM} AS room, [0, 0, 0, 0, 0, 0, 0] AS n, {zero} AS sw, {zero} AS v
  FROM (SELECT DISTINCT month_key, rack_id FROM items)
  UNION ALL
  SELECT month_key, rack_id, rn, product_id, coalesce(best, s),
         list_transform({shelves}, lambda z: room[z] - CASE WHEN z = coalesce(best, s) THEN w ELSE 0e0 END),
         {added('n', '1')}, {added('sw', 'w')}, {added('v', 'base * ' + S.tier('price', 'z'))}
  FROM (SELECT *, CASE WHEN list_max(options) IS NOT NULL THEN list_position(options, list_max(options)) END AS best
    FROM (SELECT *, list_transform({shelves}, lambda z: CASE WHEN room[z] >= w THEN {profit} END) AS options
      FROM (SELECT *, list_sum(g) AS total, len(list_filter(n, lambda x: x > 0)) AS used
        FROM (SELECT i.month_key, i.rack_id, i.rn, i.product_id, i.s, i.w, i.price, i.base,
                     st.room, st.n, st.sw, st.v,
                     list_transform({shelves}, lambda z: {value('st.n[z]', 'st.sw[z]', 'st.v[z]')}) AS g
              FROM steps st JOIN items i ON i.month_key = st.month_key AND i.rack_id = st.rack_id
                   AND i.rn = st.rn + 1) a) b) c) d)"""


ORACLES = {
    "a4_marginal_layout": _recursive(
        f"SELECT month_key, rack_id, {S.half_up('profit', 4)} AS profit FROM profits",
        S.PLANOGRAM, _WIDE, _items("wide", _ORDER, extra=f", price_numeric AS price, {S.BASE} AS base"),
        _marginal_steps(),
        "placed AS (SELECT w.* REPLACE (st.new_shelf AS shelf_level) FROM wide w "
        "JOIN steps st USING (month_key, rack_id, product_id))",
        S.rack_profit_cte("placed", "month_key, rack_id")),
    "a1_narrow_widths": _recursive(
        _RESULT + """ UNION ALL SELECT month_key, rack_id, product_id, shelf_level FROM narrow
WHERE product_width_cm IS NULL""",
        S.PLANOGRAM, _WIDE, _NARROW,
        _REPAIR_ITEMS.replace("FROM wide WHERE TRUE",
                              "FROM narrow WHERE product_width_cm IS NOT NULL"),
        _steps(_FIRST_CHOICE, _REPAIR_START.replace("FROM wide", "FROM narrow"), _SHIFT)),
    "a3_unknown_shelf": _recursive(
        _RESULT, S.PLANOGRAM, _WIDE, _UNKNOWN, _items("odd", _ORDER),
        _steps(_GREEDY_CHOICE, _RACKS, _TAKE)),
    "a4_masked_scores": _recursive(
        _RESULT, S.PLANOGRAM, _MOVES, _SCORES, _MASKED, _items("masked", _ORDER, extra=", sc"),
        _steps(_SCORE_CHOICE, _RACKS, _TAKE)),
    "a1_repair_first_fit": _repaired(_FIRST_CHOICE),
    "a2_repair_worst_fit": _repaired(_WORST_CHOICE),
    "f9_repair_report": _repaired(_FIRST_CHOICE, """SELECT n_before, n_after, n_before - n_after AS n_fixed
FROM (SELECT count(*) AS n_before FROM (
        SELECT 1 FROM wide GROUP BY month_key, rack_id, shelf_level HAVING sum(product_width_cm) > 300) a),
     (SELECT count(*) AS n_after FROM (
        SELECT 1 FROM wide w JOIN steps st USING (month_key, rack_id, product_id)
        GROUP BY month_key, rack_id, new_shelf HAVING sum(product_width_cm) > 300) b)"""),
    "a3_w4_greedy_layout": _greedy_sql(_RESULT),
    "a3_greedy_layout_repaired": _greedy_sql(
        _RESULT.replace("steps", "steps2"),
        "placed AS (SELECT w.* REPLACE (st.new_shelf AS shelf_level) FROM wide w "
        "JOIN steps st USING (month_key, rack_id, product_id))",
        _SECOND_ITEMS.replace("FROM wide", "FROM placed"),
        _SECOND_STEPS.replace(_WORST_CHOICE, _FIRST_CHOICE).replace("FROM wide", "FROM placed")),
    "a4_scored_layout": _recursive(
        _RESULT, S.PLANOGRAM, _MOVES, _SCORES, _items("scored", _ORDER, extra=", sc"),
        _steps(_SCORE_CHOICE, _RACKS, _TAKE)),
    "a5_ensemble_layout": _recursive(
        "SELECT month_key, rack_id, product_id, shelf_level FROM placed "
        "JOIN best USING (month_key, rack_id, candidate)",
        S.PLANOGRAM, _MOVES, _SCORES, _CANDIDATES,
        _items("candidates", _ORDER, extra=", sc", rack=_CANDIDATE_RACK),
        _steps(_SCORE_CHOICE, _RACKS.replace("month_key, rack_id", _CANDIDATE_RACK), _TAKE,
               rack=_CANDIDATE_RACK),
        """sized AS (SELECT c.*, count(*) OVER (PARTITION BY month_key, rack_id, candidate) AS size
  FROM candidates c),
placed AS (SELECT c.* REPLACE (CASE WHEN size >= 2 THEN st.new_shelf ELSE c.shelf_level END AS shelf_level)
  FROM sized c JOIN steps st USING (month_key, rack_id, candidate, product_id))""",
        S.rack_profit_cte("placed", _CANDIDATE_RACK),
        f"""best AS (SELECT month_key, rack_id, candidate FROM profits
  QUALIFY row_number() OVER (PARTITION BY month_key, rack_id
    ORDER BY {S.half_up('profit', 4)} DESC, candidate) = 1)"""),
    "a6_random_baseline": S.query(f"""SELECT month_key, rack_id,
  {S.half_up('avg(profit)', 4)} AS mean_profit,
  {S.half_up('avg(CASE WHEN widest > 300 THEN 0e0 ELSE 1e0 END)', 4)} AS valid_share
FROM profits JOIN (SELECT month_key, rack_id, run, max(w) AS widest FROM (
  SELECT month_key, rack_id, run, shelf_level, sum(product_width_cm) AS w
  FROM runs GROUP BY 1, 2, 3, 4) x GROUP BY 1, 2, 3) v USING (month_key, rack_id, run)
GROUP BY 1, 2""", S.PLANOGRAM, _BASELINE, S.rack_profit_cte("runs", "month_key, rack_id, run")),
    "j4_align_layouts": _greedy_sql("SELECT * FROM aligned", _ALIGNED),
    "g16_shelf_transitions": _greedy_sql(
        "SELECT orig_shelf, new_shelf, moved, count(*) AS n_products FROM aligned GROUP BY 1, 2, 3",
        _ALIGNED),
    "g4_shelf_counts": _greedy_sql("""SELECT shelf_level,
  count(*) FILTER (model = 'Original') AS "Original",
  count(*) FILTER (model = 'GREEDY') AS "GREEDY",
  count(*) FILTER (model = 'REPAIRED') AS "REPAIRED"
FROM layouts GROUP BY 1""", _SECOND_ITEMS, _SECOND_STEPS, _LAYOUTS),
    "g18_best_layout": _greedy_sql(
        f"SELECT model, {S.half_up('sum(profit)', 2)} AS profit FROM profits "
        "WHERE model = 'REPAIRED' GROUP BY 1",
        _SECOND_ITEMS, _SECOND_STEPS, _LAYOUTS,
        S.rack_profit_cte("layouts", "model, month_key, rack_id")),
}
