"""Shelf assignment per rack: overflow repair, greedy, scored and ensemble layouts.

Placing products is sequential inside a rack, since each step depends on the room
that is left, and independent across racks. The sequential step sees the
*candidates* of a rack only and returns its moves; all other rows keep their
shelf. Greedy, scored and ensemble layouts share one step, which ``walk`` takes
for all racks of an Arrow batch together. Repair and the marginal layout are array
folds per rack.

Candidates are an exact bound, not a cut. Room on a shelf only shrinks, so once
a product finds no room, later products of the same width from the same shelf that may
go to the same shelves find none either. A rack has 7 x 300 cm, so at most ``2100 / w``
such products of width ``w`` can be placed; ``300 / w`` more that stay use up what is left
of their own shelf. Later ones stay and change nothing. Thus the first ``2400 / w + 2``
rows per (rack, shelf, width, shelves allowed), in placement order, decide the layout
whatever the size of the rack. Products narrower than ``LIMITED_CM`` pass that limit.
Racks of up to ``WHOLE_RACK`` rows need no limit: all of their rows are candidates.

Where widths hardly repeat, narrower products decide as well: a product that finds room
leaves no earlier, narrower one of its shelf and shelves allowed without room. At most
2,100 cm of those can have been placed, and 300 more that stay leave nothing of their own
shelf. So a row is no candidate if such rows before it add up to more than 2,400 cm, counted
by classes of width (``_undominated``). The rows that prove this are candidates themselves.
A repair goes by width, widest first, so this second bound does not hold for it.

A product without a width takes no part: it stays and takes no room. A product on an
unknown shelf moves like any other, and takes no room while it stays.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import constants as K
from ..functions import physics as P
from ..functions.numbers import half_up, uniform
from ..session import written
from .profit import rack_profit, shelf_values, shelf_violations, width_total
from .ranking import ordered_blocks, top_n
from .walk import placement_task
from .whatif import rack_state

# Rows at least this wide are limited per group, before the shuffle: the limit has to be
# one literal.
LIMITED_CM = 1.0
# What can be placed and what uses up a shelf, in cm; groups wider than CROWDED_CM in all
# are narrowed by classes of width, as often as that halves them.
DECIDED_CM, CROWDED_CM = 2400.0, 24_000.0
CLASSES, ROUNDS = 64, 6
# A rack of up to so many rows is walked as a whole; only larger ones are narrowed first.
WHOLE_RACK = 200


def _shelves() -> Column:
    return F.array(*[F.lit(s) for s in K.SHELVES])


def _at(values: Column, shelf: Column) -> Column:
    return F.element_at(values, shelf)


def _candidates(df: DataFrame, rack_keys: Sequence[str], order: Sequence, key: str,
                allowed: Column | None = None, by_priority: bool = True,
                large: DataFrame | None = None) -> DataFrame:
    """The rows that can decide the layout, see the module text, and all of small racks.

    ``allowed`` stands for the shelves that a row may go to, where rows differ in that. With
    ``by_priority``, ``order`` is the order of placement and bounds crowded groups further.
    ``large`` are the keys of the racks to narrow, those beyond ``WHOLE_RACK`` rows unless given.
    """
    rows = df.filter(F.col("product_width_cm").isNotNull())
    if large is None:
        large = rows.groupBy(*rack_keys).agg(F.count(F.lit(1)).alias("_n")).filter(
            F.col("_n") > WHOLE_RACK).select(*rack_keys)
    if large.isEmpty():
        return rows
    large = written(large)
    whole = _in_groups(rows, large, rack_keys, "left_anti")
    return whole.unionByName(_narrowed(_in_groups(rows, large, rack_keys, "left_semi"), rack_keys,
                                       order, key, allowed, by_priority))


def _narrowed(df: DataFrame, rack_keys: Sequence[str], order: Sequence, key: str,
              allowed: Column | None, by_priority: bool) -> DataFrame:
    """The candidates of large racks."""
    width = F.col("product_width_cm")
    # A narrow row is a group of its own and thus within any limit.
    alone = F.when(width < LIMITED_CM, F.col(key))
    grouped = df.withColumns({
        "_alone": alone, "_allowed": F.lit(0) if allowed is None else allowed})
    limit = int(DECIDED_CM / LIMITED_CM) + 2
    rows = (top_n(grouped, [*rack_keys, "shelf_level", "product_width_cm", "_allowed", "_alone"],
                  order, limit, "_rn")
            .filter((width < LIMITED_CM) | (F.col("_rn") <= F.floor(F.lit(DECIDED_CM) / width) + 2))
            .drop("_rn", "_alone"))
    if by_priority:
        crowded = _crowded(grouped, [*rack_keys, "shelf_level", "_allowed"])
        if not crowded.isEmpty():
            rows = _undominated(rows, crowded, [*rack_keys, "shelf_level", "_allowed"], order)
    return rows.drop("_allowed")


def _crowded(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """Groups wider than ``CROWDED_CM``; a negative width rules its group out."""
    return (df.groupBy(*group).agg(F.sum("product_width_cm").alias("_cm"),
                                   F.min("product_width_cm").alias("_least"))
            .filter((F.col("_cm") > CROWDED_CM) & (F.col("_least") >= 0)).select(*group))


def _in_groups(df: DataFrame, groups: DataFrame, group: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on the group, NULL included."""
    named = groups.select(*[F.col(c).alias(f"_g_{c}") for c in group])
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in group))
    return df.join(named, same, how)


def _undominated(rows: DataFrame, crowded: DataFrame, group: Sequence[str],
                 order: Sequence) -> DataFrame:
    """``rows`` without those of ``crowded`` groups that narrower ones before them rule out.

    Widths are classed between the group's extremes. For every row, what earlier rows in
    lower classes add up to comes from sums over sampled ranges, so no group meets in a
    task. What is left of the lowest class is classed anew in the next round.
    """
    rest = _in_groups(rows, crowded, group, "left_anti")
    kept = _in_groups(rows, crowded, group, "left_semi")
    for _ in range(ROUNDS):
        blocked = ordered_blocks(kept, group, order)
        kept = written(_with_narrower(blocked, group, order).filter(
            F.col("_narrower") <= DECIDED_CM).drop("_narrower", "_block", "_class"))
        if kept.count() > blocked.count() / 2:
            break
    return rest.unionByName(kept)


def _with_narrower(blocked: DataFrame, group: Sequence[str], order: Sequence) -> DataFrame:
    """Adds ``_narrower``: the width of the group's earlier rows in lower classes of width."""
    width, group = F.col("product_width_cm"), list(group)
    ends = blocked.filter(width > 0).groupBy(*[F.col(c).alias(f"_e_{c}") for c in group]).agg(
        F.min("product_width_cm").alias("_low"), F.max("product_width_cm").alias("_high"))
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_e_{c}")) for c in group))
    scale = F.try_divide(F.ln(width / F.col("_low")), F.ln(F.col("_high") / F.col("_low")))
    classed = blocked.join(ends, same, "left").withColumn("_class", F.when(
        width > 0, F.least(F.lit(CLASSES - 1), F.floor(F.coalesce(scale, F.lit(0.0)) * CLASSES)))
        .otherwise(0).cast("int")).drop("_low", "_high", *[f"_e_{c}" for c in group])

    def sums(over: Window | None, prefix: str) -> list[Column]:
        each = [F.sum(F.when(F.col("_class") == i, width)) for i in range(CLASSES)]
        return [F.coalesce(x if over is None else x.over(over), F.lit(0.0)).alias(f"{prefix}{i}")
                for i, x in enumerate(each)]

    ahead = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = classed.groupBy(*group, "_block").agg(*sums(None, "_s")).select(
        *[F.col(c).alias(f"_e_{c}") for c in group], F.col("_block").alias("_of"), F.array(*[
            F.coalesce(F.sum(f"_s{i}").over(ahead), F.lit(0.0)) for i in range(CLASSES)])
        .alias("_ahead"))
    inside = Window.partitionBy(*group, "_block").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    lower = F.aggregate(
        F.slice(F.zip_with("_here", "_ahead", lambda a, b: a + b), F.lit(1), F.col("_class")),
        F.lit(0.0), lambda total, x: total + x)
    here = classed.select("*", *sums(inside, "_h")).withColumn(
        "_here", F.array(*[f"_h{i}" for i in range(CLASSES)])).drop(
        *[f"_h{i}" for i in range(CLASSES)])
    return (here.join(blocks, same & (F.col("_block") == F.col("_of")))
            .withColumn("_narrower", lower)
            .drop("_here", "_ahead", "_of", *[f"_e_{c}" for c in group]))


def beyond_candidates(df: DataFrame, rack_keys: Sequence[str],
                      allowed: Column | None = None) -> DataFrame:
    """Keys of the racks that may have rows beyond their candidates; sums per group only."""
    width = F.col("product_width_cm")
    groups = df.filter(width.isNotNull()).withColumn(
        "_allowed", F.lit(0) if allowed is None else allowed)
    equal = (groups.filter(width >= LIMITED_CM).groupBy(*rack_keys, "shelf_level", "product_width_cm", "_allowed")
             .agg(F.count(F.lit(1)).alias("_n"))
             .filter(F.col("_n") > F.floor(F.lit(DECIDED_CM) / width) + 2).select(*rack_keys))
    crowded = _crowded(groups, [*rack_keys, "shelf_level", "_allowed"]).select(*rack_keys)
    return equal.unionByName(crowded).distinct()


def _known_shelf() -> Column:
    """The shelf, 0 for an unknown one."""
    shelf = F.col("shelf_level")
    return F.when(shelf.between(1, K.NUM_SHELVES), shelf).otherwise(0)


def _moves_type(df: DataFrame, key: str) -> str:
    return f"array<struct<{key}:{df.schema[key].dataType.simpleString()},shelf_level:int>>"


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``."""
    return F.transform(F.array(value), body)[0]


def _add_at(values: Column, shelf: Column, amount: Column) -> Column:
    return F.transform(values, lambda v, i: F.when(i + 1 == shelf, v + amount).otherwise(v))


def _moves_with(moves: Column, item: Column, key: str, shelf: Column) -> Column:
    """Append ``item -> shelf`` unless it stays where it was."""
    move = F.struct(item[key].alias(key), shelf.cast("int").alias("shelf_level"))
    return F.when(shelf == item["shelf"], moves).otherwise(F.concat(moves, F.array(move)))


def _unfold(folded: DataFrame, rack_keys: Sequence[str]) -> DataFrame:
    """One row per move.

    The outer form keeps Spark from testing the array for being empty first, which
    would run the fold a second time.
    """
    return folded.select(*rack_keys, F.inline_outer("moves")).filter(
        F.col("shelf_level").isNotNull())


def apply_moves(df: DataFrame, moves: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS,
                key: str = "product_id") -> DataFrame:
    """The layout after the moves; rows without a move keep their shelf."""
    moved = moves.withColumnRenamed("shelf_level", "_new_shelf")
    joined = df.join(moved, [*rack_keys, key], "left")
    return joined.withColumn(
        "shelf_level", F.coalesce("_new_shelf", "shelf_level")).select(*df.columns)


# --- overflow repair ------------------------------------------------------------

def _first_fit(used: Column, shelf: Column, width: Column) -> Column:
    """The lowest other shelf with room."""
    fits = F.filter(_shelves(), lambda z: (z != shelf)
                    & (half_up(_at(used, z) + width, 4) <= K.SHELF_WIDTH_CM))
    return F.try_element_at(fits, F.lit(1))


def _worst_fit(used: Column, shelf: Column, width: Column) -> Column:
    """The other shelf with most room, if the product fits there."""
    best = F.array_max(F.transform(
        F.filter(_shelves(), lambda z: z != shelf),
        lambda z: F.struct(half_up(F.lit(K.SHELF_WIDTH_CM) - _at(used, z), 4).alias("room"),
                           (-z).alias("z"))))
    return _bind(best, lambda b: F.when(b["room"] >= width, -b["z"]))


_CHOOSERS = {"first_fit": _first_fit, "worst_fit": _worst_fit}


def repair_moves(df: DataFrame, rule: str = "first_fit",
                 rack_keys: Sequence[str] = K.RACK_KEYS, key: str = "product_id") -> DataFrame:
    """Moves that bring overflowing shelves back to 300 cm, widest product first.

    Only racks with an overflowing shelf, and of these only the rows on such
    shelves, reach the fold. The racks are written once; their file is far smaller than they
    are, so Spark is told not to broadcast them.
    """
    choose = _CHOOSERS[rule]
    shelves = (df.filter(F.col("shelf_level").between(1, K.NUM_SHELVES))
               .groupBy(*rack_keys, "shelf_level").agg(width_total().alias("_w"),
                                                       F.count("product_width_cm").alias("_n")))
    used = shelves.groupBy(*rack_keys).agg(F.array(*[
        F.coalesce(F.max(F.when(F.col("shelf_level") == s, F.col("_w"))), F.lit(0.0))
        for s in K.SHELVES]).alias("used"),
        F.sum(F.when(F.col("_w") > K.SHELF_WIDTH_CM, F.col("_n"))).alias("_rows"))
    racks = written(used.filter(F.exists("used", lambda w: w > K.SHELF_WIDTH_CM)))
    over, large = racks.drop("_rows"), racks.filter(F.col("_rows") > WHOLE_RACK).select(*rack_keys)
    rows = (df.select(*rack_keys, key, "shelf_level", "product_width_cm")
            .join(over.hint("merge"), list(rack_keys))
            .filter(F.try_element_at("used", F.col("shelf_level")) > K.SHELF_WIDTH_CM))
    item = F.struct(F.col("shelf_level").alias("shelf"),
                    (-F.col("product_width_cm")).alias("neg_width"), F.col(key))
    racks = _candidates(rows, rack_keys, [key], key, by_priority=False,
                        large=large).groupBy(*rack_keys).agg(
        F.first("used").alias("used"), F.sort_array(F.collect_list(item)).alias("items"))
    start = F.struct(F.col("used").alias("used"),
                     F.array().cast(_moves_type(df, key)).alias("moves"))

    def step(state: Column, x: Column) -> Column:
        width = -x["neg_width"]
        wanted = F.when(_at(state["used"], x["shelf"]) > K.SHELF_WIDTH_CM,
                        choose(state["used"], x["shelf"], width))
        def moved(to: Column) -> Column:
            used = F.transform(state["used"], lambda u, i: F.when(
                (i + 1 == to) & (to != x["shelf"]), half_up(u + width, 4)).when(
                (i + 1 == x["shelf"]) & (to != x["shelf"]), half_up(u - width, 4)).otherwise(u))
            return F.struct(used.alias("used"),
                            _moves_with(state["moves"], x, key, to).alias("moves"))

        return _bind(F.coalesce(wanted, x["shelf"]), moved)

    folded = racks.select(*rack_keys, F.aggregate("items", start, step)["moves"].alias("moves"))
    return _unfold(folded, rack_keys)


def repair(df: DataFrame, rule: str = "first_fit", rack_keys: Sequence[str] = K.RACK_KEYS,
           key: str = "product_id") -> DataFrame:
    """The layout after overflow repair; products that fit nowhere stay."""
    return apply_moves(df, repair_moves(df, rule, rack_keys, key), rack_keys, key)


def repair_report(df: DataFrame, rule: str = "first_fit",
                  rack_keys: Sequence[str] = K.RACK_KEYS, key: str = "product_id") -> DataFrame:
    """Overflowing shelves before and after the repair."""
    def count(frame: DataFrame, name: str) -> DataFrame:
        return shelf_violations(frame, rack_keys).agg(F.count(F.lit(1)).alias(name))

    fixed = repair(df, rule, rack_keys, key)
    after = count(fixed, "n_after").scalar()
    return (count(df, "n_before").withColumn("n_after", after)
            .withColumn("n_fixed", F.col("n_before") - F.col("n_after")))


# --- greedy and scored layouts ---------------------------------------------------

def _racks_by_priority(df: DataFrame, rack_keys: Sequence[str], key: str,
                       extras: Sequence) -> DataFrame:
    """One row per rack: its candidates as ``items``, highest base profit first.

    A product without a base profit comes last.
    """
    ranked = df.withColumn("_order", F.coalesce(-P.base_profit(), F.lit(float("inf"))))
    chosen = _candidates(ranked, rack_keys, ["_order", key], key)
    item = F.struct(F.col("_order").alias("order"), F.col(key), _known_shelf().alias("shelf"),
                    F.col("product_width_cm").alias("width"), *extras)
    return chosen.groupBy(*rack_keys).agg(F.sort_array(F.collect_list(item)).alias("items"))


def _no_moves(df: DataFrame, key: str) -> Column:
    return F.array().cast(_moves_type(df, key)).alias("moves")


def _fold_by_priority(df: DataFrame, rack_keys: Sequence[str], key: str,
                      extras: Sequence, state: dict[str, Column], step) -> DataFrame:
    """Fold every rack's candidates in priority order; returns the moves."""
    racks = _racks_by_priority(df, rack_keys, key, extras)
    start = F.struct(*[v.alias(k) for k, v in state.items()], _no_moves(df, key))
    folded = racks.select(*rack_keys, F.aggregate("items", start, step)["moves"].alias("moves"))
    return _unfold(folded, rack_keys)


def _full_room() -> Column:
    return F.array(*[F.lit(K.SHELF_WIDTH_CM)] * K.NUM_SHELVES)


def _noise_bits(seed: int, keys: Sequence[str], candidates: int) -> Column:
    """Two hashes of 128 bits per row and noisy candidate, for seven normals each."""
    def digest(candidate: int, part: int) -> Column:
        return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys],
                                 F.lit(str(candidate)), F.lit(str(part))))

    return F.unhex(F.concat(*[digest(c, part) for c in range(1, candidates + 1)
                              for part in (0, 1)]))


def _placement_moves(df: DataFrame, scores: Column, rack_keys: Sequence[str], key: str,
                     state: DataFrame | None = None,
                     noise_scale: Sequence[float] = (0.0,), seed: int = 0) -> DataFrame:
    """Moves of the placement walk: best product first, on the best shelf with room.

    With ``state``, the shelf sums per rack, several noisy candidates are
    placed and the one with the highest rack profit counts.
    """
    keys = [*rack_keys, key]
    ranked = df.withColumn("value", P.base_profit()).withColumn(
        "scores", F.coalesce(scores, F.array(*[F.lit(None).cast("double")] * K.NUM_SHELVES)))
    allowed = sum(F.when(F.isnan(s) | s.isNull(), 0).otherwise(1 << i)
                  for i, s in enumerate(F.get("scores", F.lit(i)) for i in range(K.NUM_SHELVES)))
    rows = _candidates(ranked, rack_keys, [F.desc("value"), key], key, allowed).select(
        *keys, "value", "scores", _known_shelf().alias("shelf"),
        F.col("product_width_cm").alias("width"), F.col("price_numeric").alias("price"))
    if state is not None:
        # One head row per rack, before its products, with the shelf sums as scores.
        sums = F.concat(F.col("shelf_n").cast("array<double>"), "shelf_w", "shelf_v")
        heads = state.select(*rack_keys, sums.alias("scores"),
                             F.lit(float("inf")).alias("value"))
        rows = heads.unionByName(rows, allowMissingColumns=True)
    # The window sorts by rack and placement order; the walk reads that order.
    placed = Window.partitionBy(*rack_keys).orderBy(F.desc("value"), key)
    rows = rows.withColumn("position", F.row_number().over(placed))
    rows = rows.sortWithinPartitions(*rack_keys, "position")
    if len(noise_scale) > 1:
        # Hashes do not compress: they are taken where the rows are placed.
        rows = rows.withColumn("noise", _noise_bits(seed, keys, len(noise_scale) - 1))
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keys)
    return rows.mapInArrow(placement_task(keys, list(noise_scale), state is not None),
                           f"{schema}, shelf_level int")


def greedy_moves(df: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS,
                 key: str = "product_id") -> DataFrame:
    """A shelf scores its multiplier where that beats the product's own shelf."""
    own = P.shelf_multiplier("shelf_level")
    better = F.array(*[F.when(own < m, F.lit(m)) for m in K.SHELF_MULTIPLIERS.values()])
    return _placement_moves(df, better, rack_keys, key)


def greedy_layout(df: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS,
                  key: str = "product_id", repair_after: bool = False) -> DataFrame:
    """Each product, best first, on the most visible better shelf with room.

    A product without a better shelf stays, even where its own shelf is full, so
    the result may overflow; ``repair_after=True`` writes it and runs the first-fit repair on it.
    """
    placed = apply_moves(df, greedy_moves(df, rack_keys, key), rack_keys, key)
    return repair(written(placed), "first_fit", rack_keys, key) if repair_after else placed


def scored_layout(df: DataFrame, scores: str = "scores",
                  rack_keys: Sequence[str] = K.RACK_KEYS, key: str = "product_id") -> DataFrame:
    """Each product, best first, on its highest-scored shelf with room.

    ``scores`` holds one score per shelf 1..7, from the exact lifts
    (``with_move_scores``) or a fitted model. The lowest shelf wins ties. A
    product that fits nowhere stays.
    """
    moves = _placement_moves(df, F.col(scores), rack_keys, key)
    rest = df.select(*[c for c in df.columns if c != scores])
    return apply_moves(rest, moves, rack_keys, key)


def marginal_layout(df: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS,
                    key: str = "product_id") -> DataFrame:
    """Each product, best first, where the rack profit placed so far gains most.

    The context of a step is the products placed within capacity before it. A
    product that fits nowhere stays and uses up room, but is no context. The
    lowest shelf wins ties up to summation noise.
    """
    zeros = F.array(*[F.lit(0.0)] * K.NUM_SHELVES)

    def step(state: Column, x: Column) -> Column:
        used = F.size(F.filter(state["n"], lambda n: n > 0))
        total = F.aggregate(state["g"], F.lit(0.0), lambda a, g: a + g)

        def option(z: Column) -> Column:
            g = P.shelf_value(z, _at(state["n"], z) + 1, _at(state["w"], z) + x["width"],
                              _at(state["v"], z) - x["order"] * P.price_tier(x["price"], z))
            opens = F.when(_at(state["n"], z) > 0, F.lit(0)).otherwise(F.lit(1))
            profit = P.spread(used + opens) * (total - _at(state["g"], z) + g)
            return F.struct(half_up(profit, 4).alias("profit"), (-z).alias("z"), g.alias("g"))

        fits = F.filter(_shelves(), lambda z: _at(state["room"], z) >= x["width"])
        best = F.array_max(F.transform(fits, option))

        def placed(b: Column) -> Column:
            to = F.coalesce(-b["z"], x["shelf"])
            at = F.coalesce(-b["z"], F.lit(0))  # 0: no shelf gets new context
            value = -x["order"] * P.price_tier(x["price"], at)
            return F.struct(
                _add_at(state["room"], to, -x["width"]).alias("room"),
                _add_at(state["n"], at, F.lit(1)).alias("n"),
                _add_at(state["w"], at, x["width"]).alias("w"),
                _add_at(state["v"], at, value).alias("v"),
                F.transform(state["g"], lambda g, i: F.when(i + 1 == at, b["g"])
                            .otherwise(g)).alias("g"),
                _moves_with(state["moves"], x, key, to).alias("moves"))

        return _bind(best, placed)

    state = {"room": _full_room(), "n": F.array(*[F.lit(0)] * K.NUM_SHELVES),
             "w": zeros, "v": zeros, "g": zeros}
    extras = [F.col("price_numeric").alias("price")]
    moves = _fold_by_priority(df, rack_keys, key, extras, state, step)
    return apply_moves(df, moves, rack_keys, key)


def ensemble_layout(df: DataFrame, n_candidates: int = 5, seed: int = 42,
                    noise_step: float = 5.0, scores: str = "scores",
                    rack_keys: Sequence[str] = K.RACK_KEYS, key: str = "product_id",
                    min_products: int = 2) -> DataFrame:
    """The best of ``n_candidates`` scored layouts per rack, by rack profit.

    Candidate 0 uses the plain ``scores``, candidate c adds noise of scale
    ``c * noise_step``. The first candidate wins ties; profits that differ by
    summation noise only are ties. Racks below ``min_products`` stay as they are.

    All candidates of a rack are placed in one pass. The sums of the rack's
    shelves, all of its products included, come along in a head row, so a
    candidate's profit follows from its moves.
    """
    rest = df.select(*[c for c in df.columns if c != scores])
    state = rack_state(rest, rack_keys).filter(F.col("rack_product_count") >= min_products)
    moves = _placement_moves(df, F.col(scores), rack_keys, key, state,
                             [noise_step * c for c in range(n_candidates)], seed)
    return apply_moves(rest, moves, rack_keys, key)


# --- baselines ---------------------------------------------------------------------

# What the profit of a product on a given shelf is made of.
_RATED = ("price_numeric", "profit_margin_percentage", "estimated_monthly_sales",
          "product_width_cm")


def random_layouts(df: DataFrame, n: int, seed: int, rack_keys: Sequence[str] = K.RACK_KEYS,
                   key: str = "product_id") -> DataFrame:
    """``n`` seeded random layouts of every rack, numbered by ``run``."""
    runs = df.withColumn("run", F.explode(F.sequence(F.lit(1), F.lit(n))))
    shelf = 1 + F.floor(uniform(seed, "run", *rack_keys, key) * K.NUM_SHELVES)
    return runs.withColumn("shelf_level", shelf.cast("int"))


def random_baseline(df: DataFrame, n: int, seed: int = 42,
                    rack_keys: Sequence[str] = K.RACK_KEYS, key: str = "product_id") -> DataFrame:
    """Mean profit of ``n`` random layouts per rack and the share without overflow.

    Rows are moved in sampled ranges of (rack, key) before they are repeated, so the repeated
    ones meet as shelf sums of their task, and a hot rack is cut. Profit and overflow come from
    the same sums. Racks without a key are not tested for overflow.
    """
    keys = [*rack_keys, "run"]
    ranged = df.select(*rack_keys, key, *_RATED).repartitionByRange(*rack_keys, key)
    values = shelf_values(random_layouts(ranged, n, seed, rack_keys, key), keys)
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in rack_keys])
    fits = ~(known & (half_up("width_cm", 4) > K.SHELF_WIDTH_CM))
    racks = values.groupBy(*keys).agg(
        (P.spread(F.count(F.lit(1))) * F.sum("value")).alias("profit"), F.min(fits).alias("_fits"))
    return racks.groupBy(*rack_keys).agg(
        F.avg("profit").alias("mean_profit"),
        F.avg(F.when(F.col("_fits"), 1.0).otherwise(0.0)).alias("valid_share"))


# --- comparing layouts ----------------------------------------------------------------

def align_layouts(original: DataFrame, optimised: DataFrame,
                  rack_keys: Sequence[str] = K.RACK_KEYS, key: str = "product_id") -> DataFrame:
    """Original and new shelf of every product, joined on rack and product key."""
    a = original.select(*rack_keys, key, "name", "product_width_cm",
                        F.col("shelf_level").alias("orig_shelf"))
    b = optimised.select(*rack_keys, key, F.col("shelf_level").alias("new_shelf"))
    return a.join(b, [*rack_keys, key]).withColumn(
        "moved", F.col("orig_shelf") != F.col("new_shelf"))


def shelf_transitions(aligned: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Number of products per (original shelf, new shelf).

    The products behind each pair are the rows of ``align_layouts``; no list of
    names is built, since one pair may hold a large share of all rows.
    """
    return aligned.groupBy(*by, "orig_shelf", "new_shelf", "moved").agg(
        F.count(F.lit(1)).alias("n_products"))


def layout_profits(layouts: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS) -> DataFrame:
    """Total profit per model over its racks."""
    return (rack_profit(layouts, ["model", *rack_keys])
            .groupBy("model").agg(F.sum("profit").alias("profit")))


def best_layout(layouts: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS,
                baseline: str = "Original", fallback: str = "GREEDY") -> DataFrame:
    """The model with the highest profit, apart from original and greedy.

    Greedy is the answer only where no other model is present.
    """
    rivals = layout_profits(layouts, rack_keys).filter(F.col("model") != baseline)
    ranked = rivals.withColumn("_other", F.col("model") != fallback)
    return ranked.agg(
        F.max_by(F.struct("model", "profit"), F.struct("_other", "profit")).alias("b")
    ).select("b.model", "b.profit")
