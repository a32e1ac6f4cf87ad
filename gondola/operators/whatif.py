"""What-if analysis: the profit lift of every single-product move."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..functions import physics as P
from ..functions.numbers import uniform
from ..session import written
from .profit import shelf_values
from .ranking import row_numbers

#: What a move is rated by, besides its shelves.
_RATED = ("price_numeric", "profit_margin_percentage", "estimated_monthly_sales", "product_width_cm")
_SHELF_BITS = K.NUM_SHELVES.bit_length()
#: Draws meet racks in pieces of up to so many products.
PIECE_ROWS = 1024
#: About so many draws meet a copy of a piece, at most, and so many are made by a task.
PIECE_DRAWS, TASK_DRAWS = 200_000, 2_000_000


def rack_state(df: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS,
               item: Column | None = None) -> DataFrame:
    """One row per rack: count, width, tier value and profit of shelves 1..7 as arrays.

    With ``item``, all items of the rack are in ``_items``, in their order.
    """
    some = [] if item is None else [F.collect_list(item).alias("_items")]
    every = [] if item is None else [
        F.sort_array(F.flatten(F.collect_list("_items"))).alias("_items")]
    values = shelf_values(df, rack_keys, some)

    def per_shelf(column: str, empty: Column) -> Column:
        return F.array(*[
            F.coalesce(F.max(F.when(F.col("shelf_level") == s, F.col(column))), empty)
            for s in K.SHELVES])

    zero = F.lit(0.0)
    return values.groupBy(*rack_keys).agg(
        per_shelf("n_products", F.lit(0).cast("bigint")).alias("shelf_n"),
        per_shelf("width_cm", zero).alias("shelf_w"),
        per_shelf("tier_value", zero).alias("shelf_v"),
        per_shelf("value", zero).alias("shelf_g"),
        F.count(F.lit(1)).alias("n_shelves_used"),
        F.sum("n_products").alias("rack_product_count"),
        F.sum("value").alias("rack_value"), *every)


def _checked_shelf(c: str) -> Column:
    bad = F.concat(F.lit(f"{c} must be 1..{K.NUM_SHELVES}, got "),
                   F.coalesce(F.col(c).cast("string"), F.lit("NULL")))
    return F.when(F.col(c).between(1, K.NUM_SHELVES), F.col(c)).otherwise(
        F.raise_error(bad).cast("int"))


def with_context(df: DataFrame, rack_keys: Sequence[str]) -> DataFrame:
    """Products with their rack's state and the effect of leaving their shelf."""
    # Every rack has its state. As a left join, Spark drops the join where only
    # columns of the products are used.
    return _with_leaving(df.join(rack_state(df, rack_keys), list(rack_keys), "left"))


def _with_leaving(joined: DataFrame) -> DataFrame:
    """Products beside the state of their rack, with the effect of leaving their shelf."""
    a = F.col("original_shelf")
    v = P.base_profit()
    n_a, w_a = F.element_at("shelf_n", a), F.element_at("shelf_w", a)
    left_behind = P.shelf_value(
        a, n_a - 1, w_a - F.col("product_width_cm"),
        F.element_at("shelf_v", a) - v * P.price_tier("price_numeric", a))
    return joined.withColumn("original_shelf", _checked_shelf("shelf_level")).withColumns({
        "_v": v,
        "_n_a": n_a,
        "_leave": left_behind - F.element_at("shelf_g", a),
    })


def _lift_to(shelf: Column) -> Column:
    """Rack profit after the move to ``shelf`` minus the profit before it."""
    n_b, w_b = F.element_at("shelf_n", shelf), F.element_at("shelf_w", shelf)
    arrive = P.shelf_value(
        shelf, n_b + 1, w_b + F.col("product_width_cm"),
        F.element_at("shelf_v", shelf) + F.col("_v") * P.price_tier("price_numeric", shelf)
    ) - F.element_at("shelf_g", shelf)
    used = (F.col("n_shelves_used") - (F.col("_n_a") == 1).cast("int")
            + (n_b == 0).cast("int"))
    lift = (P.spread(used) * (F.col("rack_value") + F.col("_leave") + arrive)
            - P.spread("n_shelves_used") * F.col("rack_value"))
    return F.when(shelf == F.col("original_shelf"), F.lit(0.0)).otherwise(lift)


def move_lift(df: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS,
              keep: Sequence[str] = ("product_id",)) -> DataFrame:
    """Every product on every shelf 1..7: ten features and the exact profit lift.

    A move changes two shelves only, so each lift comes from the rack's seven
    shelf sums: 7 rows per product, one join on the rack.
    """
    moved = with_context(df, rack_keys).withColumn(
        "new_shelf", F.explode(F.array(*[F.lit(s) for s in K.SHELVES])))
    return moved.select(
        *rack_keys, *keep,
        "price_numeric", "profit_margin_percentage", "estimated_monthly_sales",
        "product_width_cm", "original_shelf", "new_shelf",
        F.col("_n_a").alias("n_products_on_original_shelf"),
        F.element_at("shelf_n", F.col("new_shelf")).alias("n_products_on_new_shelf"),
        "n_shelves_used", "rack_product_count",
        _lift_to(F.col("new_shelf")).alias("profit_lift"))


def with_move_scores(df: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS,
                     name: str = "scores") -> DataFrame:
    """Adds the seven exact lifts of each product as one array column."""
    scores = F.array(*[_lift_to(F.lit(s)) for s in K.SHELVES])
    return (with_context(df, rack_keys)
            .select(*df.columns, scores.alias(name)))


def _drawn_from(rows: DataFrame, racks: DataFrame, large: DataFrame | None,
                copies: Column | None, rack_keys: list[str], key: str) -> DataFrame:
    """Racks as rows: the products of a piece in ``_items``, beside the state of their rack.

    A rack of up to ``PIECE_ROWS`` products is one piece, and its state comes from the same
    groups. The products of ``large`` racks are numbered first. A piece goes by the number of its
    rack and the number of its first product; its copies go by the numbers after that.
    """
    item = F.struct(key, *_RATED, "shelf_level")
    number = ["_rack_no", "_product_no"]
    at = rows.join(racks, rack_keys).withColumn(
        "_product_no", F.when(F.col("_size") <= PIECE_ROWS, F.lit(1).cast("bigint")))
    if large is not None:
        at = at.filter(F.col("_size") <= PIECE_ROWS)
    pieces = rack_state(at.repartition(*number), [*number, *rack_keys, "_size"], item)
    if large is not None:
        own = rows.join(large, rack_keys)
        first = F.col("_product_no") - (F.col("_product_no") - 1) % PIECE_ROWS
        cut = (row_numbers(own, rack_keys, [key], name="_product_no")
               .withColumn("_product_no", first).groupBy(*number, *rack_keys, "_size")
               .agg(F.sort_array(F.collect_list(item)).alias("_items")))
        pieces = pieces.unionByName(cut.join(rack_state(own, ["_rack_no"]), "_rack_no"))
    if copies is None:
        return pieces
    return pieces.withColumn("_product_no", F.explode(F.sequence(
        "_product_no", F.col("_product_no") + copies - 1)))


def training_samples(df: DataFrame, samples: Sequence[tuple[str, int, int]],
                     rack_keys: Sequence[str] = K.RACK_KEYS, key: str = "product_id",
                     min_products: int = 1) -> DataFrame:
    """Moves drawn with replacement: rack, then product, then shelf, uniformly.

    ``samples`` are (name, size, seed); the name is in ``sample``. Each draw turns
    seeded uniforms into a rack number, a product number and a shelf. Only its own number, its
    shelf and the numbers of the piece of a rack that it meets are sent: a row there has the
    piece's products and the state of the rack, and the product is picked beside it. Racks of up to
    ``PIECE_ROWS`` products are one piece, so a draw from them needs no size; the few larger
    ones are looked up before. Where racks are few, a piece is there several times.
    """
    rack_keys = list(rack_keys)
    spark = df.sparkSession
    rows = df.select(*rack_keys, key, *_RATED, "shelf_level")
    sizes = rows.groupBy(*rack_keys).agg(F.count(F.lit(1)).alias("_size")).filter(
        F.col("_size") >= min_products)
    racks = written(row_numbers(sizes, [], rack_keys, name="_rack_no"))
    facts = racks.agg(F.count(F.lit(1)).alias("n"), F.max("_size").alias("most")).first()
    n_racks = facts["n"]
    large = None
    if n_racks and facts["most"] > PIECE_ROWS:
        large = written(racks.filter(F.col("_size") > PIECE_ROWS))
    per_rack = sum(n for _, n, _ in samples) / max(1, n_racks)
    n_pieces = F.ceil(F.col("_size") / PIECE_ROWS)
    copies = None
    if per_rack > PIECE_DRAWS:
        copies = F.least(F.ceil(F.lit(per_rack / PIECE_DRAWS) / n_pieces), F.lit(PIECE_ROWS))
    # A draw's sample and shelf, both from 0, are one number.
    sample = F.shiftright("_what", _SHELF_BITS)
    seeds = F.array(*[F.lit(f"{seed}p") for _, _, seed in samples])
    # The product's number, from 0; 0 in a rack of one product.
    product = F.floor(uniform(F.get(seeds, sample), "draw_id") * F.col("_size"))

    def drawn_from(n: int, what: str) -> Column:
        """A whole number below ``n``; told not to be NULL, which would be tested for again."""
        return F.coalesce(F.floor(uniform(what, "draw_id") * n), F.lit(0))

    def draws(i: int, n: int, seed: int) -> DataFrame:
        tasks = max(spark.sparkContext.defaultParallelism, -(-n // TASK_DRAWS))
        return spark.range(0, n, 1, tasks).withColumnRenamed("id", "draw_id").withColumns({
            "_rack_no": drawn_from(n_racks, f"{seed}r") + 1,
            "_what": drawn_from(K.NUM_SHELVES, f"{seed}s").cast("int") + (i << _SHELF_BITS)})

    sent = reduce(DataFrame.unionByName, [
        draws(i, n, seed) for i, (_, n, seed) in enumerate(samples)])
    if large is None:
        sent = sent.withColumn("_size", F.lit(1))
    else:
        sent = sent.join(large.select("_rack_no", "_size"), "_rack_no", "left").fillna(1, "_size")
    first = F.lit(1).cast("bigint")
    if large is not None:
        first = F.floor(product / PIECE_ROWS) * PIECE_ROWS + first
    sent = sent.select("_what", "draw_id", "_rack_no", (
        first + F.col("draw_id") % (F.lit(1) if copies is None else copies)).alias("_product_no"))
    pieces = _drawn_from(rows, racks, large, copies, rack_keys, key)
    at = product if large is None else product % PIECE_ROWS
    met = sent.join(pieces, ["_rack_no", "_product_no"]).withColumn(
        "_item", F.get("_items", at.cast("int")))
    state = [c for c in pieces.columns if c not in (*rack_keys, "_rack_no", "_product_no", "_size",
                                                    "_items")]
    names = F.array(*[F.lit(name) for name, _, _ in samples])
    drawn = met.select(
        F.get(names, sample).alias("sample"), "draw_id", *rack_keys, "_item.*",
        (F.col("_what").bitwiseAND((1 << _SHELF_BITS) - 1) + 1).alias("new_shelf"), *state)
    return _with_leaving(drawn).select(
        "sample", "draw_id", *rack_keys, key,
        "price_numeric", "profit_margin_percentage", "estimated_monthly_sales",
        "product_width_cm", "original_shelf", "new_shelf",
        F.col("_n_a").alias("n_products_on_original_shelf"),
        F.element_at("shelf_n", F.col("new_shelf")).alias("n_products_on_new_shelf"),
        "n_shelves_used", "rack_product_count",
        _lift_to(F.col("new_shelf")).alias("profit_lift"))


def training_sample(df: DataFrame, n: int, seed: int,
                    rack_keys: Sequence[str] = K.RACK_KEYS, key: str = "product_id",
                    min_products: int = 1) -> DataFrame:
    """One sample of ``training_samples``."""
    return training_samples(df, [("", n, seed)], rack_keys, key, min_products).drop("sample")


def split(df: DataFrame, fraction: float, seed: int,
          keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Stable split by a hash of the row key: ``(fraction, 1 - fraction)``."""
    u = uniform(seed, *keys)
    return df.filter(u < fraction), df.filter(u >= fraction)


def split_by_month(df: DataFrame, first_test_month: str) -> tuple[DataFrame, DataFrame]:
    """Earlier months for training, the named month and later ones for testing."""
    return (df.filter(F.col("month_key") < first_test_month),
            df.filter(F.col("month_key") >= first_test_month))
