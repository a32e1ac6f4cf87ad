"""Store layout: grid, traffic, adjacency, placement checks, visits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as K
from ..functions import demand as D
from .ranking import previous_value, row_numbers


def adjacency_bonus(categories: DataFrame, neighbours: DataFrame) -> DataFrame:
    """``1 + sum of bonuses`` of the categories next to each category.

    ``categories`` holds ``name`` and the map ``adjacency_bonus``; ``neighbours``
    holds ``(name, neighbour)``.
    """
    bonuses = categories.select("name", F.explode("adjacency_bonus").alias("neighbour", "bonus"))
    sums = (neighbours.distinct().join(bonuses, ["name", "neighbour"])
            .groupBy("name").agg(F.sum("bonus").alias("_bonus")))
    return categories.select("name").join(sums, "name", "left").select(
        "name", (F.lit(1.0) + F.coalesce("_bonus", F.lit(0.0))).alias("factor"))


def _steps() -> Column:
    return F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                     for dx, dy in ((1, 0), (-1, 0), (0, 1), (0, -1))])


def _next_cells(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    moved = cells.withColumn("_s", F.explode(_steps()))
    return moved.select(*keys, "cell_id", (F.col("x") + F.col("_s.dx")).alias("x"),
                        (F.col("y") + F.col("_s.dy")).alias("y"))


def grid_neighbours(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Pairs of cells at Manhattan distance 1, by an equi join on four offsets."""
    other = cells.select(*keys, F.col("cell_id").alias("neighbour_id"),
                         F.col("kind").alias("neighbour_kind"), "x", "y")
    return _next_cells(cells, keys).join(other, [*keys, "x", "y"]).select(
        *keys, "cell_id", "neighbour_id", "neighbour_kind")


def shelf_access(cells: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Shelves and whether an aisle cell lies next to them."""
    reached = (grid_neighbours(cells, keys).filter(F.col("neighbour_kind") == "aisle")
               .select(*keys, "cell_id").distinct().withColumn("_aisle", F.lit(True)))
    return (cells.filter(F.col("kind") == "shelf").join(reached, [*keys, "cell_id"], "left")
            .select(*keys, "cell_id", F.coalesce("_aisle", F.lit(False)).alias("accessible")))


def traffic_heatmap(cells: DataFrame, centres: DataFrame, store: str = "store_id") -> DataFrame:
    """Sum of Gaussians per cell, scaled to a maximum of 1 in each store.

    ``centres`` holds ``(store, x, y, sigma, weight)``: the doors, tills and main aisles,
    any number per store. A cell meets the centres of its own store. Without centres
    a store has no heat (NULL).
    """
    there = centres.select(store, F.col("x").alias("_cx"), F.col("y").alias("_cy"),
                           F.col("sigma").alias("_sigma"), F.col("weight").alias("_weight"))
    dx, dy = F.col("x") - F.col("_cx"), F.col("y") - F.col("_cy")
    bump = F.col("_weight") * F.exp(
        -(dx * dx + dy * dy) / (F.lit(2.0) * F.col("_sigma") * F.col("_sigma")))
    heat = (cells.join(there, store).groupBy(store, "cell_id")
            .agg(F.sum(bump).alias("heat")))
    top = heat.groupBy(store).agg(F.max("heat").alias("_top"))
    scaled = heat.join(top, store).select(
        store, "cell_id", F.try_divide(F.col("heat"), F.col("_top")).alias("heat"))
    return cells.join(scaled, [store, "cell_id"], "left")


def shelf_traffic(shelves: DataFrame, door: tuple[int, int] = (0, 0)) -> DataFrame:
    """Traffic by distance to the door, and its product with level visibility."""
    traffic = D.traffic_factor("x", "y", F.lit(door[0]), F.lit(door[1]))
    return shelves.withColumn("traffic", traffic).withColumn(
        "position_factor", F.col("traffic") * D.level_visibility("level"))


def facing_capacity(df: DataFrame, by: Sequence[str], level_width_cm: float = 120.0) -> DataFrame:
    """Facings that fit on a level of the given width."""
    return df.groupBy(*by).agg(
        F.floor(F.lit(level_width_cm) / F.avg("product_width_cm")).alias("facings"))


def seasonal_profile(df: DataFrame, key: str = "product_id", month: str = "month",
                     sales: str = "sales") -> DataFrame:
    """Month sales over mean month sales as a vector of twelve; one aggregation."""
    def total(m: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col(month) == m, F.col(sales))), F.lit(0))

    sums = df.groupBy(key).agg(F.array(*[total(m) for m in range(1, 13)]).alias("_sums"),
                               (F.sum(sales) / F.lit(12.0)).alias("_mean"))
    return sums.select(key, F.transform(
        "_sums", lambda s: F.try_divide(s, F.col("_mean"))).alias("profile"))


def consolidate_prices(df: DataFrame, product: str = "name", price: str = "price") -> DataFrame:
    """One mean price per product over all of its brands."""
    return df.groupBy(product).agg(F.avg(price).alias("mean_price"),
                                   F.count(F.lit(1)).alias("n_offers"))


def transition_matrix(visits: DataFrame, visit: str, order: Sequence[str],
                      section: str) -> DataFrame:
    """Probability of going from one section to the next within a visit.

    A visit may have any number of steps, see ``previous_value``.
    """
    steps = previous_value(visits, [visit], order, section, "_from").filter(
        F.col("_from").isNotNull())
    counts = steps.groupBy(F.col("_from").alias("from_section"),
                           F.col(section).alias("to_section")).agg(
        F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("from_section").agg(F.sum("n").alias("_total"))
    return (counts.join(totals, "from_section")
            .withColumn("probability", F.col("n") / F.col("_total")).drop("_total"))


def rank_match(products: DataFrame, slots: DataFrame, value: str = "margin",
               visibility: str = "visibility", product_key: str = "product_id",
               slot_key: str = "slot_id", by: str = "category") -> DataFrame:
    """The k-th most valuable product on the k-th most visible slot of its category.

    Both sides are numbered in ranges, so a large category is spread out.
    """
    def ranked(df: DataFrame, score: str, key: str) -> DataFrame:
        return row_numbers(df, [by], [F.desc(score), key], "_rank")

    a = ranked(products, value, product_key).select(by, "_rank", product_key, value)
    b = ranked(slots, visibility, slot_key).select(by, "_rank", slot_key, visibility)
    return a.join(b, [by, "_rank"]).withColumnRenamed("_rank", "rank")


# --- validation -----------------------------------------------------------------------

def orphans(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Rows whose key is absent from the dimension."""
    return df.join(dim.select(F.col(dim_key or key).alias(key)), key, "left_anti")


def validate_layout(placement: DataFrame, incompatible: DataFrame,
                    level_width_cm: float = K.SHELF_WIDTH_CM) -> DataFrame:
    """Broken layout rules as rows ``(check, subject, value)``.

    ``placement`` has one row per placed product: ``product_id, category,
    shelf_id, shelf_category, level, slot, width_cm, height_cm, weight_kg,
    max_height_cm, max_weight_kg``. ``incompatible`` lists ordered category
    pairs ``(category, other)``.
    """
    def rows(df: DataFrame, check: str, subject: Column, value: Column) -> DataFrame:
        return df.select(F.lit(check).alias("check"), subject.cast("string").alias("subject"),
                         value.cast("double").alias("value"))

    level = F.concat_ws("/", "shelf_id", "level")
    slot = F.concat_ws("/", "shelf_id", "level", "slot")
    n = F.count(F.lit(1)).alias("n")
    placed = placement.groupBy("product_id").agg(n).filter("n > 1")
    slots = placement.groupBy("shelf_id", "level", "slot").agg(n).filter("n > 1")
    widths = (placement.groupBy("shelf_id", "level").agg(F.sum("width_cm").alias("w"))
              .filter(F.col("w") > level_width_cm))
    blocks = (placement.groupBy("shelf_id", "level", "category")
              .agg((F.max("slot") - F.min("slot") + 1 - F.countDistinct("slot")).alias("gap"))
              .filter("gap > 0"))
    # Categories per slot first: two crowded slots make few pairs.
    stands = placement.select("shelf_id", "level", "slot", "category").distinct()
    right = stands.select("shelf_id", "level", (F.col("slot") - 1).alias("slot"),
                          F.col("category").alias("other"))
    clashes = (stands.join(right, ["shelf_id", "level", "slot"])
               .join(incompatible, ["category", "other"], "left_semi"))
    checks = [
        rows(placed, "product_placed_twice", F.col("product_id"), F.col("n")),
        rows(slots, "slot_taken_twice", slot, F.col("n")),
        rows(placement.filter(F.col("category") != F.col("shelf_category")),
             "wrong_category", F.col("product_id"), F.lit(1)),
        rows(widths, "level_too_wide", level, F.col("w")),
        rows(placement.filter(F.col("height_cm") > F.col("max_height_cm")),
             "too_high", F.col("product_id"), F.col("height_cm")),
        rows(placement.filter(F.col("weight_kg") > F.col("max_weight_kg")),
             "too_heavy", F.col("product_id"), F.col("weight_kg")),
        rows(blocks, "category_split", F.concat_ws("/", "shelf_id", "level", "category"),
             F.col("gap")),
        rows(clashes, "incompatible_neighbours", slot, F.lit(1)),
    ]
    return reduce(DataFrame.unionByName, checks)
