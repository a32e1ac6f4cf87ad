"""Shelf and rack profit, violations and shelf breakdowns.

Every factor except the price tier is the same for all products of a shelf, so
rack profit is two aggregations: products -> (rack, shelf) -> rack. The first one
combines map-side, which keeps a hot rack from meeting in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import constants as K
from ..functions import physics as P
from ..functions.numbers import half_up
from .ranking import top_n


def shelf_stats(df: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS) -> DataFrame:
    """Per (rack, shelf): product count, used width, distinct shelves of the rack."""
    shelves = df.groupBy(*rack_keys, "shelf_level").agg(
        F.count(F.lit(1)).alias("n_products"),
        F.sum("product_width_cm").alias("width_cm"))
    rack = Window.partitionBy(*rack_keys)  # at most one row per shelf level
    return shelves.withColumn("n_shelves_used", F.count(F.lit(1)).over(rack))


def shelf_values(df: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS,
                 more: Sequence[Column] = ()) -> DataFrame:
    """Per (rack, shelf): count, width, tier-weighted value, profit before spread, and ``more``."""
    tier_value = P.base_profit() * P.price_tier("price_numeric", "shelf_level")
    return (df.groupBy(*rack_keys, "shelf_level").agg(
        F.count(F.lit(1)).alias("n_products"),
        F.coalesce(F.sum("product_width_cm"), F.lit(0.0)).alias("width_cm"),
        F.coalesce(F.sum(tier_value), F.lit(0.0)).alias("tier_value"), *more)
        .withColumn("value", P.shelf_value("shelf_level", "n_products", "width_cm",
                                           "tier_value")))


def rack_profit(df: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS) -> DataFrame:
    """Profit per rack with crowding, diminishing returns, price tier and spread."""
    return profit_of_shelves(shelf_values(df, rack_keys), rack_keys)


def profit_of_shelves(values: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS) -> DataFrame:
    """Rack profit from ``n_products`` and ``value`` of every shelf."""
    return (values.groupBy(*rack_keys).agg(
        F.sum("n_products").alias("n_products"),
        F.count(F.lit(1)).alias("n_shelves_used"),
        F.sum("value").alias("_value"))
        .withColumn("profit", P.spread("n_shelves_used") * F.col("_value"))
        .drop("_value"))


def shelf_profit(df: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS,
                 spread: str = "rack") -> DataFrame:
    """Profit per (rack, shelf).

    ``spread="rack"`` uses the rack's shelf count, so shelves add up to the
    rack profit; ``"single"`` rates every shelf as a rack of its own.
    """
    if spread not in ("rack", "single"):
        raise ValueError(f"spread must be 'rack' or 'single', not {spread!r}")
    values = shelf_values(df, rack_keys)
    n: Column = F.lit(1)
    if spread == "rack":
        n = F.count(F.lit(1)).over(Window.partitionBy(*rack_keys))
    return (values.withColumn("profit", P.spread(n) * F.col("value"))
            .withColumn("band", P.shelf_band("shelf_level"))
            .drop("tier_value", "value"))


def width_total() -> Column:
    """Total width in whole micrometres: 300.0 stays 300.0 however it was added up."""
    return half_up(F.sum("product_width_cm"), 4)


def shelf_violations(df: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS) -> DataFrame:
    """Shelves 1..7 whose products are wider than the shelf."""
    return (df.filter(F.col("shelf_level").between(1, K.NUM_SHELVES))
            .groupBy(*rack_keys, "shelf_level")
            .agg(width_total().alias("total_cm"))
            .filter(F.col("total_cm") > K.SHELF_WIDTH_CM))


def rack_sizes(df: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS) -> DataFrame:
    return df.groupBy(*rack_keys).agg(F.count(F.lit(1)).alias("n_products"))


def largest_rack(df: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS) -> DataFrame:
    """The rack with most products; the lowest key wins a tie."""
    return (rack_sizes(df, rack_keys)
            .orderBy(F.desc("n_products"), *rack_keys).limit(1))


def racks_with(df: DataFrame, min_products: int,
               rack_keys: Sequence[str] = K.RACK_KEYS) -> DataFrame:
    """Rows of racks that hold at least ``min_products`` products."""
    big = (rack_sizes(df, rack_keys).filter(F.col("n_products") >= min_products)
           .select(*rack_keys))
    return df.join(big, list(rack_keys), "left_semi")


def head_of_rack(df: DataFrame, n: int = 40, rack_keys: Sequence[str] = K.RACK_KEYS,
                 order: Sequence[str] = ("product_id",)) -> DataFrame:
    """The first ``n`` rows of every rack."""
    return top_n(df, rack_keys, order, n, name="row_no")


def head_n(df: DataFrame, n: int, order: Sequence[str] = ("product_id",)) -> DataFrame:
    return df.orderBy(*order).limit(n)


def shelf_counts(layouts: DataFrame, models: Sequence[str],
                 rack_keys: Sequence[str] = ()) -> DataFrame:
    """Products per shelf 1..7, one column per model, 0 where a shelf is empty."""
    keys = list(rack_keys)
    counts = (layouts.filter(F.col("shelf_level").between(1, K.NUM_SHELVES))
              .groupBy(*keys, "shelf_level").pivot("model", list(models)).count())
    shelves = F.explode(F.array(*[F.lit(s) for s in K.SHELVES])).alias("shelf_level")
    racks = layouts.select(*keys).distinct() if keys else layouts.limit(1)
    return (racks.select(*keys, shelves)
            .join(counts, [*keys, "shelf_level"], "left")
            .fillna(0, subset=list(models)))
