"""Original against optimised: racks, models, space and iterations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .. import constants as K
from ..functions.numbers import half_up
from ..functions.physics import base_profit, price_tier, shelf_multiplier, shelf_value
from ..session import written
from .layout import greedy_layout
from .profit import head_of_rack, largest_rack, profit_of_shelves, rack_profit


def compare_racks(original: DataFrame, optimised: DataFrame,
                  rack_keys: Sequence[str] = K.RACK_KEYS, order: str = "product_id") -> DataFrame:
    """Original and optimised profit and lift per rack; racks on one side only drop out."""
    a = rack_profit(original, rack_keys).select(*rack_keys, F.col("profit").alias("orig_profit"))
    b = rack_profit(optimised, rack_keys).select(*rack_keys, F.col("profit").alias("opt_profit"))
    names = original.groupBy(*rack_keys).agg(F.min_by("category", order).alias("category"))
    keys = list(rack_keys)
    return (a.join(b, keys).join(names, keys)
            .withColumn("lift", F.col("opt_profit") - F.col("orig_profit")))


def top_racks(compared: DataFrame, n: int = 15,
              rack_keys: Sequence[str] = K.RACK_KEYS) -> DataFrame:
    return compared.orderBy(F.desc("lift"), *rack_keys).limit(n)


def compare_totals(compared: DataFrame) -> DataFrame:
    """Totals over racks; the percentage is 0 where the original is not positive."""
    totals = compared.agg(F.sum("orig_profit").alias("orig_profit"),
                          F.sum("opt_profit").alias("opt_profit"))
    lift = F.col("opt_profit") - F.col("orig_profit")
    return totals.withColumn("lift", lift).withColumn(
        "lift_pct", F.when(F.col("orig_profit") > 0,
                           F.col("lift") / F.col("orig_profit") * 100).otherwise(0.0))


def lift_effects(base: DataFrame, forecasted: DataFrame, optimised: DataFrame,
                 rack_keys: Sequence[str] = K.RACK_KEYS) -> DataFrame:
    """Lift per rack split into the forecast's and the layout's share.

    ``base`` has base sales on the original layout, ``forecasted`` forecast sales
    on it, ``optimised`` forecast sales on the new layout.
    """
    keys = list(rack_keys)

    def profit(df: DataFrame, name: str) -> DataFrame:
        return rack_profit(df, rack_keys).select(*keys, F.col("profit").alias(name))

    return (profit(base, "base_profit").join(profit(forecasted, "forecast_profit"), keys)
            .join(profit(optimised, "opt_profit"), keys)
            .withColumn("forecast_effect", F.col("forecast_profit") - F.col("base_profit"))
            .withColumn("layout_effect", F.col("opt_profit") - F.col("forecast_profit"))
            .withColumn("lift", F.col("opt_profit") - F.col("base_profit")))


def compare_models(results: DataFrame) -> DataFrame:
    """Lift per model; marks the lowest error and the highest profit."""
    known = results.filter(F.col("mse").isNotNull())
    mse = known.agg(F.min_by("model", F.struct("mse", "model"))).scalar()
    zero = F.lit(0.0)
    # The first name wins a tie.
    profit = results.agg(F.min_by("model", F.struct(
        -F.coalesce("optimized_profit", zero), "model"))).scalar()
    return (results.withColumn("lift", F.coalesce("optimized_profit", zero)
                               - F.coalesce("original_profit", zero))
            .withColumn("lowest_mse", F.coalesce(F.col("model") == mse, F.lit(False)))
            .withColumn("highest_profit", F.col("model") == profit))


def greedy_results(df: DataFrame, n: int = 40, rack_keys: Sequence[str] = K.RACK_KEYS,
                   order: Sequence[str] = ("product_id",)) -> DataFrame:
    """Results without trained models: greedy on the head of the largest rack."""
    rack = df.join(largest_rack(df, rack_keys).select(*rack_keys), list(rack_keys), "left_semi")
    head = head_of_rack(rack, n, rack_keys, order).drop("row_no")
    original = rack_profit(head, rack_keys).agg(F.sum("profit")).scalar()
    return (rack_profit(greedy_layout(head, rack_keys), rack_keys)
            .select(F.lit("Greedy").alias("model"), F.lit(None).cast("double").alias("mse"),
                    original.alias("original_profit"),
                    F.col("profit").alias("optimized_profit")))


def regression_metrics(df: DataFrame, y: str = "label", prediction: str = "prediction") -> DataFrame:
    """MSE, MAE, R2 and MAPE in one aggregation."""
    error = F.col(y) - F.col(prediction)
    return (df.agg(F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"),
                   F.var_pop(y).alias("_var"),
                   F.avg(F.abs(error / (F.col(y) + 1e-6))).alias("mape"))
            .withColumn("r2", F.lit(1.0) - F.try_divide("mse", "_var")).drop("_var"))


# --- documented reports ------------------------------------------------------------

def space_kpis(df: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS) -> DataFrame:
    """Occupied and empty share of each rack's seven shelves."""
    total = K.SHELF_WIDTH_CM * K.NUM_SHELVES
    return df.groupBy(*rack_keys).agg(
        (F.sum("product_width_cm") / total).alias("occupancy")).withColumn(
            "empty_share", F.greatest(F.lit(0.0), F.lit(1.0) - F.col("occupancy")))


def stock_rotation(df: DataFrame, by: Sequence[str] = ("product_id",)) -> DataFrame:
    """Units sold per unit of mean stock."""
    return df.groupBy(*by).agg(F.sum("units_sold").alias("units"),
                               F.avg("stock_before").alias("mean_stock")).withColumn(
        "rotation", F.try_divide("units", "mean_stock"))


def cross_selling_share(df: DataFrame, units: str = "units_sold",
                        factor: str = "adjacency") -> DataFrame:
    """Share of units that the adjacency factor explains."""
    extra = F.col(units) * (F.lit(1.0) - F.lit(1.0) / F.col(factor))
    return df.agg((F.sum(extra) / F.sum(units)).alias("cross_selling_share"))


def iteration_gain(df: DataFrame, by: Sequence[str] = ("rack_id",), iteration: str = "month_key",
                   move_cost: float = 1.0) -> DataFrame:
    """Relative profit gain per iteration and the return on its relocations.

    Expects ``profit`` and ``n_moves``; one row per group and iteration.
    """
    previous = F.lag("profit").over(Window.partitionBy(*by).orderBy(iteration))
    cost = F.col("n_moves") * F.lit(move_cost)
    return (df.withColumn("gain", F.try_divide(F.col("profit") - previous, previous))
            .withColumn("roi", F.try_divide(F.col("profit") - previous - cost, cost)))


def _shelf_category_sums(df: DataFrame, rack_keys: Sequence[str]) -> DataFrame:
    """Sums per (rack, shelf, category) that profits, fill and categories follow from; written."""
    tier_value = base_profit() * price_tier("price_numeric", "shelf_level")
    return written(df.groupBy(*rack_keys, "shelf_level", "category").agg(
        F.count(F.lit(1)).alias("n_products"), F.sum("product_width_cm").alias("width_cm"),
        F.sum(tier_value).alias("tier_value"), F.sum("estimated_monthly_sales").alias("total_sales"),
        F.sum("profit_margin_percentage").alias("margin_sum"),
        F.count("profit_margin_percentage").alias("margin_n")))


def _rack_profit_of(sums: DataFrame, rack_keys: Sequence[str]) -> DataFrame:
    """Rack profit from ``_shelf_category_sums``."""
    shelves = sums.groupBy(*rack_keys, "shelf_level").agg(
        F.sum("n_products").alias("n_products"),
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("width_cm", "tier_value")])
    return profit_of_shelves(shelves.withColumn("value", shelf_value(
        "shelf_level", "n_products", "width_cm", "tier_value")), rack_keys)


def optimisation_report(original: DataFrame, optimised: DataFrame,
                        rack_keys: Sequence[str] = K.RACK_KEYS, key: str = "product_id",
                        falling: DataFrame | None = None, low_fill: float = 0.2) -> DataFrame:
    """The optimisation as rows ``(section, rank, payload)`` with JSON payloads.

    Sections: ``summary``; ``relocation``, the ten moves with most base profit;
    ``category``; ``falling_product`` where ``falling`` names products; and
    ``underused_rack``, racks filled below ``low_fill``.
    """
    def rows(df: DataFrame, section: str, rank, *fields) -> DataFrame:
        return df.select(F.lit(section).alias("section"), rank.cast("int").alias("rank"),
                         F.to_json(F.struct(*fields)).alias("payload"))

    keys = list(rack_keys)
    sums = _shelf_category_sums(optimised, rack_keys)
    before, after = (p.select(*keys, F.col("profit").alias(name)) for p, name in (
        (rack_profit(original, rack_keys), "orig_profit"),
        (_rack_profit_of(sums, rack_keys), "opt_profit")))
    totals = compare_totals(before.join(after, keys))
    summary = rows(totals, "summary", F.lit(1), half_up("orig_profit", 2).alias("profit_before"),
                   half_up("opt_profit", 2).alias("profit_after"),
                   half_up("lift_pct", 2).alias("delta_pct"))
    stood = original.select(*keys, key, F.col("shelf_level").alias("orig_shelf"),
                            base_profit().alias("_value"))
    stands = optimised.select(*keys, key, F.col("shelf_level").alias("new_shelf"))
    moves = (stood.join(stands, [*keys, key]).filter("orig_shelf <> new_shelf")
             .withColumn("impact", F.col("_value") * (shelf_multiplier("new_shelf")
                                                      - shelf_multiplier("orig_shelf")))
             .orderBy(F.desc("impact"), *keys, key).limit(10))
    order = Window.orderBy(F.desc("impact"), *rack_keys, key)  # over ten rows
    relocations = rows(moves.withColumn("_rank", F.row_number().over(order)), "relocation",
                       F.col("_rank"), *rack_keys, key, "orig_shelf", "new_shelf",
                       half_up("impact", 2).alias("impact"))
    by_category = sums.groupBy("category").agg(
        F.sum("n_products").alias("n_products"), F.sum("total_sales").alias("total_sales"),
        F.try_divide(F.sum("margin_sum"), F.sum("margin_n")).alias("avg_margin"))
    categories = rows(by_category, "category", F.lit(None), "category",
                      "n_products", "total_sales", half_up("avg_margin", 2).alias("avg_margin"))
    occupancy = F.sum("width_cm") / (K.SHELF_WIDTH_CM * K.NUM_SHELVES)
    underused = rows(sums.groupBy(*keys).agg(occupancy.alias("occupancy"))
                     .filter(F.col("occupancy") < low_fill), "underused_rack", F.lit(None), *rack_keys,
                     half_up("occupancy", 4).alias("occupancy"))
    report = summary.unionByName(relocations).unionByName(categories).unionByName(underused)
    if falling is not None:
        report = report.unionByName(rows(falling, "falling_product", F.lit(None),
                                         *falling.columns))
    return report


def falling_products(df: DataFrame, key: str = "product_id") -> DataFrame:
    """Products whose last observed month sold less than the month before it.

    The two latest months per product come out of one aggregation.
    """
    entry = F.struct("month_key", F.col("estimated_monthly_sales").alias("sales"))
    last = df.groupBy(key).agg(F.max(entry).alias("_last"))
    before = (df.join(last, key).filter(F.col("month_key") < F.col("_last.month_key"))
              .groupBy(key, "_last").agg(F.max(entry).alias("_before")))
    return (before.filter(F.col("_last.sales") < F.col("_before.sales"))
            .select(key, F.col("_before.sales").alias("sales_before"),
                    F.col("_last.sales").alias("sales_last")))
