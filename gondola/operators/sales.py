"""Daily sales analytics of a small store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..functions import demand as D
from .ranking import top_n

ATTRIBUTES = ("product_id", "name", "category", "price", "margin", "popularity",
              "shelf_id", "rack_level")
_MONEY4 = "decimal(18,4)"


def neighbour_count(df: DataFrame) -> DataFrame:
    """Other products of the same category on the same shelf.

    Counts per (shelf, category) joined back, instead of a self join.
    """
    keys = ["shelf_id", "category"]
    counts = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("n_neighbours"))
    return df.join(counts, keys)


def expected_sales(df: DataFrame, base: float = K.BASE_DAILY_DEMAND,
                   noise: str | None = None) -> DataFrame:
    """Expected units, revenue and profit per product; money as exact decimals."""
    with_factor = neighbour_count(df).withColumn(
        "adjacency", D.adjacency_factor("n_neighbours"))
    units = D.expected_units("popularity", "rack_level", "adjacency", noise, base)
    price, margin = F.col("price").cast(_MONEY4), F.col("margin").cast(_MONEY4)
    sold = F.col("units_sold").cast("decimal(10,0)")
    return (with_factor.withColumn("units_sold", units)
            .withColumn("revenue", F.round(sold * price, 2).cast("decimal(18,2)"))
            .withColumn("profit", F.round(sold * price * margin, 2).cast("decimal(18,2)")))


def product_totals(df: DataFrame, by: Sequence[str] = ATTRIBUTES) -> DataFrame:
    return df.groupBy(*by).agg(
        F.sum("units_sold").alias("total_units"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("profit").alias("total_profit"))


def store_totals(df: DataFrame) -> DataFrame:
    totals = df.agg(F.sum("units_sold").alias("total_units"),
                    F.sum("revenue").alias("total_revenue"),
                    F.sum("profit").alias("total_profit"))
    return totals.withColumn("margin_pct", F.try_divide(
        F.col("total_profit").cast("double") * 100, F.col("total_revenue").cast("double")))


def top_products(df: DataFrame, n: int) -> DataFrame:
    return (df.groupBy("product_id", "name").agg(F.sum("profit").alias("total_profit"))
            .orderBy(F.desc("total_profit"), "product_id").limit(n))


def top_per_run(df: DataFrame, n: int = 5, base_seed: int = 100) -> DataFrame:
    """The ``n`` best products of every run, tagged with run and seed."""
    totals = product_totals(df, ["sim_id", *ATTRIBUTES])
    best = top_n(totals, ["sim_id"], [F.desc("total_profit"), "product_id"], n)
    return best.withColumn("seed", F.col("sim_id") + (base_seed - 1))


def frequency(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How often each value of each column appears, all columns in one scan."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value"))
        for c in columns])
    return (df.select(F.inline(entries)).groupBy("dimension", "value")
            .agg(F.count(F.lit(1)).alias("n")))


def top_profile(top: DataFrame) -> DataFrame:
    """Averages and ranges of the top performers."""
    return top.agg(
        F.avg("price").alias("avg_price"), F.avg("margin").alias("avg_margin"),
        F.avg("popularity").alias("avg_popularity"),
        F.avg("total_profit").cast("double").alias("avg_profit"),
        F.min("price").alias("min_price"), F.max("price").alias("max_price"),
        F.min("margin").alias("min_margin"), F.max("margin").alias("max_margin"))


def dominant(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """The most common value; the value that appears first wins a tie."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("_first"))
    return counts.orderBy(F.desc("n"), "_first").limit(1).select(
        F.lit(column).alias("dimension"), F.col(column).cast("string").alias("value"), "n")


def level_share(df: DataFrame, level: int = 3) -> DataFrame:
    """Percentage of rows on one rack level."""
    return df.agg((F.avg(F.when(F.col("rack_level") == level, 1.0).otherwise(0.0)) * 100)
                  .alias("share_pct"))


def in_all_runs(top: DataFrame, n_runs: int) -> DataFrame:
    """Names that appear in as many rows as there are runs."""
    return (top.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") == n_runs).select("name"))
