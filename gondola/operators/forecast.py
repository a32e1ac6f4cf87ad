"""Forecast multipliers and their effect on sales."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import rules
from ..functions import demand as D


def seasonal_forecast(categories: DataFrame, month: int,
                      seasonal=rules.SEASONAL_FORECAST) -> DataFrame:
    """One seasonal multiplier per distinct category."""
    return categories.select("category").distinct().withColumn(
        "multiplier", D.seasonal_multiplier("category", F.lit(month), seasonal))


def forecast(base: DataFrame, month: int, replies: DataFrame | None = None) -> DataFrame:
    """Multiplier per category of the base month.

    Without replies the seasonal rules decide. With replies
    (``category, multiplier``) a category without one gets NULL: unchanged.
    """
    if replies is None:
        return seasonal_forecast(base, month)
    return (base.select("category").distinct()
            .join(replies.select("category", "multiplier"), "category", "left"))


def apply_forecast(df: DataFrame, multipliers: DataFrame) -> DataFrame:
    """Sales times the category's multiplier, truncated, at least 1."""
    joined = df.join(multipliers.select("category", F.col("multiplier").alias("_mult")),
                     "category", "left")
    return (joined.withColumn("estimated_monthly_sales",
                              D.apply_multiplier("estimated_monthly_sales", "_mult"))
            .select(*df.columns))


def top_adjustments(multipliers: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` multipliers furthest from 1, with their direction."""
    m = F.col("multiplier")
    return (multipliers.filter(m.isNotNull())
            .withColumn("direction", F.when(m > 1.0, "UP").when(m < 1.0, "DOWN").otherwise("--"))
            .orderBy(F.desc(F.abs(m - 1.0)), "category").limit(n))


def forecast_effect(base: DataFrame, forecasted: DataFrame) -> DataFrame:
    """Mean sales before and after, products and racks covered."""
    before = base.agg(F.avg("estimated_monthly_sales")).scalar()
    return forecasted.agg(
        F.avg("estimated_monthly_sales").alias("avg_sales_after"),
        F.count(F.lit(1)).alias("n_products"),
        F.countDistinct("rack_id").alias("n_racks")).withColumn("avg_sales_before", before)
