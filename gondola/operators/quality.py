"""Data-quality report in one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.prices import is_eur


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def catalog_report(catalog: DataFrame) -> DataFrame:
    """Rows, categories, blank and unparseable prices of a catalogue."""
    blank = F.coalesce(F.trim("price"), F.lit("")) == ""
    return catalog.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("category").alias("n_categories"),
        _count(blank).alias("n_blank_prices"),
        _count(~blank & ~is_eur("price")).alias("n_bad_prices"),
        _count(F.col("category").isNull()).alias("n_null_category"))


METRICS = ("price_numeric", "estimated_monthly_sales", "profit_margin_percentage",
           "product_width_cm")


def quality_report(df: DataFrame) -> DataFrame:
    """NULL, NaN and negative values per metric, shelves out of range."""
    checks = []
    for c in METRICS:
        v = F.col(c)
        checks.append(_count(v.isNull() | F.isnan(v.cast("double"))).alias(f"n_missing_{c}"))
        checks.append(_count(v < 0).alias(f"n_negative_{c}"))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("category").alias("n_categories"),
        *checks,
        _count(~F.coalesce(F.col("shelf_level").between(1, 7), F.lit(False)))
        .alias("n_bad_shelves"))
