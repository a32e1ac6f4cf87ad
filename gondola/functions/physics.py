"""The rack profit model, factor by factor."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import constants as K
from .numbers import col


def shelf_multiplier(shelf: Column | str) -> Column:
    """Visibility multiplier of a shelf level; unknown levels count 1.0."""
    s = col(shelf)
    by_value: dict[float, list[int]] = {}
    for level, mult in K.SHELF_MULTIPLIERS.items():
        by_value.setdefault(mult, []).append(level)
    expr = F
    for mult, levels in by_value.items():
        expr = expr.when(s.isin(levels), F.lit(mult))
    return expr.otherwise(F.lit(K.DEFAULT_MULTIPLIER))


def shelf_band(shelf: Column | str) -> Column:
    s = col(shelf)
    return (F.when(s.isin(*K.BOTTOM_SHELVES), "bottom")
            .when(s.isin(*K.EYE_SHELVES), "eye")
            .when(s.isin(*K.TOP_SHELVES), "top"))


def base_profit(price="price_numeric", margin="profit_margin_percentage",
                sales="estimated_monthly_sales") -> Column:
    """Profit of a product before any shelf effect; the greedy priority."""
    return col(price) * (col(margin) / F.lit(100.0)) * col(sales)


def basic_profit(price="price_numeric", margin="profit_margin_percentage",
                 sales="estimated_monthly_sales", shelf="shelf_level") -> Column:
    return base_profit(price, margin, sales) * shelf_multiplier(shelf)


def crowding(n: Column | str) -> Column:
    """Attention lost to more than five products on one shelf."""
    n = col(n)
    loss = F.lit(1.0) - F.lit(K.CROWDING_STEP) * (n - F.lit(K.CROWDING_FREE))
    return (F.when(n > K.CROWDING_FREE, F.greatest(F.lit(K.CROWDING_FLOOR), loss))
            .otherwise(F.lit(1.0)))


def diminishing(shelf: Column | str, width_cm: Column | str) -> Column:
    """Returns lost on an eye-level shelf that is more than 60 % full."""
    fill = col(width_cm) / F.lit(K.SHELF_WIDTH_CM)
    loss = F.lit(1.0) - F.lit(K.FILL_SLOPE) * (fill - F.lit(K.FILL_FREE))
    return (F.when(col(shelf).isin(*K.EYE_SHELVES) & (fill > K.FILL_FREE),
                   F.greatest(F.lit(K.FILL_FLOOR), loss))
            .otherwise(F.lit(1.0)))


def price_tier(price: Column | str, shelf: Column | str) -> Column:
    p, s = col(price), col(shelf)
    bottom, eye = s.isin(*K.BOTTOM_SHELVES), s.isin(*K.EYE_SHELVES)
    return (F.when((p > K.PREMIUM_PRICE) & eye, F.lit(K.PREMIUM_EYE_BONUS))
            .when((p < K.BUDGET_PRICE) & bottom, F.lit(K.BUDGET_BOTTOM_BONUS))
            .when((p > K.PREMIUM_PRICE) & bottom, F.lit(K.PREMIUM_BOTTOM_PENALTY))
            .otherwise(F.lit(1.0)))


def spread(n_shelves: Column | str) -> Column:
    return F.lit(1.0) + F.lit(K.SPREAD_BONUS) * (col(n_shelves) / F.lit(float(K.NUM_SHELVES)))


def shelf_value(shelf: Column | str, n: Column | str, width_cm: Column | str,
                tier_value: Column | str) -> Column:
    """Profit of one shelf before the spread bonus.

    ``tier_value`` is the sum of base profit times price tier on the shelf:
    the other factors are the same for all of its products.
    """
    value = (shelf_multiplier(shelf) * crowding(n) * diminishing(shelf, width_cm)
             * col(tier_value))
    return F.when(col(n) > 0, value).otherwise(F.lit(0.0))
