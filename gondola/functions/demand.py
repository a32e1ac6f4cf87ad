"""Demand, seasonality, lift and traffic expressions."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, functions as F

from .. import constants as K
from ..rules import Band
from .numbers import clamp, col


def base_sales(price: Column | str) -> Column:
    return F.greatest(F.lit(10), (F.lit(300.0) / (col(price) + F.lit(0.1))).cast("int"))


def seasonal_multiplier(category: Column | str, month: Column | str,
                        rules: dict[int, dict[str, float]]) -> Column:
    """First matching rule of the month, else its default, else 1.0."""
    cat, m = F.lower(col(category)), col(month)

    def for_month(table: dict[str, float]) -> Column:
        expr = F
        for pattern, mult in table.items():
            if pattern != "default":
                expr = expr.when(cat.contains(pattern), F.lit(float(mult)))
        default = F.lit(float(table.get("default", 1.0)))
        return default if expr is F else expr.otherwise(default)

    expr = F
    for number, table in rules.items():
        expr = expr.when(m == number, for_month(table))
    return expr.otherwise(F.lit(1.0))


def category_band(category: Column | str, bands: tuple[Band, ...]) -> Column:
    """Struct ``(m_lo, m_hi, w_lo, w_hi, priority)`` of the first matching band."""
    cat = F.lower(F.coalesce(col(category), F.lit("nan")))

    def band(i: int, b: Band) -> Column:
        return F.struct(
            F.lit(float(b.margin[0])).alias("m_lo"), F.lit(float(b.margin[1])).alias("m_hi"),
            F.lit(float(b.width[0])).alias("w_lo"), F.lit(float(b.width[1])).alias("w_hi"),
            F.lit(i).alias("priority"))

    expr = F
    for i, b in enumerate(bands):
        if not b.patterns:
            return expr.otherwise(band(i, b))
        expr = expr.when(reduce(lambda x, y: x | y, [cat.contains(p) for p in b.patterns]),
                         band(i, b))
    return expr.otherwise(F.lit(None))


def apply_multiplier(sales: Column | str, mult: Column | str) -> Column:
    """Sales after a forecast multiplier; NULL multiplier leaves them alone."""
    s, m = col(sales), col(mult)
    return (F.when(m.isNotNull(), F.greatest(F.lit(1), (s * m).cast("bigint")))
            .otherwise(s.cast("bigint")))


def small_store_multiplier(level: Column | str) -> Column:
    expr = F
    for lvl, mult in K.SMALL_STORE_LEVELS.items():
        expr = expr.when(col(level) == lvl, F.lit(mult))
    return expr


def adjacency_factor(neighbours: Column | str) -> Column:
    return F.lit(1.0) + F.least(col(neighbours) * F.lit(K.ADJACENCY_STEP),
                                F.lit(K.ADJACENCY_CAP))


def expected_units(popularity, level, adjacency, noise=None,
                   base: float = K.BASE_DAILY_DEMAND) -> Column:
    """Daily units, rounded half to even, at least one."""
    raw = F.lit(float(base)) * col(popularity) * small_store_multiplier(level) * col(adjacency)
    if noise is not None:
        raw = raw * col(noise)
    return F.greatest(F.lit(1).cast("bigint"), F.rint(raw).cast("bigint"))


def planogram_lift(tier="shelf_tier", facings="facing_count", end_cap="is_end_cap",
                   checkout="is_checkout", promo="adjacency_promo",
                   category="product_category", days="days_since_restock",
                   weekday="day_of_week") -> Column:
    """Sales lift of a position, in [0.3, 4]."""
    tier_lift = F
    for level, lift in K.TIER_LIFT.items():
        tier_lift = tier_lift.when(col(tier) == level, F.lit(lift))

    def gain(flag: Column, g: float) -> Column:
        return F.lit(1.0) + F.lit(g) * flag.cast("int")

    one = F.lit(1.0)
    lift = (
        tier_lift
        * (one + F.lit(K.FACING_GAIN) * F.sqrt(col(facings) - F.lit(1)))
        * gain(col(end_cap), K.END_CAP_GAIN)
        * (one + F.lit(K.CHECKOUT_GAIN) * col(checkout).cast("int")
           * (col(category) < K.CHECKOUT_CATEGORIES_BELOW).cast("int"))
        * gain(col(promo), K.PROMO_GAIN)
        * gain(col(weekday) >= 5, K.WEEKEND_GAIN)
        * (one - F.lit(K.STALE_LOSS_PER_DAY)
           * F.least(col(days), F.lit(K.STALE_DAYS_CAP)))
    )
    return clamp(lift, K.LIFT_MIN, K.LIFT_MAX)


# --- documented store model ---------------------------------------------------

def season_wave(day_of_year: Column | str, phase_days: float = 0.0) -> Column:
    angle = (F.lit(2.0 * math.pi) * (col(day_of_year) - F.lit(float(phase_days)))
             / F.lit(float(K.DAYS_IN_SEASON)))
    return F.sin(angle)


def expected_demand(base, amp, wave, trend, t, beta=None, price=None, ref_price=None,
                    promo=None, uplift=None) -> Column:
    """Base demand with season, trend, price elasticity and promotion uplift."""
    one = F.lit(1.0)
    demand = col(base) * (one + col(amp) * col(wave)) * (one + col(trend) * col(t))
    if beta is not None:
        demand = demand * (one - col(beta) * (col(price) - col(ref_price)))
    if promo is not None:
        demand = F.when(col(promo), demand * (one + col(uplift))).otherwise(demand)
    return demand


def level_visibility(level: Column | str) -> Column:
    expr = F
    for lvl, v in K.LEVEL_VISIBILITY.items():
        expr = expr.when(col(level) == lvl, F.lit(v))
    return expr


def traffic_factor(x, y, door_x, door_y, decay: float = K.TRAFFIC_DECAY) -> Column:
    """Traffic that decays with the Manhattan distance to the door."""
    distance = F.abs(col(x) - col(door_x)) + F.abs(col(y) - col(door_y))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(decay) * distance)


def position_profit(margin, demand, traffic, visibility) -> Column:
    return col(margin) * col(demand) * col(traffic) * col(visibility)


def unit_margin(price, cost) -> Column:
    return col(price) - col(cost)


def margin_abs(price, margin_pct) -> Column:
    return col(price) * col(margin_pct)


def is_premium(tier, end_cap) -> Column:
    return (col(tier) == 3) | col(end_cap)


def expiry_discount(price, today, expiry, steps: list[tuple[int, float]]) -> Column:
    """Price after the discount of the tightest matching ``(days, rate)`` step."""
    left = F.datediff(col(expiry), col(today))
    expr = F
    for days, rate in sorted(steps):
        expr = expr.when(left <= days, F.lit(float(rate)))
    return col(price) * (F.lit(1.0) - expr.otherwise(F.lit(0.0)))
