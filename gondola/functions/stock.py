"""Inventory and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import constants as K
from .numbers import clamp, col

_EPS = 1e-6


def units_sold(demand, stock) -> Column:
    return F.greatest(F.lit(0.0), F.least(col(demand).cast("double"), col(stock).cast("double")))


def fill_rate(demand, sold) -> Column:
    return F.when(col(demand) >= _EPS, col(sold) / col(demand))


def stockout_class(demand, sold) -> Column:
    rate = fill_rate(demand, sold)
    return (F.when(rate.isNull() | (rate >= 1.0 - _EPS), "met")
            .when(rate >= K.PARTIAL_FILL_THRESHOLD, "partial")
            .otherwise("full"))


def oos_penalty(demand, sold, margin) -> Column:
    """Stock-out penalty: 2 x margin from half the demand met, else 5 x margin."""
    kind = stockout_class(demand, sold)
    return (F.when(kind == "met", F.lit(0.0))
            .when(kind == "partial", F.lit(K.PARTIAL_STOCKOUT_PENALTY) * col(margin))
            .otherwise(F.lit(K.FULL_STOCKOUT_PENALTY) * col(margin)))


def day_of_week(day) -> Column:
    return (col(day) % 7).cast("int")


def week_of_year(day) -> Column:
    return (F.floor(col(day) / 7) % 52 + 1).cast("int")


def unit_interval(c) -> Column:
    return clamp(c, 0.0, 1.0)


def month_index(month_key: Column | str) -> Column:
    """Dense month number of a ``yyyy_MM`` key."""
    k = col(month_key)
    return (F.substring(k, 1, 4).cast("int") * 12 + F.substring(k, 6, 2).cast("int"))


def month_number(month_key: Column | str) -> Column:
    return F.substring(col(month_key), 6, 2).cast("int")
