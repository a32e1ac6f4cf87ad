"""Rounding and seeded noise."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A half, and a margin of 1e-5 of the last place: a tie goes up whichever way
# the sum before it was added up.
HALF = 0.50001


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_up(c: Column | str, places: int) -> Column:
    """Round half up to ``places`` decimals, stable against summation noise."""
    scale = float(10 ** places)
    return F.floor(col(c) * F.lit(scale) + F.lit(HALF)) / F.lit(scale)


def uniform(seed: int | str | Column, *keys: Column | str) -> Column:
    """Uniform number in [0, 1) that depends on the seed and the keys only.

    The value does not change with partitioning, row order or retries.
    """
    first = seed if isinstance(seed, Column) else F.lit(str(seed))
    text = F.concat_ws("|", first, *[col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def clamp(c: Column | str, lo: float, hi: float) -> Column:
    return F.least(F.greatest(col(c), F.lit(lo)), F.lit(hi))
