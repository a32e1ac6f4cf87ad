"""Spanish price text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .numbers import col

_NUMBER = r"^[+-]?(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+)?$"


def _digits(c: Column | str) -> Column:
    # Drop the euro sign, no-break space and thousands point; comma -> point.
    bare = F.translate(col(c), ",\u20ac\u00a0.", ".")
    return F.regexp_replace(bare, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def is_eur(c: Column | str) -> Column:
    """True where the text parses as a price; NULL text gives false."""
    return F.coalesce(_digits(c).rlike(_NUMBER), F.lit(False))


def parse_eur(c: Column | str) -> Column:
    """``'1.234,56 €'`` -> 1234.56; NULL, blank or unparseable text -> 0.0.

    Every point is a thousands separator, so ``'3.99'`` is 399.0.
    """
    digits = _digits(c)
    value = F.when(digits.rlike(_NUMBER), F.translate(digits, "_", "").try_cast("double"))
    return F.coalesce(value, F.lit(0.0))
