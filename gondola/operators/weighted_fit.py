"""Least squares over the whole move space, from sums alone.

The training sample draws a rack, then a product, then a shelf, uniformly: a move has the
weight ``1 / (racks * products of the rack * 7)``. With these weights on all moves, in their closed
form, nothing has to be drawn or written: one pass gives the weighted sums of all products of
two columns, and the normal equations give the model.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from .flat_model import LinearArrays
from .whatif import move_lift


class WeightedFit(NamedTuple):
    model: LinearArrays
    #: Moves and racks behind the fit, and the weighted share of the variance that it explains.
    n_moves: int
    n_racks: int
    r2: float


def move_sums(df: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS, key: str = "product_id",
              min_products: int = 1) -> DataFrame:
    """One row: moves, racks, and ``sums``, the upper triangle of the weighted sums of products.

    The columns are 1, the ten move features and the lift, in this order. Moves that lack
    one of them are left out.
    """
    z = [F.lit(1.0), *[F.col(c).cast("double") for c in (*K.MOVE_FEATURES, "profit_lift")]]
    rows = move_lift(df, rack_keys, [key]).filter(F.col("rack_product_count") >= min_products)
    rows = rows.dropna(subset=[*K.MOVE_FEATURES, "profit_lift"])
    weight = 1.0 / F.col("rack_product_count")
    products = [F.sum(weight * a * b) for i, a in enumerate(z) for b in z[i:]]
    return rows.agg(F.count(F.lit(1)).alias("n_moves"),
                    F.coalesce(F.sum(weight), F.lit(0.0)).alias("_total"),
                    F.array(*products).alias("sums")).select(
        "n_moves", F.round(F.col("_total") / K.NUM_SHELVES).cast("bigint").alias("n_racks"), "sums")


def fit_weighted(df: DataFrame, rack_keys: Sequence[str] = K.RACK_KEYS, key: str = "product_id",
                 min_products: int = 1) -> WeightedFit:
    """Least squares on all moves with the weights of the sample.

    A feature that the others determine has no coefficient of its own; of all
    solutions the shortest, in units of each column's size, is taken. No moves give zeros.
    """
    row = move_sums(df, rack_keys, key, min_products).first()
    n = len(K.MOVE_FEATURES) + 2
    if not row["n_moves"]:
        return WeightedFit(LinearArrays(np.zeros(n - 2), 0.0), 0, 0, 0.0)
    upper = np.zeros((n, n))
    upper[np.triu_indices(n)] = row["sums"]
    sums = upper + np.triu(upper, 1).T
    size = np.sqrt(np.diag(sums))
    size[size == 0] = 1.0
    even = sums / np.outer(size, size)
    beta = np.linalg.lstsq(even[:-1, :-1], even[:-1, -1], rcond=1e-13)[0] * size[-1] / size[:-1]
    total, left = sums[0, 0], sums[-1, -1] - beta @ sums[:-1, -1]
    spread = sums[-1, -1] - sums[0, -1] ** 2 / total
    return WeightedFit(LinearArrays(beta[1:], float(beta[0])), row["n_moves"], row["n_racks"],
                       float(1 - left / spread) if spread > 0 else 0.0)
