"""The weighted fit against a plain least squares over all moves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gondola import constants as K
from gondola.operators import whatif as W
from gondola.operators.weighted_fit import fit_weighted, move_sums
from tests import racks as X


def plain_fit(spark, rows, min_products=1):
    moves = W.move_lift(spark.createDataFrame(rows, X.SCHEMA)).filter(
        F.col("rack_product_count") >= min_products).collect()
    x = np.array([[1.0, *(float(m[c]) for c in K.MOVE_FEATURES)] for m in moves])
    y = np.array([m["profit_lift"] for m in moves])
    root = np.sqrt([1 / m["rack_product_count"] for m in moves])
    return np.linalg.lstsq(x * root[:, None], y * root, rcond=None)[0], x, y, root ** 2


def test_fit_equals_least_squares_over_all_moves(spark):
    rows = X.random_rows(12, (1, 3, 8, 25), seed=21)
    for least in (1, 3):
        beta, x, y, w = plain_fit(spark, rows, least)
        fit = fit_weighted(spark.createDataFrame(rows, X.SCHEMA), min_products=least)
        assert [fit.model.intercept, *fit.model.weights] == pytest.approx(beta, rel=1e-5, abs=1e-6)
        assert fit.n_moves == len(y)
        assert fit.n_racks == sum(len(p) >= least for p in X.by_rack(rows).values())
        mean = (w * y).sum() / w.sum()
        r2 = 1 - (w * (y - x @ beta) ** 2).sum() / (w * (y - mean) ** 2).sum()
        assert fit.r2 == pytest.approx(r2)
        assert fit.model.predict(x[:, 1:]) == pytest.approx(x @ beta, abs=1e-4)


def test_columns_that_others_determine_and_no_rows(spark):
    rows = [(*r[:5], 2.0, 20.0, 10, 30.0, r[9]) for r in X.random_rows(3, (6,), seed=2)]
    fit = fit_weighted(spark.createDataFrame(rows, X.SCHEMA))
    beta, x, y, w = plain_fit(spark, rows)
    assert fit.model.predict(x[:, 1:]) == pytest.approx(x @ beta, abs=1e-4)
    lost = [(*r[:5], None, *r[6:]) for r in rows]
    assert fit_weighted(spark.createDataFrame(lost, X.SCHEMA)).n_moves == 0
    assert move_sums(spark.createDataFrame([], X.SCHEMA)).first()["n_moves"] == 0


def test_no_python_and_one_pass(spark):
    plan = move_sums(spark.createDataFrame(X.random_rows(2, (3,)), X.SCHEMA))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
