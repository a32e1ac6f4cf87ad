"""Drawn moves against a plain restatement, for racks in one piece and in many."""

import hashlib

import pytest

from gondola.operators import whatif as W

_SCHEMA = ("month_key string, rack_id string, product_id bigint, price_numeric double, "
           "profit_margin_percentage double, estimated_monthly_sales bigint, product_width_cm double, "
           "shelf_level int")
_SIZES = {("2025_01", "a"): 1, ("2025_01", "b"): 2, ("2025_01", "c"): 40, ("2025_02", "a"): 333,
          ("2025_02", None): 5, (None, "b"): 3}
SAMPLES = [("train", 3000, 42), ("test", 500, 99)]


@pytest.fixture(scope="module")
def racks():
    """Keys of products per rack; the third has one without a key."""
    keys = {rack: [1000 * i + k for k in range(n)] for i, (rack, n) in enumerate(_SIZES.items())}
    keys["2025_01", "c"][0] = None
    return keys


@pytest.fixture(scope="module")
def planogram(spark, racks):
    rows = [(*rack, k, 1.0 + i % 11, 20.0 + i % 7, 3 + i, 5.0 + i % 30, 1 + i % 7)
            for rack, keys in racks.items() for i, k in enumerate(keys)]
    return spark.createDataFrame(rows[::-1], _SCHEMA).repartition(3)


def _u(text: str) -> float:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16) / 4294967296.0


def _plain(racks, least):
    """What every draw gives; racks lacking a part of their key are numbered, not drawn."""
    first = lambda x: (x is not None, x or "")
    order = sorted((r for r in racks if len(racks[r]) >= least), key=lambda r: [first(x) for x in r])
    for name, n, seed in SAMPLES:
        for i in range(n):
            rack = order[int(_u(f"{seed}r|{i}") * len(order))]
            if None not in rack:
                key = racks[rack][int(_u(f"{seed}p|{i}") * len(racks[rack]))]
                yield name, i, *rack, key, int(_u(f"{seed}s|{i}") * 7) + 1, len(racks[rack])


@pytest.mark.parametrize("rows, draws, least", [
    (1024, 200_000, 1), (8, 200_000, 1), (8, 50, 2), (1024, 100, 1), (1, 1, 3)])
def test_draws_are_the_same_whatever_the_pieces(planogram, racks, monkeypatch, rows, draws, least):
    monkeypatch.setattr(W, "PIECE_ROWS", rows)
    monkeypatch.setattr(W, "PIECE_DRAWS", draws)
    got = W.training_samples(planogram, SAMPLES, min_products=least).select(
        "sample", "draw_id", "month_key", "rack_id", "product_id", "new_shelf", "rack_product_count")
    want = list(_plain(racks, least))
    assert len(want) > 1500
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_products_are_dealt_out_once_and_without_the_sums_of_their_rack(planogram):
    """One join meets draws and racks; no product is numbered where all racks are one piece."""
    plan = W.training_samples(planogram, SAMPLES)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("RepartitionByExpression") == 1
    top = next(line for line in plan.splitlines() if "Join " in line)
    assert "_rack_no" in top and "_product_no" in top
    assert plan.count("Join ") == 2  # draws with racks, and products with the number of their rack
