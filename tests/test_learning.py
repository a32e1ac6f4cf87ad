"""Training rows and scores of lift models."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from gondola import constants as K
from gondola.operators import learning as ML, whatif as W

_SCHEMA = ("month_key string, rack_id string, product_id bigint, price_numeric double, "
           "profit_margin_percentage double, estimated_monthly_sales bigint, product_width_cm double, "
           "shelf_level int")


@pytest.fixture(scope="module")
def planogram(spark):
    """Two racks; product 5 of the first one is there twice, with different prices and shelves."""
    rows = [(f"2025_0{m}", "r", p, 1.0 + p * m % 11, 20.0 + p % 7, 3 + p, 5.0 + p, 1 + p % 7)
            for m in (1, 2) for p in range(1, 31)]
    return spark.createDataFrame([*rows, ("2025_01", "r", 5, 40.0, 30.0, 9, 8.0, 2)], _SCHEMA)


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_boosted_trees_schedule_few_tasks_a_level(spark):
    rows = spark.range(300_000).select(F.col("id").alias("a"), (F.col("id") % 7).alias("lift"))
    even = ML._even(rows, ["a", "lift"])
    try:
        sizes = [r["n"] for r in even.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count(F.lit(1)).alias("n")).collect()]
        assert sum(sizes) == 300_000 and len(sizes) == 2
        assert max(sizes) <= ML.TRAIN_ROWS
    finally:
        even.unpersist()


def test_draws_meet_products_that_have_their_rack(planogram):
    """The last join goes by two numbers; no join of the draws goes by the keys of a rack."""
    sample = W.training_sample(planogram, 400, 7)
    first = next(line for line in _plan(sample).splitlines() if "Join " in line)
    assert "_rack_no" in first and "_product_no" in first and "month_key" not in first
    moves = W.move_lift(planogram.filter("month_key = '2025_02'"))
    keys = ["month_key", "rack_id", "product_id", "new_shelf"]
    both = sample.filter("month_key = '2025_02'").join(
        moves.select(*keys, F.col("profit_lift").alias("lift")), keys).select("profit_lift", "lift").collect()
    assert len(both) == sample.filter("month_key = '2025_02'").count() > 100
    assert all(abs(r["profit_lift"] - r["lift"]) < 1e-9 for r in both)


def test_scores_rate_a_row_where_it_stands(planogram):
    """No row is repeated per shelf; rows of equal keys get the highest, rows without a key none."""
    moves = W.move_lift(planogram)
    model, _ = ML.fit_lift(moves, moves, "linear")
    assert isinstance(model, PipelineModel)
    extra = planogram.withColumns({"prediction": F.lit("mine"), "new_shelf": F.lit(0)})
    nameless = extra.limit(1).withColumn("product_id", F.lit(None).cast("bigint"))
    scored = ML.model_scores(model, extra.unionByName(nameless))
    assert "Generate" not in _plan(scored)
    keys = [*K.RACK_KEYS, "product_id"]
    assert scored.columns == [*keys, *[c for c in extra.columns if c not in keys], "scores"]
    full = W.move_lift(extra.unionByName(nameless)).dropna(subset=keys)
    best = {(*r[:3], r["new_shelf"]): r["p"] for r in model.transform(full).groupBy(
        *keys, "new_shelf").agg(F.max("prediction").alias("p")).collect()}
    rows = scored.collect()
    assert len(rows) == planogram.count() and all(r["new_shelf"] == 0 for r in rows)
    for r in rows:
        assert list(r["scores"]) == [best[(*[r[k] for k in keys], s)] for s in K.SHELVES]
