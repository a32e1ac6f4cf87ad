"""Profit, what-if lifts and layouts against plain restatements."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gondola import constants as K
from gondola.functions import physics as P
from gondola.operators import layout as L, profit as R, walk, whatif as W
from tests import racks as X

ROWS = X.random_rows(25, (1, 2, 7, 30, 60), seed=3)


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, X.SCHEMA).cache()


def shelves(layout):
    return {r["product_id"]: r["shelf_level"] for r in layout.collect()}


def value_of(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize("n, factor", [(0, 1.0), (5, 1.0), (6, 0.95), (15, 0.5), (20, 0.5)])
def test_crowding(spark, n, factor):
    assert value_of(spark, P.crowding(F.lit(n))) == pytest.approx(factor)


@pytest.mark.parametrize("shelf, width, factor", [
    (4, 180.0, 1.0), (4, 300.0, 0.8), (4, 360.0, 0.7), (4, 600.0, 0.7), (1, 600.0, 1.0)])
def test_diminishing(spark, shelf, width, factor):
    assert value_of(spark, P.diminishing(F.lit(shelf), F.lit(width))) == pytest.approx(factor)


@pytest.mark.parametrize("price, shelf, factor", [
    (5.0, 4, 1.0), (5.01, 4, 1.1), (1.99, 1, 1.15), (2.0, 1, 1.0), (9.0, 2, 0.85), (9.0, 6, 1.0)])
def test_price_tier(spark, price, shelf, factor):
    assert value_of(spark, P.price_tier(F.lit(price), F.lit(shelf))) == factor


@pytest.mark.parametrize("shelf, mult", [(1, 0.7), (3, 1.2), (5, 1.2), (6, 0.8), (9, 1.0)])
def test_shelf_multiplier(spark, shelf, mult):
    assert value_of(spark, P.shelf_multiplier(F.lit(shelf))) == mult


def test_rack_profit(df):
    got = {r["rack_id"]: r["profit"] for r in R.rack_profit(df).collect()}
    for rack, products in X.by_rack(ROWS).items():
        assert got[rack] == pytest.approx(X.profit(products), rel=1e-12)


def test_the_walk_rates_a_rack_as_the_operator_does(df):
    want = {r["rack_id"]: r["profit"] for r in R.rack_profit(df).collect()}
    for r in W.rack_state(df).collect():
        n, w, v = (np.array(r[c], dtype=float) for c in ("shelf_n", "shelf_w", "shelf_v"))
        assert walk._profits(n, w, v) == pytest.approx(want[r["rack_id"]], rel=1e-12)


def test_rack_profit_of_nothing_has_no_rows(df):
    assert R.rack_profit(df.limit(0)).count() == 0


def test_shelf_profits_add_up_to_the_rack(df):
    racks = {r["rack_id"]: r["profit"] for r in R.rack_profit(df).collect()}
    sums = R.shelf_profit(df).groupBy("rack_id").agg(F.sum("profit").alias("p")).collect()
    for r in sums:
        assert r["p"] == pytest.approx(racks[r["rack_id"]], rel=1e-12)


def test_single_spread_rates_a_shelf_alone(df):
    got = {(r["rack_id"], r["shelf_level"]): r["profit"]
           for r in R.shelf_profit(df, spread="single").collect()}
    for rack, products in X.by_rack(ROWS).items():
        for s in range(1, 8):
            alone = [p for p in products if p["shelf"] == s]
            if alone:
                assert got[rack, s] == pytest.approx(X.profit(alone), rel=1e-12)


def test_lift_is_profit_after_minus_before(df):
    racks = X.by_rack(ROWS)
    for r in W.move_lift(df).collect():
        products = racks[r["rack_id"]]
        if len(products) > 30:
            continue
        after = [dict(p, shelf=r["new_shelf"]) if p["key"] == r["product_id"] else p
                 for p in products]
        want = X.profit(after) - X.profit(products)
        assert r["profit_lift"] == pytest.approx(want, rel=1e-9, abs=1e-8)


def test_a_move_to_the_own_shelf_has_no_lift(df):
    own = W.move_lift(df).filter("original_shelf = new_shelf and profit_lift <> 0")
    assert own.count() == 0


def test_lift_rejects_an_unknown_shelf(df):
    with pytest.raises(Exception, match="must be 1..7"):
        W.move_lift(df.withColumn("shelf_level", F.lit(9))).collect()


def test_training_sample_draws_from_the_moves(df):
    sample = W.training_sample(df, 500, 7)
    rows = sample.collect()
    assert len(rows) == 500 and len({r["draw_id"] for r in rows}) == 500
    lifts = {(r["product_id"], r["new_shelf"]): r["profit_lift"]
             for r in W.move_lift(df).collect()}
    # Sums in another order: equal up to summation noise.
    assert all(r["profit_lift"] == pytest.approx(lifts[r["product_id"], r["new_shelf"]],
                                                 rel=1e-9, abs=1e-8) for r in rows)
    # Racks are drawn uniformly whatever their size.
    assert sample.select("rack_id").distinct().count() == 25


def test_training_sample_skips_small_racks(df):
    small = {rack for rack, p in X.by_rack(ROWS).items() if len(p) < 3}
    drawn = {r["rack_id"] for r in W.training_sample(df, 500, 7, min_products=3).collect()}
    assert small and not small & drawn


@pytest.mark.parametrize("rule", ["first_fit", "worst_fit"])
def test_repair(df, rule):
    got = shelves(L.repair(df, rule))
    for products in X.by_rack(ROWS).values():
        for key, shelf in X.repaired(products, rule == "worst_fit").items():
            assert got[key] == shelf


def test_repair_keeps_products_and_fixes_what_fits(df):
    fixed = L.repair(df)
    assert fixed.count() == df.count()
    before = {(r["rack_id"], r["shelf_level"]) for r in R.shelf_violations(df).collect()}
    after = {(r["rack_id"], r["shelf_level"]) for r in R.shelf_violations(fixed).collect()}
    assert after < before
    report = L.repair_report(df).first()
    assert (report["n_before"], report["n_after"]) == (len(before), len(after))


def test_greedy(df):
    got = shelves(L.greedy_layout(df))
    for products in X.by_rack(ROWS).values():
        for key, shelf in X.greedy(products).items():
            assert got[key] == shelf


def test_scored(df):
    rows = W.with_move_scores(df)
    scores = {r["product_id"]: r["scores"] for r in rows.collect()}
    got = shelves(L.scored_layout(rows))
    for products in X.by_rack(ROWS).values():
        for key, shelf in X.scored(products, scores).items():
            assert got[key] == shelf


def test_marginal(df):
    got = shelves(L.marginal_layout(df))
    for products in X.by_rack(ROWS).values():
        if len(products) <= 30:
            for key, shelf in X.marginal(products).items():
                assert got[key] == shelf


def test_ensemble_is_never_worse_than_its_first_candidate(df):
    rows = W.with_move_scores(df)
    plain = {r["rack_id"]: r["profit"]
             for r in R.rack_profit(L.scored_layout(rows)).collect()}
    best = L.ensemble_layout(rows)
    sizes = {rack: len(p) for rack, p in X.by_rack(ROWS).items()}
    for r in R.rack_profit(best).collect():
        if sizes[r["rack_id"]] >= 2:
            assert r["profit"] >= plain[r["rack_id"]] - 1e-4
    original = {p["key"]: p["shelf"] for ps in X.by_rack(ROWS).values() if len(ps) < 2 for p in ps}
    got = shelves(best)
    assert original and all(got[k] == s for k, s in original.items())
    one = L.ensemble_layout(rows, n_candidates=1)
    assert {k: s for k, s in shelves(one).items() if k not in original} == {
        k: s for k, s in shelves(L.scored_layout(rows)).items() if k not in original}


# One rack with a third of all rows, far more than its shelves can hold.
HOT = X.random_rows(1, (4000,), seed=9, widths=(1, 50))


@pytest.fixture(scope="module")
def hot(spark):
    return spark.createDataFrame(HOT, X.SCHEMA).cache()


def test_candidates_decide_a_hot_rack(hot):
    products = X.by_rack(HOT)["R0"]
    assert shelves(L.greedy_layout(hot)) == X.greedy(products)
    rng = random.Random(5)
    scores = {p["key"]: [rng.choice([0.0, 1.0, 2.0, 3.0]) for _ in range(7)] for p in products}
    table = hot.sparkSession.createDataFrame(
        list(scores.items()), "product_id long, scores array<double>")
    assert shelves(L.scored_layout(hot.join(table, "product_id"))) == X.scored(products, scores)


@pytest.mark.parametrize("rule", ["first_fit", "worst_fit"])
def test_candidates_decide_the_repair_of_a_hot_rack(spark, rule):
    # Two shelves overflow by far, the others have room.
    rows = [(*r[:9], 1 + i % 2 if i % 8 else 3 + i % 5) for i, r in enumerate(HOT[:900])]
    df = spark.createDataFrame(rows, X.SCHEMA)
    want = X.repaired(X.by_rack(rows)["R0"], rule == "worst_fit")
    assert shelves(L.repair(df, rule)) == want


def test_fewer_candidates_than_rows_of_one_width(spark):
    rows = [("2025_01", "R", i, "n", "C", 3.0, 30.0, i % 90 + 1, 30.0, 1 + i % 7)
            for i in range(3000)]
    df = spark.createDataFrame(rows, X.SCHEMA)
    ranked = df.withColumn("_priority", P.base_profit())
    picked = L._candidates(ranked, ["rack_id"], [F.desc("_priority"), "product_id"], "product_id")
    assert picked.count() == 7 * (2400 // 30 + 2)
    assert shelves(L.greedy_layout(df)) == X.greedy(X.by_rack(rows)["R"])


def test_scores_that_allow_some_shelves_only(spark):
    """Products of one width and shelf that may go to different shelves."""
    rows = [("2025_01", "R", i, "n", "C", 3.0, 30.0, 5000 - i, 1.0, 1) for i in range(3000)]
    df = spark.createDataFrame(rows, X.SCHEMA).withColumn("scores", F.array(*[
        F.when(F.col("product_id") < 2500, 1.0 if s == 2 else None).otherwise(
            1.0 if s == 3 else None) for s in range(1, 8)]).cast("array<double>"))
    got = shelves(L.scored_layout(df))
    assert sorted(k for k in got if got[k] == 2) == list(range(300))
    assert sorted(k for k in got if got[k] == 3) == list(range(2500, 2800))


@pytest.mark.parametrize("shelf", [9, 0, None])
def test_products_on_an_unknown_shelf_move(spark, shelf):
    rows = [("2025_01", "R", i, "n", "C", 3.0, 30.0, 100 - i, 200.0, shelf) for i in range(5)]
    df = spark.createDataFrame(rows, X.SCHEMA)
    assert shelves(L.greedy_layout(df)) == {0: 3, 1: 4, 2: 5, 3: shelf, 4: shelf}


def test_narrow_and_missing_widths(spark):
    rng = random.Random(8)
    rows = [(*r[:8], rng.choice([0.25, 0.5, 0.7, 40.0, 90.5]), r[9])
            for r in X.random_rows(4, (700,), seed=6)]
    blank = [("2025_01", "R0", 10_000 + i, "n", "C", 9.0, 50.0, 900, None, 1) for i in range(3)]
    df = spark.createDataFrame(rows + blank, X.SCHEMA)
    got, fixed = shelves(L.greedy_layout(df)), shelves(L.repair(df))
    for products in X.by_rack(rows).values():
        greedy, repaired = X.greedy(products), X.repaired(products, False)
        assert all(got[k] == v for k, v in greedy.items())
        assert all(fixed[k] == v for k, v in repaired.items())
    assert all(got[r[2]] == fixed[r[2]] == 1 for r in blank)


def test_products_without_a_profit_come_last(spark):
    rows = [("2025_01", "R", i, "n", "C", None if i == 0 else 3.0, 30.0, 10, 300.0, 1)
            for i in range(8)]
    df = spark.createDataFrame(rows, X.SCHEMA)
    assert shelves(L.marginal_layout(df))[0] == 1 and shelves(L.greedy_layout(df))[0] == 1


@pytest.mark.parametrize("batch", [1, 7, 100])
def test_racks_that_run_over_many_batches(spark, df, batch):
    """The walk carries a rack from batch to batch."""
    rows = W.with_move_scores(df)
    whole = shelves(L.scored_layout(rows)), shelves(L.ensemble_layout(rows))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert shelves(L.scored_layout(rows)) == whole[0]
        assert shelves(L.ensemble_layout(rows)) == whole[1]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_distinct_widths_of_a_hot_rack(spark):
    rng = random.Random(4)
    rows = [(*r[:8], rng.uniform(0.5, 60.0), r[9]) for r in HOT]
    df = spark.createDataFrame(rows, X.SCHEMA)
    assert shelves(L.greedy_layout(df)) == X.greedy(X.by_rack(rows)["R0"])


@pytest.mark.parametrize("parts", [1, 5])
def test_result_does_not_depend_on_partitions(df, parts):
    assert shelves(L.greedy_layout(df.repartition(parts))) == shelves(L.greedy_layout(df))


def test_best_layout(spark, df):
    greedy = L.greedy_layout(df)
    both = (df.withColumn("model", F.lit("Original"))
            .unionByName(greedy.withColumn("model", F.lit("GREEDY"))))
    assert L.best_layout(both).first()["model"] == "GREEDY"
    three = both.unionByName(df.withColumn("shelf_level", F.lit(1))
                             .withColumn("model", F.lit("MLP")))
    assert L.best_layout(three).first()["model"] == "MLP"


def test_shelf_counts_fill_empty_shelves(spark):
    rows = spark.createDataFrame([("A", 1), ("A", 1), ("B", 7)], "model string, shelf_level int")
    got = {r["shelf_level"]: (r["A"], r["B"]) for r in R.shelf_counts(rows, ["A", "B"]).collect()}
    assert got == {1: (2, 0), 7: (0, 1), **{s: (0, 0) for s in range(2, 7)}}


def crowded_rows(n, seed, least=0.5, most=60.0):
    """One rack of ``n`` products whose widths never repeat, and a small one."""
    rng = random.Random(seed)
    rows = [("2025_01", "hot", i, "P", "C", round(rng.uniform(0.5, 9.5), 2), 30.0,
             rng.randint(1, 300), least + (most - least) * rng.random() + i * 1e-9,
             rng.randint(1, 7)) for i in range(n)]
    return rows + [("2025_01", "small", n + i, "P", "C", 3.0, 30.0, 9 + i, 100.0, 4)
                   for i in range(6)]


@pytest.mark.parametrize("least", [0.5, 59.9])
def test_widths_that_never_repeat_give_the_same_layouts(spark, least):
    """Rows that narrower ones rule out decide nothing, in any layout by priority."""
    rows = crowded_rows(3000, 11, least)
    df = spark.createDataFrame(rows, X.SCHEMA).repartition(5)
    want, marginal = {}, {}
    for products in X.by_rack(rows).values():
        want.update(X.greedy(products))
    assert shelves(L.greedy_layout(df)) == want
    rng = random.Random(3)
    scores = {r[2]: [rng.random() for _ in range(7)] for r in rows}
    for products in X.by_rack(rows).values():
        marginal.update(X.scored(products, scores))
    scored = df.join(spark.createDataFrame(list(scores.items()), "product_id long, scores array<double>"),
                     "product_id")
    assert shelves(L.scored_layout(scored)) == marginal


def test_a_hot_rack_sends_a_bounded_number_of_rows(spark):
    """A rack of any size whose widths all differ.

    For even widths of 1 to 300 cm on seven shelves the bound comes to some 33,000 rows.
    """
    def sent(n):
        rack = spark.range(n).select(
            F.lit("2025_01").alias("month_key"), F.lit("hot").alias("rack_id"),
            F.col("id").alias("product_id"), (1 + F.col("id") % 7).cast("int").alias("shelf_level"),
            (F.rand(5) * 299 + 1).alias("product_width_cm"), F.rand(6).alias("value"))
        chosen = L._candidates(rack, ["month_key", "rack_id"], [F.desc("value"), "product_id"],
                               "product_id")
        return chosen.count()

    assert sent(600_000) < 33_000


def test_small_racks_are_walked_as_a_whole(spark):
    """Racks of up to ``WHOLE_RACK`` rows keep all rows, larger ones their candidates only."""
    sizes = {"small": L.WHOLE_RACK, "large": L.WHOLE_RACK + 1, None: L.WHOLE_RACK + 1}
    rows = [("2025_01", rack, i, "n", "C", 3.0, 30.0, i % 90 + 1, 150.0, 1 + i % 7)
            for rack, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, X.SCHEMA)
    picked = L._candidates(df.withColumn("value", P.base_profit()), K.RACK_KEYS,
                           [F.desc("value"), "product_id"], "product_id")
    got = {r["rack_id"]: r["count"] for r in picked.groupBy("rack_id").count().collect()}
    assert got == {"small": L.WHOLE_RACK, "large": 7 * (2400 // 150 + 2), None: 7 * (2400 // 150 + 2)}


def test_random_layouts_meet_as_sums(spark, tmp_path):
    """Products are moved once, not once a run: each run's overflow and profit come from the same sums."""
    df = spark.createDataFrame(X.random_rows(2, (30,), seed=4, widths=(20, 60)), X.SCHEMA)
    plan = L.random_baseline(df, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1 and "Join" not in plan
    many = L.random_layouts(df, 5, 42)
    keys = [*K.RACK_KEYS, "run"]
    bad = {(r["rack_id"], r["run"]) for r in L.shelf_violations(many, keys).collect()}
    profit = {(r["rack_id"], r["run"]): r["profit"] for r in L.rack_profit(many, keys).collect()}
    for r in L.random_baseline(df, 5).collect():
        runs = [k for k in profit if k[0] == r["rack_id"]]
        assert r["valid_share"] == pytest.approx(sum(k not in bad for k in runs) / 5)
        assert r["mean_profit"] == pytest.approx(sum(profit[k] for k in runs) / 5)
