"""Rule tables against a plain search, and the constants as tables against their CASE."""

import random

import pytest
from pyspark.sql import functions as F

from gondola import rules as R
from gondola.functions import demand as D
from gondola.operators import rule_tables as RT

SCHEMA = "month int, priority int, pattern string, mult double, note string"


def plain_rule(rules, text, month, missing=None):
    text = missing if text is None else text
    own = sorted((p, (pat or "").lower(), m, n) for g, p, pat, m, n in rules if g == month)
    for p, pat, m, n in own:
        if pat and text is not None and pat in text.lower():
            return m, n, p
    return next(((m, n, p) for p, pat, m, n in own if not pat), (None, None, None))


def random_rules(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcÑé ", k=rng.randint(1, 4)))
    rules = [(rng.choice([1, 2, 3, None]), i, word() if i % 9 else rng.choice(["", None]),
              float(i), f"r{i}") for i in range(n)]
    texts = [(rng.choice([1, 2, 3, 4, None]), "".join(rng.choices("abcñÉ ", k=rng.randint(0, 9))))
             for _ in range(300)] + [(1, None), (4, None), (2, ""), (3, "abc" * 500)]
    return rules, texts


@pytest.mark.parametrize("n", [0, 1, 40, 4000])
def test_first_rule_equals_the_plain_search(spark, n):
    rules, texts = random_rules(n, n)
    df = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "i int, month int, title string")
    table = spark.createDataFrame(rules, SCHEMA)
    got = {r.i: (r.mult, r.note, r.priority) for r in RT.with_first_rule(
        df, table, "title", ["month"]).collect()}
    assert got == {i: plain_rule(rules, t, m) for i, (m, t) in enumerate(texts)}


def test_rules_without_groups_and_a_missing_text(spark):
    rules = [(5, "NaN", 1.0), (2, "b", 2.0), (9, None, 3.0), (3, "b", 4.0)]
    table = spark.createDataFrame(rules, "priority int, pattern string, mult double")
    df = spark.createDataFrame([("xBx",), (None,), ("y",)], "t string")
    got = {r.t: (r.mult, r.priority) for r in RT.with_first_rule(
        df, table, "t", missing="nan").collect()}
    assert got == {"xBx": (2.0, 2), None: (1.0, 5), "y": (3.0, 9)}
    none = RT.first_rules(df, table.limit(0), "t").collect()
    assert {r.t: r.mult for r in none} == {"xBx": None, None: None, "y": None}
    assert RT.with_first_rule(df.limit(0), table, "t").collect() == []


def test_constants_give_the_same_as_tables(spark):
    words = sorted({p for t in R.SEASONAL_GENERATION.values() for p in t}
                   | {p for b in R.BANDS_GENERATION for p in b.patterns})
    texts = [f"{a.upper()} y {b}" for a, b in zip(words, reversed(words))] + words + ["", None]
    df = spark.createDataFrame([(m, t) for m in range(1, 14) for t in texts], "month int, category string")
    case = D.seasonal_multiplier("category", "month", R.SEASONAL_GENERATION)
    season = RT.with_first_rule(df, RT.seasonal_rules(spark, R.SEASONAL_GENERATION), "category",
                                ["month"])
    assert season.filter((F.col("month") < 13) & (F.col("multiplier") != case)).count() == 0
    assert season.filter("month < 13 AND multiplier IS NULL").count() == 0
    band = D.category_band("category", R.BANDS_GENERATION)
    table = RT.band_rules(spark, R.BANDS_GENERATION)
    bands = RT.with_first_rule(df, table, "category", missing="nan").withColumn("b", band)
    same = [F.col(c).eqNullSafe(F.col(f"b.{c}")) for c in ("m_lo", "m_hi", "w_lo", "w_hi", "priority")]
    assert bands.filter(~(same[0] & same[1] & same[2] & same[3] & same[4])).count() == 0


def test_rules_that_share_a_pattern_meet_the_texts_once(spark):
    """Of equal patterns of a group only the first rule is joined; the result stays the same."""
    texts = spark.createDataFrame([(1, "Rose tea"), (2, "rose"), (3, None), (1, "x")],
                                  "month int, title string")
    rules = spark.createDataFrame(
        [(m, p, pattern, p / 2) for m in (1, 2, None) for pattern in ("ROSE", "tea", "rose")
         for p in (9, 3, 7, 3)] + [(3, 5, None, 0.25)],
        "month int, priority int, pattern string, multiplier double")
    got = RT.first_rules(texts, rules, "title", ["month"])
    assert sorted(got.collect(), key=str) == sorted(
        [(1, "Rose tea", 1.5, 3), (2, "rose", 1.5, 3), (3, None, 0.25, 5), (1, "x", None, None)], key=str)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "min(" in plan[plan.index("Join Inner"):]
