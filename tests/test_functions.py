"""Prices, rules, demand and stock on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from gondola import rules
from gondola.functions import demand as D, prices as PR, stock as ST


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


@pytest.mark.parametrize("text, value", [
    ("0,36 €", 0.36), ("32,52 €", 32.52), ("1.234,56 €", 1234.56), ("3.99", 399.0),
    (None, 0.0), ("", 0.0), ("   ", 0.0), ("abc", 0.0), ("1,2,3", 0.0), ("1,0d", 0.0),
    ("2,50 €", 2.5), (" 7 € ", 7.0), ("1 2,00 €", 0.0), ("-1,5", -1.5), ("1e3", 1000.0),
    ("5,", 5.0), (",5", 0.5), ("€", 0.0)])
def test_parse_eur(spark, text, value):
    assert one(spark, PR.parse_eur(F.lit(text).cast("string"))) == value


@pytest.mark.parametrize("category, month, mult", [
    ("Aguacate", 7, 1.6), ("Turrón", 12, 2.5), ("Ferretería", 12, 1.15),
    ("Fruta y verdura", 1, 0.8), ("Helados", 8, 1.9), ("Ferretería", 13, 1.0)])
def test_seasonal_generation(spark, category, month, mult):
    got = D.seasonal_multiplier(F.lit(category), F.lit(month), rules.SEASONAL_GENERATION)
    assert one(spark, got) == mult


def test_rule_sets_differ(spark):
    got = D.seasonal_multiplier(F.lit("Agua"), F.lit(7), rules.SEASONAL_FORECAST)
    assert one(spark, got) == 1.5


@pytest.mark.parametrize("category, margin, width", [
    ("Congelados", (35, 60), (4, 10)),  # "gel" comes before "congelad"
    ("Hielo", (25, 45), (8, 22)), ("Pan de molde", (30, 50), (8, 20)),
    ("Pescado", (20, 40), (10, 30)), ("Otra cosa", (20, 50), (5, 20)), (None, (20, 50), (5, 20))])
def test_category_band(spark, category, margin, width):
    got = one(spark, D.category_band(F.lit(category).cast("string"), rules.BANDS_GENERATION))
    assert (got["m_lo"], got["m_hi"]) == margin and (got["w_lo"], got["w_hi"]) == width


@pytest.mark.parametrize("price, sales", [(0.0, 3000), (0.9, 300), (2.9, 100), (100.0, 10)])
def test_base_sales(spark, price, sales):
    assert one(spark, D.base_sales(F.lit(price))) == sales


@pytest.mark.parametrize("sales, mult, after", [(3, 0.8, 2), (1, 0.3, 1), (10, None, 10)])
def test_apply_multiplier(spark, sales, mult, after):
    got = D.apply_multiplier(F.lit(sales), F.lit(mult).cast("double"))
    assert one(spark, got) == after


@pytest.mark.parametrize("n, factor", [(0, 1.0), (1, 1.05), (3, 1.15), (9, 1.15)])
def test_adjacency_factor(spark, n, factor):
    assert one(spark, D.adjacency_factor(F.lit(n))) == pytest.approx(factor)


def test_expected_units_round_half_to_even(spark):
    half = D.expected_units(F.lit(0.125), F.lit(3), F.lit(1.0))  # 2.5
    low = D.expected_units(F.lit(0.001), F.lit(3), F.lit(1.0))
    assert one(spark, half) == 2 and one(spark, low) == 1


@pytest.mark.parametrize("demand, sold, penalty", [
    (10.0, 10.0, 0.0), (10.0, 5.0, 6.0), (10.0, 4.9, 15.0), (0.0, 0.0, 0.0), (10.0, 0.0, 15.0)])
def test_oos_penalty(spark, demand, sold, penalty):
    got = ST.oos_penalty(F.lit(demand), F.lit(sold), F.lit(3.0))
    assert one(spark, got) == penalty


def test_day_features(spark):
    assert one(spark, ST.day_of_week(F.lit(13))) == 6
    assert one(spark, ST.week_of_year(F.lit(7 * 52))) == 1


def test_planogram_lift_is_clipped(spark):
    def lift(*v):
        return one(spark, D.planogram_lift(*[F.lit(x) for x in v]))

    assert lift(3, 6, 1, 1, 1, 0, 0, 6) == 4.0
    assert lift(0, 1, 0, 0, 0, 9, 14, 0) == pytest.approx(0.7 * 0.7)
    assert lift(2, 2, 0, 1, 0, 4, 0, 5) == pytest.approx(1.12 * 1.15)


def test_traffic_decays_with_distance(spark):
    got = [one(spark, D.traffic_factor(F.lit(x), F.lit(0), F.lit(0), F.lit(0)))
           for x in (0, 1, 3, 7)]
    assert [round(g, 2) for g in got] == [1.0, 0.87, 0.69, 0.49]
