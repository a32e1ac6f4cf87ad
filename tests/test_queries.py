"""Every registered query against its SQL twin, and the entry points."""

import os

import pytest

import __spark_entry__ as entry_points
from tools.compare import compare, connect

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()


# Shelves of the smallest tables are neither crowded nor too full.
LAYOUTS = ("a1_", "a2_", "a3_", "a4_scored", "a4_masked", "a4_marginal", "a4_model_context", "a5_", "f9_", "g16_", "j4_")


@pytest.fixture(scope="module")
def scale(sf_dir):
    """Folder and connection for a query."""
    larger = os.path.join(os.path.dirname(sf_dir), "sf0.01")
    folders = {True: larger if os.path.isdir(larger) else sf_dir, False: sf_dir}
    opened = {folder: connect(folder) for folder in set(folders.values())}

    def of(name):
        folder = folders[name.startswith(LAYOUTS)]
        return folder, opened[folder]

    return of


def test_every_oracle_has_a_query():
    assert ORACLES.keys() <= QUERIES.keys()


def test_entry_is_the_rack_profit(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["month_key", "rack_id", "n_products", "n_shelves_used", "profit"]
    assert df.count() > 0


def test_corpus_queries_merge_partitions_as_spark_does(spark, sf_dir):
    for name, size in (("p11_base_sales", 16 << 20), ("op13_vector_codes", 64 << 20),
                       ("p11_base_sales", 16 << 20)):
        QUERIES[name](spark, sf_dir)
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(size)


@pytest.mark.parametrize("name", ["p16_apply_forecast", "g26_forecast_effect", "u1_enriched_months"])
def test_sampled_months_are_written_once(spark, sf_dir, monkeypatch, name):
    """What comes after the draw reads the written rows, instead of drawing them per use."""
    from gondola.plans.queries import enrichment
    drawn, draw = [], enrichment.E.sample_months
    monkeypatch.setattr(enrichment.E, "sample_months", lambda *a, **k: drawn.append(a) or draw(*a, **k))
    files = QUERIES[name](spark, sf_dir).inputFiles()
    assert len(drawn) == 1 and files
    assert not [f for f in files if "part.parquet" in f]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, scale, name):
    folder, con = scale(name)
    message, rows, _ = compare(spark, con, name, QUERIES[name], ORACLES.get(name), folder)
    assert message is None, message
