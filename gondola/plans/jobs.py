"""End-to-end jobs over files: generate, ingest, train, predict."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..constants import MOVE_FEATURES
from ..operators import (enrich, forecast as fc, guided, knowledge as kb, layout, learning,
                         report, whatif)
from ..operators.profit import shelf_violations
from ..session import written
from ..sources import readers, sinks
from ..streaming.ingest import replace_months


def generate_monthly(spark: SparkSession, catalog_path: str, out: str,
                     months: Sequence[str] | None = None, seed: int = 42,
                     skip_existing: bool = False) -> None:
    """Catalogue CSV -> enriched, placed and repaired monthly files.

    Racks are numbered as categories first appear in the catalogue's files. With
    ``skip_existing`` months that are already there are left out before any work.
    """
    wanted = list(months or enrich.month_keys())
    if skip_existing:
        # One name per month.
        there = {r["source_file"] for r in sinks.existing_months(spark, out).collect()}
        wanted = [m for m in wanted if sinks.month_file_name(m) not in there]
        if not wanted:
            return
    catalog = enrich.with_prices(readers.require_columns(
        readers.read_catalog(spark, catalog_path), ("Category", "name", "price"), catalog_path))
    keyed = readers.with_product_id(catalog, part=())
    rows = enrich.generate_months(keyed, wanted, seed, order="row_order")
    sinks.write_monthly(rows, out, skip_existing=skip_existing)


def monthly_planogram(spark: SparkSession, folder: str, fmt: str = "csv") -> DataFrame:
    """All monthly files with month keys and row keys."""
    rows = readers.read_monthly(spark, folder, fmt).filter(F.col("month_key").isNotNull())
    return readers.with_product_id(rows)


def build_knowledge_base(spark: SparkSession, folder: str, kb_path: str) -> DataFrame:
    """Monthly files -> one chunk per month and category; returns its statistics.

    Of several files of a month the last one by name counts, as in the stream. A
    ``sales_*`` file without a month in its name is an error.
    """
    readers.month_files(spark, folder).select(
        readers.file_month("source_file", strict=True)).write.format("noop").mode("overwrite").save()
    replace_months(spark, folder, kb_path)
    return kb.kb_stats(spark.read.parquet(kb_path))


def lift_samples(planogram: DataFrame, min_products: int = 3) -> tuple[DataFrame, DataFrame]:
    """Written training and test moves, in proportion to the planogram's rows.

    Written is what a model sees: the features and the lift.
    """
    n = planogram.count()
    both = written(whatif.training_samples(planogram, [
        ("train", max(20_000, 3 * n), 42), ("test", max(3_000, n), 99)],
        min_products=min_products).select("sample", *MOVE_FEATURES, "profit_lift"))
    return tuple(both.filter(F.col("sample") == name) for name in ("train", "test"))


def train_lift_model(planogram: DataFrame, kind: str = "gbt", min_products: int = 3,
                     **params) -> tuple[PipelineModel, DataFrame]:
    """Sampled moves of all racks -> fitted lift model and its test metrics."""
    train, test = lift_samples(written(planogram), min_products)
    return learning.fit_lift(train, test, kind, **params)


class Prediction(NamedTuple):
    """Results of ``predict_month``."""

    multipliers: DataFrame
    layout: DataFrame
    violations: DataFrame
    racks: DataFrame
    totals: DataFrame


def predict_month(base: DataFrame, month: int, replies: DataFrame | None = None,
                  model: PipelineModel | None = None, n_candidates: int = 5,
                  key: str = "product_id") -> Prediction:
    """Forecast sales of the base month's products and optimise every rack.

    Candidates come from the exact lifts, or from a fitted model that sees what is placed and
    then rates whole layouts. The layout is repaired at the end; ``violations`` are the shelves that stay too full
    because their products fit nowhere. The lift compares base sales on the old layout with forecast sales on the new
    one; ``report.lift_effects`` tells the two effects apart.
    """
    multipliers = fc.forecast(base, month, replies)
    forecasted = fc.apply_forecast(base, multipliers)
    if model is None:
        chosen = layout.ensemble_layout(whatif.with_move_scores(forecasted), n_candidates, key=key)
    else:
        chosen = guided.guided_ensemble(forecasted, model, n_candidates=n_candidates, key=key)
    best = written(layout.repair(chosen, key=key))
    racks = report.compare_racks(base, best, order=key)
    return Prediction(multipliers, best, shelf_violations(best), racks,
                      report.compare_totals(racks))
