"""Monthly sampling, heuristic enrichment, rack and shelf assignment."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import constants as K, rules
from ..functions import demand as D
from ..functions.numbers import half_up, uniform
from ..functions.prices import parse_eur
from ..functions.stock import month_number
from ..session import written
from ..sources.sinks import committed_batches
from .layout import repair
from .ranking import first_fraction, row_numbers

ESTIMATES = ("estimated_monthly_sales", "profit_margin_percentage", "product_width_cm")


def month_keys(year: int = 2025, months: Sequence[int] = range(1, 13)) -> list[str]:
    return [f"{year:04d}_{m:02d}" for m in months]


def with_prices(catalog: DataFrame) -> DataFrame:
    """Numeric columns for the two price texts of the catalogue."""
    return catalog.withColumns({
        "price_numeric": parse_eur("price"),
        "discount_price_numeric": parse_eur("discount_price")})


def sample_months(catalog: DataFrame, months: Sequence[str], seed: int = 42,
                  lo: float = 0.6, hi: float = 0.9, key: str = "product_id") -> DataFrame:
    """A 60-90 % subset of the catalogue per month, at least 10 products.

    Exactly ``max(10, int(n * share))`` products per month, without replacement;
    the share and the choice depend on the seed, the month and the product key.
    """
    n = catalog.agg(F.count(F.lit(1))).scalar()
    share = F.lit(lo) + F.lit(hi - lo) * uniform(f"{seed}m", "month_key")
    wanted = (catalog.sparkSession.createDataFrame([(m,) for m in months], "month_key string")
              .withColumn("n_keep", F.greatest(F.lit(10).cast("bigint"),
                                               (n * share).cast("bigint"))))
    rows = catalog.withColumn("month_key", F.explode(F.array(*[F.lit(m) for m in months])))
    return first_fraction(rows, ["month_key"], uniform(f"{seed}k", "month_key", key), [key],
                          wanted)


def _between(lo: Column, hi: Column, u: Column) -> Column:
    return lo + (hi - lo) * u


def _margin_and_width(category: Column, bands, seed: str, keys: Sequence) -> tuple[Column, Column]:
    band = D.category_band(category, bands)
    margin = half_up(_between(band["m_lo"], band["m_hi"], uniform(f"{seed}m", *keys)), 1)
    width = half_up(_between(band["w_lo"], band["w_hi"], uniform(f"{seed}w", *keys)), 1)
    return margin, width


def heuristic_estimates(seed: int, keys: Sequence[str],
                        seasonal=rules.SEASONAL_GENERATION,
                        bands=rules.BANDS_GENERATION) -> dict[str, Column]:
    """Sales, margin and width from price, category and month."""
    noise = F.lit(0.7) + F.lit(0.6) * uniform(f"{seed}s", *keys)
    noisy = (D.base_sales("price_numeric") * noise).cast("int")
    season = D.seasonal_multiplier("category", month_number("month_key"), seasonal)
    margin, width = _margin_and_width(F.col("category"), bands, str(seed), keys)
    wobble = F.lit(0.95) + F.lit(0.1) * uniform(f"{seed}x", *keys)
    return {
        "estimated_monthly_sales": F.greatest(F.lit(1), (noisy * season).cast("int")),
        "profit_margin_percentage": half_up(margin * wobble, 1),
        "product_width_cm": width,
    }


def enrich_heuristic(df: DataFrame, seed: int = 42,
                     keys: Sequence[str] = ("month_key", "product_id")) -> DataFrame:
    return df.withColumns(heuristic_estimates(seed, keys))


def enrich_simple(df: DataFrame, seed: int = 42,
                  keys: Sequence[str] = ("product_id",)) -> DataFrame:
    """Estimates without a season: whole-number sales around the base, eight bands."""
    base = D.base_sales("price_numeric")
    lo = F.greatest(F.lit(1), base - 20)
    margin, width = _margin_and_width(F.col("category"), rules.BANDS_SIMPLE, str(seed), keys)
    return df.withColumns({
        "estimated_monthly_sales":
            (lo + F.floor(uniform(f"{seed}s", *keys) * (base + 50 - lo))).cast("int"),
        "profit_margin_percentage": margin,
        "product_width_cm": width})


def fill_estimates(df: DataFrame, seed: int = 42,
                   keys: Sequence[str] = ("month_key", "product_id")) -> DataFrame:
    """Heuristic values for rows without an estimate (sales NULL or 0)."""
    missing = F.coalesce(F.col("estimated_monthly_sales"), F.lit(0)) == 0
    return df.withColumns({
        name: F.when(missing, value).otherwise(F.col(name))
        for name, value in heuristic_estimates(seed, keys).items()})


def assign_rack(df: DataFrame, part: Sequence[str] = ("month_key",),
                order: str = "product_id") -> DataFrame:
    """Rack id = index of the category by first appearance within the month."""
    first = df.groupBy(*part, "category").agg(F.min(order).alias("_first"))
    by_first = Window.partitionBy(*part).orderBy("_first", "category")
    racks = first.select(*part, "category",
                         (F.row_number().over(by_first) - 1).alias("rack_id"))
    return df.join(racks, [*part, "category"])


def assign_shelf(df: DataFrame, seed: int = 42,
                 keys: Sequence[str] = ("month_key", "product_id")) -> DataFrame:
    """Seeded random shelf 1..7."""
    shelf = 1 + F.floor(uniform(f"{seed}f", *keys) * K.NUM_SHELVES)
    return df.withColumn("shelf_level", shelf.cast("int"))


def generate_months(catalog: DataFrame, months: Sequence[str], seed: int = 42,
                    lo: float = 0.6, hi: float = 0.9, key: str = "product_id",
                    order: str | None = None) -> DataFrame:
    """Sampled, enriched, placed and repaired planograms of all months.

    ``order`` is the column by which categories appear first, ``key`` unless given.
    The placed rows feed the shelf sums, the repair and the result, so they are
    written to the shared folder once.
    """
    rows = sample_months(catalog, months, seed, lo, hi, key)
    enriched = enrich_heuristic(rows, seed, ("month_key", key))
    placed = assign_shelf(assign_rack(enriched, order=order or key), seed, ("month_key", key))
    return repair(written(placed), "worst_fit", key=key)


def batch_rows(df: DataFrame, size: int, part: Sequence[str] = ("month_key",),
               order: str = "product_id") -> DataFrame:
    """Batches of ``size`` rows per group: ``batch_id`` from 0, ``item_no`` from 1."""
    numbered = row_numbers(df, part, [order], name="_row_no")
    at = F.col("_row_no") - 1
    return (numbered.withColumn("batch_id", F.floor(at / size))
            .withColumn("item_no", (at % size + 1).cast("int")).drop("_row_no"))


def enrich_resumable(df: DataFrame, path: str, enricher, slices: int = 1,
                     part: Sequence[str] = ("month_key",)) -> DataFrame:
    """Enrich batches that are not yet written below ``path``; returns all of them.

    Each slice of batches is a commit: its rows are written to a folder of their own, then its
    batches to the ledger beside ``path``. What has no entry there was never finished: it is not
    read, and its batches are done again. So a run that stops anywhere goes on with the first
    slice that is missing, and finding it reads the ledger, not the output.
    """
    keys = [*part, "batch_id"]
    spark, ledger = df.sparkSession, f"{path.rstrip('/')}-ledger"
    for number in range(slices):
        todo = df.filter(F.pmod(F.xxhash64(*keys), F.lit(slices)) == number)
        done = committed_batches(spark, ledger, keys)
        if done is not None:
            todo = todo.join(done, keys, "left_anti")
        commit = f"commit=c{uuid.uuid4().hex}"
        enricher(todo).write.parquet(f"{path}/{commit}")
        (spark.read.parquet(f"{path}/{commit}").select(*keys).distinct()
         .write.parquet(f"{ledger}/{commit}"))
    known = spark.read.parquet(ledger).select("commit").distinct()
    # One name per slice of every run.
    commits = [r["commit"] for r in known.collect()]
    rows = spark.read.parquet(path)
    return rows.filter(F.col("commit").isin(commits) if commits else F.lit(False)).drop("commit")
