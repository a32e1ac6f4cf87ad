"""Writers. Files are cut by Spark: no writer gathers a month in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import constants as K
from .readers import month_files


def _if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The table, or None where nothing was written yet."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def committed_batches(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame | None:
    """Distinct batch keys already written below ``path``, or None."""
    done = _if_present(lambda: spark.read.parquet(path))
    return None if done is None else done.select(*keys).distinct()


def month_file(month_key: Column | str = "month_key") -> Column:
    """``sales_YYYY_MM_name.csv`` of a month key."""
    key = F.col(month_key) if isinstance(month_key, str) else month_key
    names = F.array(*[F.lit(n) for n in K.MONTH_NAMES])
    name = F.element_at(names, F.substring(key, 6, 2).cast("int"))
    return F.concat(F.lit("sales_"), key, F.lit("_"), name, F.lit(".csv"))


def month_file_name(month_key: str) -> str:
    """``month_file`` of one key."""
    return f"sales_{month_key}_{K.MONTH_NAMES[int(month_key[5:7]) - 1]}.csv"


def existing_months(spark: SparkSession, path: str) -> DataFrame:
    """Names of the monthly files below ``path``; none where nothing was written yet."""
    there = _if_present(lambda: month_files(spark, path))
    return there if there is not None else spark.createDataFrame([], "source_file string")


def _planogram_columns(df: DataFrame) -> list[Column]:
    have = {c.lower() for c in df.columns}
    return [(F.col(c) if c.lower() in have else F.lit(None).cast("string")).alias(c)
            for c in K.PLANOGRAM_COLUMNS]


def write_monthly(df: DataFrame, path: str, fmt: str = "csv",
                  skip_existing: bool = False) -> None:
    """One folder ``source_file=sales_YYYY_MM_name.csv`` per month, fixed columns.

    ``skip_existing`` leaves months alone that are already there. The rebalance
    hint lets Spark split a large month over many files.
    """
    out = df.withColumn("source_file", month_file())
    if skip_existing:
        out = out.join(existing_months(df.sparkSession, path), "source_file", "left_anti")
    (out.select(*_planogram_columns(out), "source_file").hint("rebalance", "source_file")
     .write.mode("append" if skip_existing else "overwrite")
     .partitionBy("source_file").option("header", True).format(fmt).save(path))


def upsert_months(chunks: DataFrame, path: str) -> None:
    """Replace the months present in ``chunks``; other months stay."""
    (chunks.hint("rebalance", "month_key").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("month_key").parquet(path))


def write_daily(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Daily sales as CSV with header or as JSON records."""
    if fmt not in ("csv", "json"):
        raise ValueError(f"fmt must be 'csv' or 'json', not {fmt!r}")
    writer = df.write.mode("overwrite")
    (writer.option("header", True).csv(path) if fmt == "csv" else writer.json(path))


def prediction_names(year: int, month: int) -> tuple[str, str]:
    """Names of the layout and the multiplier table of a target month."""
    return (f"optimized_{year}_{month:02d}_{K.MONTH_NAMES[month - 1]}.csv",
            f"forecast_{year}_{month:02d}.json")


def write_prediction(layout: DataFrame, multipliers: DataFrame, path: str,
                     year: int, month: int) -> tuple[str, str]:
    """Optimised layout as CSV and multipliers as JSON, month in the name."""
    layout_path, forecast_path = (f"{path}/{n}" for n in prediction_names(year, month))
    layout.write.mode("overwrite").option("header", True).csv(layout_path)
    multipliers.write.mode("overwrite").json(forecast_path)
    return layout_path, forecast_path


def write_layouts(layouts: DataFrame, path: str) -> None:
    """One folder per model."""
    (layouts.hint("rebalance", "model").write.mode("overwrite").partitionBy("model")
     .option("header", True).csv(path))
