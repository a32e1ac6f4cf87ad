"""Readers with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .. import constants as K, schemas
from ..operators.ranking import row_numbers


class MissingColumns(ValueError):
    """A required column is absent."""


def require_columns(df: DataFrame, columns: Sequence[str], where: str = "table") -> DataFrame:
    """``df`` itself, or an error that names the absent columns. Runs no job."""
    have = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in have]
    if missing:
        raise MissingColumns(f"missing columns in {where}: {missing}")
    return df


def file_order() -> Column:
    """Where a row stands in its files: name, place of the split, and place within it.

    Ids of rows rise within a split, so the struct orders rows as the files have them,
    however the splits are spread over tasks.
    """
    return F.struct(F.col("_metadata.file_name").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue CSV: five text columns, blanks as NULL, and ``row_order``.

    ``row_order`` counts the rows from 1 in the order of file names and lines. The numbered
    rows are written below the shared folder.
    """
    rows = spark.read.schema(schemas.CATALOG).option("header", True).csv(path)
    return row_numbers(rows.withColumn("_at", file_order()), [], ["_at"], "row_order").drop("_at")


def file_month(name: Column | str, strict: bool = False) -> Column:
    """Struct (year, month, month_name, month_key) of a ``sales_YYYY_MM_name.csv`` name.

    The pattern is anchored at the start only. Another name gives NULL, or an
    error where ``strict``.
    """
    name = F.col(name) if isinstance(name, str) else name
    pattern = "^" + K.MONTH_FILE_PATTERN
    part = [F.regexp_extract(name, pattern, i) for i in (1, 2, 3)]
    parsed = F.struct(part[0].cast("int").alias("year"), part[1].cast("int").alias("month"),
                      part[2].alias("month_name"),
                      F.concat_ws("_", part[0], part[1]).alias("month_key"))
    other = F.lit(None)
    if strict:
        other = F.raise_error(F.concat(
            F.lit("cannot read a month from the file name "), name,
            F.lit(", expected sales_YYYY_MM_monthname.csv")))
    return F.when(name.rlike(pattern), parsed).otherwise(other)


def with_month_from_filename(df: DataFrame, strict: bool = False) -> DataFrame:
    """Adds ``year, month, month_name, month_key`` from the source file's name."""
    if "source_file" not in df.columns:
        df = df.withColumn("source_file", F.col("_metadata.file_name"))
    return (df.withColumn("_m", file_month("source_file", strict))
            .withColumns({c: F.col(f"_m.{c}") for c in
                          ("year", "month", "month_name", "month_key")})
            .drop("_m"))


def read_monthly(spark: SparkSession, path: str, fmt: str = "csv",
                 strict: bool = False) -> DataFrame:
    """All months of a folder in one scan, with the month from the file name.

    Reads plain ``sales_*.csv`` files as well as the folders of
    ``write_monthly``, where a filter on ``source_file`` prunes months.
    """
    reader = spark.read.format(fmt).schema(schemas.PLANOGRAM).option("header", True)
    df = reader.load(path)
    if "source_file" not in df.columns:
        df = reader.option("pathGlobFilter", "sales_*.csv").load(path)
    return with_month_from_filename(df, strict)


def month_files(spark: SparkSession, path: str) -> DataFrame:
    """Names of the monthly files below ``path``; no file is opened."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return (listing.select(F.regexp_extract("path", r"(?:^|/|=)(sales_[^/]*)", 1)
                           .alias("source_file"))
            .filter(F.col("source_file") != "").distinct())


def last_file_parts(spark: SparkSession, path: str, months: Sequence[str]) -> DataFrame:
    """``month_key, source_file, part``: the parts there are of each month's last file.

    ``part`` is the path as in ``_metadata.file_path``. The folder is listed once and no file
    is opened.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    parts = listing.select(
        F.regexp_extract("path", r"(?:^|/|=)(sales_[^/]*)", 1).alias("source_file"),
        F.col("_metadata.file_path").alias("part")).withColumn(
        "month_key", file_month("source_file")["month_key"]).filter(
        F.col("month_key").isin(list(months)))
    last = parts.groupBy("month_key").agg(F.max("source_file").alias("source_file"))
    return parts.join(last, ["month_key", "source_file"])


def last_files(spark: SparkSession, path: str, months: DataFrame | None = None) -> DataFrame:
    """``month_key, source_file``: of several files of a month the last one by name.

    ``months`` (``month_key``) narrows it to some months. No file is opened.
    """
    files = (month_files(spark, path)
             .withColumn("month_key", file_month("source_file")["month_key"])
             .filter(F.col("month_key").isNotNull()))
    if months is not None:
        files = files.join(months.select("month_key").distinct(), "month_key", "left_semi")
    return files.groupBy("month_key").agg(F.max("source_file").alias("source_file"))


def read_last_files(spark: SparkSession, path: str, months: DataFrame | None = None,
                    fmt: str = "csv") -> DataFrame:
    """All rows of ``last_files``; the file names, one per month, prune the scan."""
    names = [r["source_file"] for r in last_files(spark, path, months).collect()]
    rows = read_monthly(spark, path, fmt)
    return rows.filter(F.col("source_file").isin(names) if names else F.lit(False))


def read_latest(spark: SparkSession, path: str, category: str | None = None,
                fmt: str = "csv") -> DataFrame:
    """The month whose file name sorts last, optionally one category of it."""
    last = month_files(spark, path).agg(F.max("source_file").alias("f")).first()["f"]
    df = read_monthly(spark, path, fmt).filter(F.col("source_file") == F.lit(last))
    return df if category is None else df.filter(F.col("Category") == category)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Results JSON (model -> numbers) as one row per model."""
    raw = spark.read.option("wholetext", True).text(path)
    return (raw.select(F.explode(F.from_json("value", schemas.RESULTS)).alias("model", "r"))
            .select("model", "r.*"))


def read_layouts(spark: SparkSession, path: str) -> DataFrame:
    """Layout CSVs; the model comes from the file or folder name.

    Names are upper-cased as in ``rack_layout_greedy.csv`` -> GREEDY, and
    ``original`` becomes ``Original``.
    """
    reader = spark.read.schema(schemas.PLANOGRAM).option("header", True)
    df = reader.csv(path)
    if "model" not in df.columns:
        files = reader.option("pathGlobFilter", "rack_layout_*.csv").csv(path)
        df = files.withColumn("model", F.regexp_extract(
            F.col("_metadata.file_name"), r"^rack_layout_(.*)\.csv$", 1))
    name = F.upper("model")
    return df.withColumn("model", F.when(name == "ORIGINAL", "Original").otherwise(name))


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CATEGORIES).option("multiLine", True).json(path)


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CALENDAR).option("multiLine", True).json(path)


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.GRID_LAYOUT).option("multiLine", True).json(path)


def read_daily(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    reader = spark.read.schema(schemas.DAILY_SALES)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.json(path)


def read_top_products(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.TOP_PRODUCTS).option("header", True).csv(path)


def calendar(spark: SparkSession, days: int = K.DAYS_IN_SEASON) -> DataFrame:
    """Season sine and cosine per day of year, six decimals."""
    angle = F.lit(6.283185307179586) * F.col("day_of_year") / F.lit(float(K.DAYS_IN_SEASON))
    return (spark.range(1, days + 1).select(F.col("id").cast("int").alias("day_of_year"))
            .select("day_of_year", F.round(F.sin(angle), 6).alias("season_sin"),
                    F.round(F.cos(angle), 6).alias("season_cos")))


def load_summary(df: DataFrame) -> DataFrame:
    """Rows, categories, months and files of a loaded planogram."""
    def distinct(c: str, name: str) -> Column:
        return (F.countDistinct(c) if c in df.columns else F.lit(None).cast("bigint")).alias(name)

    category = next((c for c in df.columns if c.lower() == "category"), "category")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), distinct(category, "n_categories"),
                  distinct("month_key", "n_months"), distinct("source_file", "n_files"))


IDENTITY = ("Category", "name", "subtitle", "price", "discount_price")


def with_product_id(df: DataFrame, part: Sequence[str] = ("month_key",),
                    identity: Sequence[str] = IDENTITY) -> DataFrame:
    """Adds a stable text key per row, unique within the month.

    Rows that agree in all identity columns are numbered; the number depends on
    the row's values only, not on where the row was read, unless there is a ``row_order``.
    """
    order = [c for c in df.columns if c not in part and c not in identity] or ["name"]
    w = Window.partitionBy(*part, *identity).orderBy(*order)
    text = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in identity])
    return (df.withColumn("_copy", F.row_number().over(w))
            .withColumn("product_id", F.concat_ws("-", F.md5(text), F.col("_copy")))
            .drop("_copy"))
