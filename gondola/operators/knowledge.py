"""Monthly category summaries, their text, retrieval and trends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import constants as K
from ..functions.numbers import half_up
from ..functions.stock import month_index
from ..sources.readers import require_columns
from ..sources.sinks import month_file
from .ranking import top_n

_KEYS = ("month_key", "category")
KB_REQUIRED = ("category", "name", "estimated_monthly_sales", "price_numeric",
               "profit_margin_percentage", "product_width_cm", "shelf_level")
_MEASURES = {"estimated_monthly_sales": "sales", "price_numeric": "price",
             "profit_margin_percentage": "margin", "product_width_cm": "width"}


_SUMS = ("n", *(f"{what}_{n}" for n in _MEASURES.values() for what in ("sum", "n")))
#: What tells a part of a monthly file apart, besides its month.
_PART = ("source_file", "month_name", "part")


def _per_shelf(df: DataFrame, keys: Sequence[str] = _KEYS) -> DataFrame:
    """Counts and sums per (month, category, shelf): one pass, combined map-side."""
    sums = [a for c, n in _MEASURES.items()
            for a in (F.sum(c).alias(f"sum_{n}"), F.count(c).alias(f"n_{n}"))]
    return (df.filter(F.col("category").isNotNull()).groupBy(*keys, "shelf_level")
            .agg(F.count(F.lit(1)).alias("n"), *sums))


def _best_sellers(df: DataFrame, key: str, keys: Sequence[str] = _KEYS) -> DataFrame:
    """The five best sellers with their ``rank``, by a map-side limit."""
    return top_n(df.filter(F.col("category").isNotNull()), keys,
                 [F.desc("estimated_monthly_sales"), key], 5)


def _summary(per_shelf: DataFrame, *extra: Column) -> DataFrame:
    def avg(n: str) -> Column:
        return (F.sum(f"sum_{n}") / F.sum(f"n_{n}")).alias(f"avg_{n}")

    return per_shelf.groupBy(*_KEYS).agg(
        F.sum("n").alias("n_products"),
        F.sum("sum_sales").cast("double").alias("total_sales"),
        *[avg(n) for n in _MEASURES.values()], *extra)


def category_summary(df: DataFrame) -> DataFrame:
    """Products, total and mean sales, mean price, margin and width per category."""
    return _summary(_per_shelf(df))


def _fixed(c: Column | str, places: int) -> Column:
    value = half_up(c, places)
    if places == 0:
        return value.cast("bigint").cast("string")
    return F.format_string(f"%.{places}f", value)


def category_documents(df: DataFrame, key: str = "product_id") -> DataFrame:
    """One line of text per (month, category), with its metadata.

    Lists are bounded before they are collected: one entry per shelf level and the
    five best sellers, which ``top_n`` selects with a map-side limit.
    """
    return _documents(_per_shelf(df), _best_sellers(df, key))


def _documents(per_shelf: DataFrame, best: DataFrame) -> DataFrame:
    shelves = F.sort_array(F.collect_list(F.struct("shelf_level", "n"))).alias("_shelves")
    # A shelf level of NULL counts in the totals, not in the distribution.
    summary = _summary(per_shelf, shelves)
    sellers = best.groupBy(*_KEYS).agg(F.sort_array(F.collect_list(
        F.struct("rank", "name", F.col("estimated_monthly_sales").cast("bigint").alias("units")))
    ).alias("_top"))
    shelf_text = F.array_join(F.transform(
        F.filter("_shelves", lambda s: s["shelf_level"].isNotNull()),
        lambda s: F.concat(F.lit("S"), s["shelf_level"].cast("string"), F.lit(": "),
                           s["n"].cast("string"))), ", ")
    top_text = F.array_join(F.transform(
        "_top", lambda t: F.concat(t["name"], F.lit(" ("), t["units"].cast("string"),
                                   F.lit(" units)"))), ", ")
    month = F.concat(F.substring("month_key", 6, 2), F.lit("/"), F.substring("month_key", 1, 4))
    values = (
        F.col("category"), month, F.col("n_products").cast("string"), _fixed("total_sales", 0),
        _fixed("avg_sales", 0), _fixed("avg_price", 2), _fixed("avg_margin", 1),
        _fixed("avg_width", 1), shelf_text, top_text)
    document = F.concat(*[part for label, value in zip(K.SUMMARY_LABELS, values)
                          for part in (F.lit(label), value)])
    return (summary.join(sellers, list(_KEYS))
            .withColumn("document", document).drop("_shelves", "_top"))


def kb_chunks(df: DataFrame, key: str = "product_id") -> DataFrame:
    """Documents with id and metadata, ready for ``upsert_months``.

    File and month name come from the rows where they have them, as the readers' rows do;
    else they follow from the month.
    """
    require_columns(df, KB_REQUIRED, "monthly planogram")
    docs = category_documents(df, key)
    known = [c for c in ("source_file", "month_name") if c in df.columns]
    if known:
        docs = docs.join(df.groupBy("month_key").agg(*[F.max(c).alias(c) for c in known]),
                         "month_key")
    return _chunks(docs)


def _chunks(docs: DataFrame) -> DataFrame:
    """Documents with ids and dates."""
    month = F.substring("month_key", 6, 2).cast("int")
    named = F.element_at(F.array(*[F.lit(n) for n in K.MONTH_NAMES]), month)
    return docs.select(
        F.concat_ws("_", "month_key", "category").alias("id"), "document",
        F.substring("month_key", 1, 4).cast("int").alias("year"), month.alias("month"),
        (F.col("month_name") if "month_name" in docs.columns else named).alias("month_name"),
        "category", "n_products", "total_sales", "avg_sales", "avg_price", "avg_margin",
        (F.col("source_file") if "source_file" in docs.columns else month_file())
        .alias("source_file"), "month_key")


def month_parts(df: DataFrame, key: str = "product_id") -> DataFrame:
    """What each part of a monthly file gives to its month's chunks; it can be merged.

    One row per (month, file, part, category): sums by shelf level, and the five best sellers.
    """
    require_columns(df, (*KB_REQUIRED, *_PART), "monthly planogram")
    keys = ["month_key", *_PART, "category"]
    shelves = _per_shelf(df, keys).groupBy(*keys).agg(
        F.collect_list(F.struct("shelf_level", *_SUMS)).alias("shelves"))
    top = _best_sellers(df, key, keys).groupBy(*keys).agg(F.collect_list(F.struct(
        F.col(key).alias("seller"), "name", "estimated_monthly_sales")).alias("top"))
    return shelves.join(top, keys)


def chunks_of_parts(parts: DataFrame) -> DataFrame:
    """``kb_chunks`` of the rows behind ``month_parts``, of one file per month."""
    shelves = parts.select(*_KEYS, F.inline("shelves")).groupBy(*_KEYS, "shelf_level").agg(
        *[F.sum(c).alias(c) for c in _SUMS])
    best = top_n(parts.select(*_KEYS, F.inline("top")), _KEYS,
                 [F.desc("estimated_monthly_sales"), "seller"], 5)
    files = parts.groupBy("month_key").agg(*[F.max(c).alias(c) for c in _PART[:2]])
    return _chunks(_documents(shelves, best).join(files, "month_key"))


def kb_stats(kb: DataFrame) -> DataFrame:
    return kb.agg(
        F.count(F.lit(1)).alias("total_chunks"),
        F.sort_array(F.collect_set("month_key")).alias("months"),
        F.countDistinct("month_key").alias("n_months"),
        F.countDistinct("category").alias("n_categories"))


def month_stats(df: DataFrame) -> DataFrame:
    return df.groupBy("month_key").agg(
        F.count(F.lit(1)).alias("n_products"),
        F.countDistinct("category").alias("n_categories"),
        F.avg("estimated_monthly_sales").alias("avg_sales"),
        F.avg("profit_margin_percentage").alias("avg_margin"),
        F.avg("product_width_cm").alias("avg_width"))


def latest_month(df: DataFrame, category: str | None = None) -> DataFrame:
    """Rows of the last month, optionally of one category."""
    last = df.agg(F.max("month_key")).scalar()
    rows = df.filter(F.col("month_key") == last)
    return rows if category is None else rows.filter(F.col("category") == category)


def wanted_months(year: int, month: int, n_recent: int = 2) -> list[str]:
    """The last ``n_recent`` months and the same month last year, without repeats."""
    at = year * 12 + month - 1
    indexes = {at - i for i in range(1, n_recent + 1)} | {at - 12}
    return sorted(f"{i // 12}_{i % 12 + 1:02d}" for i in indexes)


def retrieve_context(kb: DataFrame, year: int, month: int, category: str | None = None,
                     n_recent: int = 2) -> DataFrame:
    """Chunks of the wanted months with their metadata.

    Over a table of ``upsert_months`` the month filter is a partition filter: other months
    are not opened.
    """
    rows = kb.filter(F.col("month_key").isin(wanted_months(year, month, n_recent)))
    return rows if category is None else rows.filter(F.col("category") == category)


# What a chunk says about itself besides its text.
METADATA = ("category", "year", "month", "month_name", "n_products", "total_sales", "avg_sales",
            "avg_price", "avg_margin", "source_file")


def context_by_month(context: DataFrame) -> DataFrame:
    """``month_key, documents, metadata``: two arrays in the order of the categories.

    One chunk per category and month, so an array has as many entries as categories.
    """
    chunks = F.sort_array(F.collect_list(F.struct(
        "category", "document", F.struct(*METADATA).alias("metadata"))))
    return context.groupBy("month_key").agg(chunks.alias("_c")).select(
        "month_key", F.transform("_c", lambda c: c["document"]).alias("documents"),
        F.transform("_c", lambda c: c["metadata"]).alias("metadata"))


def category_trend(summary: DataFrame) -> DataFrame:
    """Total sales against the month before and the same month last year.

    Works on one row per category and month, so both are cheap.
    """
    base = summary.select("month_key", "category", "total_sales",
                          month_index("month_key").alias("_i"))
    along = Window.partitionBy("category").orderBy("_i")
    previous = F.when(F.lag("_i").over(along) == F.col("_i") - 1,
                      F.lag("total_sales").over(along))
    last_year = base.select("category", (F.col("_i") + 12).alias("_i"),
                            F.col("total_sales").alias("sales_last_year"))
    return (base.withColumn("sales_previous", previous)
            .join(last_year, ["category", "_i"], "left")
            .withColumn("change_previous", F.col("total_sales") / F.col("sales_previous") - 1)
            .withColumn("change_last_year", F.col("total_sales") / F.col("sales_last_year") - 1)
            .drop("_i"))


def months_present(df: DataFrame, columns: Sequence[str] = ("month_key",)) -> DataFrame:
    return df.select(*columns).distinct()
