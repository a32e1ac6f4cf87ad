"""Prompt text out, reply text in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import constants as K
from ..functions.numbers import clamp, half_up
from .ranking import row_numbers, top_n

# Best sellers of a category in a prompt, and lines of one prompt.
SAMPLE_PER_CATEGORY = 5
LINES_PER_PROMPT = 150


def prompt_sample(df: DataFrame, key: str = "product_id",
                  per_category: int = SAMPLE_PER_CATEGORY) -> DataFrame:
    """The product lines of a prompt: the best sellers of every category.

    ``line_no`` numbers them by category and sales, over all categories.
    """
    best = top_n(df, ["category"], [F.desc("estimated_monthly_sales"), key], per_category, "_rank")
    return row_numbers(best, [], ["category", "_rank"], "line_no").drop("_rank")


def product_line() -> Column:
    """``category | name | price | sales | margin`` of a product."""
    return F.concat(
        F.lit("  "), F.col("category"), F.lit(" | "), F.col("name"), F.lit(" | €"),
        F.format_string("%.2f", half_up("price_numeric", 2)), F.lit(" | Sales: "),
        F.col("estimated_monthly_sales").cast("bigint").cast("string"), F.lit(" | Margin: "),
        F.format_string("%.1f", half_up("profit_margin_percentage", 1)), F.lit("%"))


def _joined(text: Column, order: Sequence, by: str) -> Column:
    entries = F.sort_array(F.collect_list(F.struct(*order, text.alias("_t"))))
    return F.array_join(F.transform(entries, lambda e: e["_t"]), by)


def context_sections(context: DataFrame) -> DataFrame:
    """One text section per month of the retrieved context."""
    lines = _joined(F.concat(F.lit("- "), F.col("document")), ["category"], "\n")
    return context.groupBy("month_key").agg(lines.alias("_l")).select(
        "month_key", F.concat(F.lit("### Data from "), F.col("month_key"), F.lit("\n"),
                              F.col("_l")).alias("section"))


FORECAST_TASK = (
    "Give one sales multiplier per category for the target month as a JSON object "
    "{category: number}; 1.0 means no change.")
ESTIMATE_TASK = (
    "Give for each product, in order, a JSON array of objects with the keys "
    "estimated_monthly_sales, profit_margin_percentage and product_width_cm.")


def forecast_prompt(context: DataFrame, products: DataFrame, year: int, month: int,
                    task: str = FORECAST_TASK, lines: int = LINES_PER_PROMPT) -> DataFrame:
    """``part_no, prompt``: context per month, product lines and the task for the target month.

    The product lines are split over as many parts as they need at ``lines`` each; every
    part has the context and the task, so no category is left out.
    """
    sections = context_sections(context).agg(
        _joined(F.col("section"), ["month_key"], "\n").alias("context"))
    parts = prompt_sample(products).groupBy(
        (F.floor((F.col("line_no") - 1) / lines) + 1).alias("part_no")).agg(
        _joined(product_line(), ["line_no"], "\n").alias("products"))
    head = f"Target month: {K.MONTH_NAMES[month - 1].capitalize()} {year}"
    return parts.withColumn("context", sections.scalar()).select("part_no", F.concat_ws(
        "\n\n", F.concat(F.lit(f"{head}, part "), F.col("part_no").cast("string")),
        F.col("context"), F.col("products"), F.lit(task)).alias("prompt"))


def batch_prompts(batches: DataFrame, part: Sequence[str] = ("month_key",),
                  task: str = ESTIMATE_TASK) -> DataFrame:
    """One prompt per batch of ``batch_rows``: numbered product lines and the task."""
    line = F.concat(
        F.col("item_no").cast("string"), F.lit(". Category: "), F.col("category"),
        F.lit(" | Name: "), F.col("name"), F.lit(" | Subtitle: "), F.col("subtitle"),
        F.lit(" | Price: "), F.col("price"))
    return batches.groupBy(*part, "batch_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        _joined(F.coalesce(line, F.lit("")), ["item_no"], "\n").alias("_lines")).select(
            *part, "batch_id", "n_items",
            F.concat_ws("\n\n", "_lines", F.lit(task)).alias("prompt"))


def parse_estimates(replies: DataFrame, batches: DataFrame,
                    keys: Sequence[str] = ("month_key", "batch_id")) -> DataFrame:
    """Estimates for every row of ``batches`` from one reply text per batch.

    The JSON array is what lies between the first ``[`` and the last ``]``. Missing
    elements, missing keys and unreadable replies give the defaults, extra elements
    are ignored, and values are brought into range. One unreadable value makes the
    whole reply unreadable.
    """
    keys = list(keys)
    array = F.regexp_extract("reply_text", r"(?s)\[.*\]", 0)
    elements = F.from_json(array, "array<string>")
    parsed = replies.select(*keys, F.posexplode(elements).alias("_pos", "_text")).select(
        *keys, (F.col("_pos") + 1).alias("item_no"), "_text", F.lit(True).alias("_present"))
    rows = batches.join(parsed, [*keys, "item_no"], "left").withColumn(
        "_item", F.from_json("_text", "map<string,string>"))
    names = ("estimated_monthly_sales", "profit_margin_percentage", "product_width_cm")
    number = {c: F.try_element_at("_item", F.lit(c)).try_cast("double") for c in names}
    bad = F.col("_present") & F.coalesce(F.col("_item").isNull(), F.lit(True))
    for c in names:
        bad = bad | (F.map_contains_key("_item", c) & number[c].isNull())
    batch = Window.partitionBy(*keys)  # one batch: at most the batch size
    rows = rows.withColumn("_bad", F.max(F.coalesce(bad, F.lit(False))).over(batch))

    def value(c: str, default: float) -> Column:
        return F.when(F.col("_bad"), F.lit(default)).otherwise(
            F.coalesce(number[c], F.lit(default)))

    return rows.withColumns({
        names[0]: F.greatest(F.lit(1).cast("bigint"),
                             value(names[0], float(K.DEFAULT_SALES)).cast("bigint")),
        names[1]: clamp(value(names[1], K.DEFAULT_MARGIN), *K.MARGIN_RANGE),
        names[2]: clamp(value(names[2], K.DEFAULT_WIDTH), *K.WIDTH_RANGE),
    }).drop("_text", "_item", "_present", "_bad")


def parse_multipliers(replies: DataFrame, keys: Sequence[str] = ("month_key",)) -> DataFrame:
    """``(keys, category, multiplier)`` rows from reply texts; unreadable ones give none."""
    text = F.regexp_extract("reply_text", r"(?s)\{.*\}", 0)
    parsed = replies.select(*keys, F.from_json(text, "map<string,string>").alias("_m"))
    readable = F.forall(F.map_values("_m"), lambda v: v.try_cast("double").isNotNull())
    return parsed.filter(readable).select(*keys, F.explode("_m").alias("category", "_v")).select(
        *keys, "category",
        clamp(F.col("_v").cast("double"), K.MULTIPLIER_MIN, K.MULTIPLIER_MAX)
        .alias("multiplier"))
