"""Substring rules supplied as a table: the first rule whose pattern a text contains.

A rule table has a ``priority``, a ``pattern`` and any value columns, and may have group
columns such as the month that its rules hold for. A rule without a pattern is its group's
default: it applies where no other rule does. Patterns and texts are compared in lower case;
the lowest priority wins, of equal ones the lower pattern.

A text is compared with all patterns at once: its distinct pieces of the lengths that
patterns have meet the patterns in an equi join. So neither side is broadcast or compared
pair by pair, the table may have any number of rules, and the work is done once per distinct text.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..rules import Band


def _same(names: Sequence[str], left: str, right: str) -> Column:
    """Equal in all ``names``, NULL included."""
    return reduce(lambda a, b: a & b, (
        F.col(f"{left}{n}").eqNullSafe(F.col(f"{right}{n}")) for n in names), F.lit(True))


def _pieces(texts: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """``_low`` and every distinct ``_piece`` of it that has one of the lengths."""
    size = F.char_length("_low")

    def of(n: int) -> Column:
        cut = F.transform(F.sequence(F.lit(1), size - n + 1),
                          lambda at: F.substring("_low", at, F.lit(n)))
        return F.when(size >= n, cut).otherwise(F.array().cast("array<string>"))

    return texts.select("_low", F.explode(F.array_distinct(F.concat(*[of(n) for n in lengths])))
                        .alias("_piece"))


def first_rules(df: DataFrame, rules: DataFrame, text: str, by: Sequence[str] = (),
                pattern: str = "pattern", priority: str = "priority",
                missing: str | None = None) -> DataFrame:
    """``(*by, text, *values, priority)``: the rule of every distinct text and group in ``df``.

    A text that no rule matches, in a group without a default, has NULLs. A NULL text counts as
    ``missing`` where that is given, else the default applies to it.
    """
    by = list(by)
    values = [c for c in rules.columns if c not in (*by, pattern, priority)]
    rule = F.struct(F.col(priority).alias("priority"), F.lower(pattern).alias("pattern"),
                    *[F.col(c) for c in values]).alias("_rule")
    table = rules.select(*[F.col(c).alias(f"_r_{c}") for c in by], rule).withColumn(
        "_pattern", F.col("_rule.pattern"))
    plain = F.coalesce(F.col("_pattern"), F.lit("")) == ""
    wanted = df.select(*by, F.col(text).alias("_text")).distinct().withColumn(
        "_low", F.lower(F.col("_text") if missing is None else F.coalesce("_text", F.lit(missing))))
    lengths = sorted(r[0] for r in table.filter(~plain).select(
        F.char_length("_pattern")).distinct().collect())  # as many as the longest pattern has
    keys = [F.col(f"_r_{c}") for c in by]
    defaults = table.filter(plain).groupBy(*keys).agg(F.min("_rule").alias("_default"))
    if by:
        found = wanted.join(defaults, _same(by, "", "_r_"), "left").drop(*[f"_r_{c}" for c in by])
    else:
        found = wanted.withColumn("_default", defaults.select("_default").scalar())
    if lengths:
        pieces = _pieces(wanted.select("_low").distinct(), lengths)
        # Of rules that share pattern and group, only the first can apply.
        firsts = table.filter(~plain).groupBy(*keys, "_pattern").agg(F.min("_rule").alias("_rule"))
        best = (pieces.join(firsts, F.col("_piece") == F.col("_pattern"))
                .groupBy("_low", *keys).agg(F.min("_rule").alias("_best"))
                .withColumnRenamed("_low", "_of"))
        found = found.join(best, (F.col("_low") == F.col("_of")) & _same(by, "", "_r_"), "left")
        chosen = F.coalesce("_best", "_default")
    else:
        chosen = F.col("_default")
    found = found.withColumn("_rule", chosen)
    return found.select(*by, F.col("_text").alias(text),
                        *[F.col(f"_rule.{c}").alias(c) for c in (*values, "priority")])


def with_first_rule(df: DataFrame, rules: DataFrame, text: str, by: Sequence[str] = (),
                    **names) -> DataFrame:
    """``df`` with the values and the priority of every row's first rule."""
    by = list(by)
    found = first_rules(df, rules, text, by, **names)
    values = [c for c in found.columns if c not in (*by, text)]
    keyed = found.select(*[F.col(c).alias(f"_f_{c}") for c in (*by, text)],
                         *[F.col(c).alias(f"_v_{c}") for c in values])
    joined = df.join(keyed, _same([*by, text], "", "_f_"), "left")
    return joined.select(*df.columns, *[F.col(f"_v_{c}").alias(c) for c in values])


def seasonal_rules(spark: SparkSession, seasons: dict[int, dict[str, float]]) -> DataFrame:
    """The seasonal multipliers as a rule table by month; months without a default get 1.0."""
    rows = [(month, i, None if p == "default" else p, float(mult))
            for month, table in seasons.items()
            for i, (p, mult) in enumerate({**table, "default": table.get("default", 1.0)}.items())]
    return spark.createDataFrame(rows, "month int, priority int, pattern string, multiplier double")


def band_rules(spark: SparkSession, bands: Sequence[Band]) -> DataFrame:
    """Bands of margins and widths as a rule table; one without patterns is the default."""
    rows = [(i, p, *map(float, (*b.margin, *b.width)))
            for i, b in enumerate(bands) for p in (b.patterns or (None,))]
    return spark.createDataFrame(rows, "priority int, pattern string, m_lo double, m_hi double, "
                                       "w_lo double, w_hi double")
