"""Ranking, row numbers and lags that survive a hot group.

A plain window puts a whole group into one task. Where only the first rows of a
group are wanted, ``top_n`` keeps the limit literal so Spark prunes each map
task's output first. Where every row needs its number, ``row_numbers`` cuts the
rows into ranges of (group, order), numbers each range on its own and adds the
counts of the ranges before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import written


def top_n(df: DataFrame, part: Sequence[str], order: Sequence, n: int,
          name: str = "rank") -> DataFrame:
    """The first ``n`` rows per group, numbered from 1."""
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def ordered_blocks(df: DataFrame, part: Sequence[str], order: Sequence) -> DataFrame:
    """``df`` in ranges of (``part``, ``order``), numbered upwards by ``_block``.

    Spark samples the keys and cuts ranges of about equal size, whatever the keys look
    like and however large a group is. The rows are written below the shared folder, so
    all that is derived from them sees the same cuts.
    """
    ranged = df.repartitionByRange(*part, *order)
    return written(ranged.withColumn("_block", F.spark_partition_id()))


def block_offsets(blocked: DataFrame, part: Sequence[str]) -> DataFrame:
    """Rows of a group in a block, and before it: ``(*part, _block, _n, _offset)``.

    Only counts meet in the window, one per group and block.
    """
    part = list(part)
    before = Window.partitionBy(*part).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    return (blocked.groupBy(*part, "_block").agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))))


def numbered_blocks(blocked: DataFrame, offsets: DataFrame, part: Sequence[str],
                    order: Sequence, name: str = "row_no") -> DataFrame:
    """``row_number()`` over the groups of ``ordered_blocks``."""
    part = list(part)
    keys = [*part, "_block"]
    inside = Window.partitionBy(*keys).orderBy(*order)
    right = offsets.select(*[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)], "_offset")
    # A group may be NULL.
    same = [blocked[k].eqNullSafe(F.col(f"_o{i}")) for i, k in enumerate(keys)]
    joined = blocked.withColumn("_rn", F.row_number().over(inside)).join(
        right, same).withColumn(name, F.col("_offset") + F.col("_rn"))
    return joined.drop("_offset", "_rn", "_block", *[f"_o{i}" for i in range(len(keys))])


def row_numbers(df: DataFrame, part: Sequence[str], order: Sequence,
                name: str = "row_no") -> DataFrame:
    """``row_number() over (partition by part order by order)`` with no task for a group."""
    blocked = ordered_blocks(df, part, order)
    return numbered_blocks(blocked, block_offsets(blocked, part), part, order, name)


def previous_value(df: DataFrame, part: Sequence[str], order: Sequence[str],
                   value: str, name: str) -> DataFrame:
    """``lag(value)`` along ``order`` within ``part``, with no task for a group."""
    part = list(part)
    keys = [*part, "_block"]
    blocked = ordered_blocks(df, part, order)
    last = blocked.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias("_last"))
    carried = last.select(
        *[F.col(k).alias(f"_o{i}") for i, k in enumerate(keys)],
        F.lag("_last").over(Window.partitionBy(*part).orderBy("_block")).alias("_carried"))
    inside = Window.partitionBy(*keys).orderBy(*order)
    same = [F.col(k).eqNullSafe(F.col(f"_o{i}")) for i, k in enumerate(keys)]
    return (blocked.withColumns({"_rn": F.row_number().over(inside),
                                 "_lag": F.lag(value).over(inside)})
            .join(carried, same)
            .withColumn(name, F.when(F.col("_rn") == 1, F.col("_carried")).otherwise(F.col("_lag")))
            .drop("_rn", "_lag", "_carried", "_block", *[f"_o{i}" for i in range(len(keys))]))


def first_fraction(df: DataFrame, part: Sequence[str], score: Column, ties: Sequence[str],
                   wanted: DataFrame, buckets: int = 65_536) -> DataFrame:
    """Exactly the ``n_keep`` rows with the lowest ``score`` of every group.

    ``score`` is uniform in [0, 1); ``wanted`` holds ``(*part, n_keep)``. A
    count per score bucket finds the bucket where each group's quota ends, and
    ranking that one bucket finds the last row to keep. The rows themselves are
    then filtered where they are, against one cut per group. What has a row per group is
    written: Spark guesses that a join is as large as the product of its sides, takes the
    rows for the small side and would send all of them through the driver.
    """
    part = list(part)
    wanted = written(wanted)
    scored = df.withColumn("_at", F.struct(score.alias("_score"), *ties))
    bucketed = scored.select(*part, "_at", F.floor(F.col("_at._score") * buckets).alias("_bucket"))
    counts = bucketed.groupBy(*part, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*part).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    edge = written(counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
                   .join(wanted, part)
                   .filter(F.col("_before") < F.col("n_keep"))
                   .groupBy(*part).agg(F.max(F.struct(
                       "_bucket", (F.col("n_keep") - F.col("_before")).alias("_need"))).alias("_edge"))
                   .select(*part, F.col("_edge._bucket").alias("_bucket"), "_edge._need"))
    rank = F.row_number().over(Window.partitionBy(*part).orderBy("_at"))
    cuts = written(bucketed.join(edge, [*part, "_bucket"]).withColumn("_rn", rank)
                   .filter(F.col("_rn") <= F.col("_need"))
                   .groupBy(*part).agg(F.max("_at").alias("_cut")))
    return (scored.join(cuts, part).filter(F.col("_at") <= F.col("_cut"))
            .drop("_at", "_cut"))
