"""Vectors stored in cells, searched exactly without looking into every cell.

A cell has a centre and a radius, the largest angle between the centre and one of its vectors. No
vector of a cell is nearer to a query than the angle to the centre less the radius. A query first
looks into the cells around it that hold ``k`` vectors; what it finds there bounds the rest,
and only cells that may hold something as near are looked into after that. The result is that of
``cosine_topk``; how many cells are skipped depends on how far the vectors cluster.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import written
from .ranking import top_n
from .vectors import QUERY_BLOCK, VECTOR_BLOCK, _best_of_block, _matrix, _usable

#: Cells of a stored table at most; centres are sampled, all vectors are stored.
CELLS = 256
STORED = "id bigint, vec {}, angle double, n int, cell int"
#: Angles are kept apart by more than their rounding.
SLACK = 1e-6


class Cells(NamedTuple):
    """Centres as unit rows, radii and sizes of the cells of one vector length."""
    centre: np.ndarray
    radius: np.ndarray
    size: np.ndarray


def _unit(rows: list) -> np.ndarray:
    m = np.array(rows, dtype=np.float64)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _numbers(df: DataFrame, vector: str) -> Column:
    """The vectors as floats where they are, which half the bytes hold, or as doubles."""
    floats = df.schema[vector].dataType == T.ArrayType(T.FloatType(), True)
    return F.col(vector).cast("array<float>" if floats else "array<double>")


def _kind(spark: SparkSession, path: str) -> str:
    """Type of the stored vectors: that of the centres."""
    return spark.read.parquet(f"{path}/cells").schema["centre"].dataType.simpleString()


def _angles(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ centres.T, -1.0, 1.0))


def store_cells(vectors: DataFrame, path: str, cells: int = CELLS, vec_id: str = "vec_id",
                vector: str = "embedding") -> None:
    """Write all usable vectors below ``path``, each in the cell of its nearest centre.

    Centres are the ``cells`` vectors of a length whose ids hash lowest.
    """
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("id"),
                          _numbers(vectors, vector).alias("vec")).filter(
        _usable("vec")).withColumn("n", F.size("vec"))
    kind = rows.schema["vec"].dataType.simpleString()
    sampled = top_n(rows, ["n"], [F.xxhash64("id"), F.col("id")], cells)
    centres: dict[int, list] = {}
    for r in sampled.orderBy("n", "rank").collect():  # at most ``cells`` a length
        centres.setdefault(r["n"], []).append(r["vec"])
    unit = {n: _unit(c) for n, c in centres.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("n").to_numpy(zero_copy_only=False)
            for n in np.unique(lengths).tolist():
                own = batch.filter(pa.array(lengths == n))
                angle = _angles(_matrix(own.column("vec"), n), unit[n])
                cell = angle.argmin(axis=1)
                yield pa.RecordBatch.from_pydict({
                    **{c: own.column(c) for c in ("id", "vec", "n")},
                    "cell": pa.array(cell.astype(np.int32)),
                    "angle": pa.array(angle[np.arange(len(cell)), cell])})

    stored = rows.mapInArrow(assign, f"id bigint, vec {kind}, n int, cell int, angle double")
    (stored.hint("rebalance", "n", "cell").write.mode("overwrite").partitionBy("n", "cell")
     .parquet(f"{path}/vectors"))
    spark = vectors.sparkSession
    found = (spark.read.schema(STORED.format(kind)).parquet(f"{path}/vectors").groupBy("n", "cell")
             .agg(F.max("angle").alias("radius"), F.count(F.lit(1)).alias("size")))
    middle = spark.createDataFrame(
        [(n, i, list(map(float, c))) for n, own in centres.items() for i, c in enumerate(own)],
        f"n int, cell int, centre {kind}")
    found.join(middle, ["n", "cell"]).write.mode("overwrite").parquet(f"{path}/cells")


def read_cells(spark: SparkSession, path: str) -> dict[int, tuple[np.ndarray, Cells]]:
    """Cell numbers and cells by vector length."""
    by_length: dict[int, list] = {}
    for r in spark.read.parquet(f"{path}/cells").orderBy("n", "cell").collect():
        by_length.setdefault(r["n"], []).append(r)
    return {n: (np.array([r["cell"] for r in own]), Cells(
        _unit([r["centre"] for r in own]), np.array([r["radius"] for r in own]),
        np.array([r["size"] for r in own]))) for n, own in by_length.items()}


def _wanted(cells: dict, k: int, again: bool):
    """Arrow function: queries with the cells to look into, at first or ``again``, bound by the
    ``least`` similarity that they have found."""
    def near(angle: np.ndarray, c: Cells) -> np.ndarray:
        order = np.argsort(angle, axis=1, kind="stable")
        held = np.cumsum(c.size[order], axis=1)
        first = held - c.size[order] < k  # until the cells before hold k
        out = np.zeros_like(first)
        np.put_along_axis(out, order, first, axis=1)
        return out

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("n").to_numpy(zero_copy_only=False)
            for n in np.unique(lengths).tolist():
                if n not in cells:
                    continue
                own = batch.filter(pa.array(lengths == n))
                number, c = cells[n]
                angle = _angles(_matrix(own.column("vec"), n), c.centre)
                take = near(angle, c)
                if again:
                    least = own.column("least").to_numpy(zero_copy_only=False)[:, None]
                    reach = np.cos(np.clip(angle - c.radius - SLACK, 0.0, math.pi))
                    take = ~take & (reach >= least - SLACK)
                row, at = np.nonzero(take)
                yield pa.RecordBatch.from_pydict({
                    **{x: own.column(x).take(pa.array(row)) for x in ("id", "vec", "n")},
                    "cell": pa.array(number[at].astype(np.int32))})

    return wanted


def _looked_into(wanted: DataFrame, stored: DataFrame, sizes: DataFrame, k: int,
                 query_blocks: int, vector_block: int) -> DataFrame:
    """The k best of every wanted pair of query and cell, by blocks of both."""
    parts = F.ceil(F.col("size") / vector_block).cast("int")
    blocks = sizes.select("n", "cell", parts.alias("parts"))
    left = (wanted.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int"))
            .join(blocks, ["n", "cell"])
            .withColumn("vb", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts"))
    keys = ["n", "cell", "vb", "qb"]
    needed = left.select(*[F.col(c).alias(f"_{c}") for c in keys]).distinct()
    block = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    right = (stored.join(blocks, ["n", "cell"]).withColumn("vb", block)
             .join(needed, (F.col("n") == F.col("_n")) & (F.col("cell") == F.col("_cell"))
                   & (F.col("vb") == F.col("_vb")))
             .select("id", "vec", "n", "cell", "vb", F.col("_qb").alias("qb")))
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _best_of_block(k), "query_id bigint, vec_id bigint, similarity double")
    return top_n(found, ["query_id"], [F.desc("similarity"), "vec_id"], k)


def cells_topk(queries: DataFrame, path: str, k: int = 5, query_id: str = "query_id",
               vector: str = "embedding", query_block: int = QUERY_BLOCK,
               vector_block: int = VECTOR_BLOCK) -> DataFrame:
    """``cosine_topk`` over the vectors of ``store_cells``: same rows, fewer cells opened."""
    spark = queries.sparkSession
    q = written(queries.select(F.col(query_id).cast("bigint").alias("id"),
                               _numbers(queries, vector).alias("vec"))
                .filter(_usable("vec")).withColumn("n", F.size("vec")))
    cells = read_cells(spark, path)
    pairs = f"id bigint, vec {q.schema['vec'].dataType.simpleString()}, n int, cell int"
    blocks = max(1, math.ceil(q.count() / query_block))
    stored = spark.read.schema(STORED.format(_kind(spark, path))).parquet(f"{path}/vectors").select("id", "vec", "n", "cell")
    sizes = spark.read.parquet(f"{path}/cells").select("n", "cell", "size")
    args = stored, sizes, k, blocks, vector_block
    first = written(_looked_into(q.mapInArrow(_wanted(cells, k, False), pairs), *args))
    # With fewer than k so far there is no bound.
    least = first.groupBy(F.col("query_id").alias("id")).agg(
        F.when(F.count(F.lit(1)) >= k, F.min("similarity")).alias("least"))
    bound = q.join(least, "id", "left").fillna(-2.0, ["least"])
    rest = _looked_into(bound.mapInArrow(_wanted(cells, k, True), pairs), *args)
    both = first.drop("rank").unionByName(rest.drop("rank"))
    return top_n(both, ["query_id"], [F.desc("similarity"), "vec_id"], k)
