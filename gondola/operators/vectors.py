"""Exact cosine top-k over a stored vector column."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .ranking import top_n

# Average rows of a block of queries and of vectors; a task holds one of each. Every row is sent
# to all blocks of the other side, so few large blocks move less.
QUERY_BLOCK, VECTOR_BLOCK = 8_192, 32_768
# Similarities of a task at a time, and vectors of which the best one bounds the rest.
HELD, GROUP = 1 << 22, 64
# Similarities that agree to so many places are ties; summation noise is below it.
PLACES = 9


def centroids(vectors: DataFrame, by: str = "label", vector: str = "embedding") -> DataFrame:
    """Mean vector per group, one partial sum per group and dimension."""
    entries = vectors.select(by, F.posexplode(vector).alias("_i", "_x"))
    means = entries.groupBy(by, "_i").agg(F.avg(F.col("_x").cast("double")).alias("_x"))
    return means.groupBy(by).agg(F.transform(
        F.sort_array(F.collect_list(F.struct("_i", "_x"))), lambda e: e["_x"]).alias(vector))


def _usable(vector: str):
    return (F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))
            & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x)))


def vector_problems(vectors: DataFrame, vec_id: str = "vec_id",
                    vector: str = "embedding") -> DataFrame:
    """``vec_id, problem`` of the rows that ``cosine_topk`` can't compare with the others.

    A missing vector or entry, all zeros, or another length than most vectors have.
    """
    length = F.coalesce(F.size(vector), F.lit(-1))
    most = vectors.groupBy(length.alias("_n")).agg(F.count(F.lit(1)).alias("_rows")).agg(
        F.max_by("_n", F.struct("_rows", "_n"))).scalar()
    problem = (F.when(F.col(vector).isNull(), "missing")
               .when(F.exists(vector, lambda x: x.isNull() | F.isnan(x)), "missing entry")
               .when(length != most, F.concat(F.lit("length "), length.cast("string")))
               .when(~F.exists(vector, lambda x: x != 0), "all zero"))
    return vectors.select(vec_id, problem.alias("problem")).filter(F.col("problem").isNotNull())


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Unit rows of a column of lists."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    m = whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _best(q: np.ndarray, m: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """Row, id and similarity of the ``k`` best of ``m`` for every row of ``q``.

    The k-th of the groups' best is no larger than the k-th of all, so what is below it is
    neither rounded nor sorted.
    """
    sims = q @ m.T
    take, groups = min(k, len(m)), len(m) // GROUP
    best = sims if groups < take else sims[:, :groups * GROUP].reshape(
        len(q), groups, GROUP).max(axis=2)
    edge = np.partition(best, best.shape[1] - take, axis=1)[:, best.shape[1] - take]
    row, col = np.nonzero(sims >= edge[:, None] - 2 * 10.0 ** -PLACES)
    sims, found = np.round(sims[row, col], PLACES), ids[col]
    order = np.lexsort((found, -sims, row))
    row, found, sims = row[order], found[order], sims[order]
    first = np.arange(len(row)) - np.searchsorted(row, row, side="left") < k
    return row[first], found[first], sims[first]


def _best_of_block(k: int):
    """Arrow function: the k best vectors of a block per query of another block.

    A task holds ``HELD`` similarities at a time, however large the blocks are.
    """
    def best(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        parts = []
        if queries.num_rows and vectors.num_rows:
            dim = len(queries["vec"][0])
            q, m = _matrix(queries["vec"], dim), _matrix(vectors["vec"], dim)
            q_ids, ids = queries["id"].to_numpy(), vectors["id"].to_numpy()
            # What holds an infinite number is like nothing.
            q_good, good = np.isfinite(q).all(axis=1), np.isfinite(m).all(axis=1)
            q, q_ids, m, ids = q[q_good], q_ids[q_good], m[good], ids[good]
            rows = max(1, HELD // max(1, len(m)))
            for at in range(0, len(q) if len(m) else 0, rows):
                row, found, sims = _best(q[at:at + rows], m, ids, k)
                parts.append((q_ids[at + row], found, sims))
        query, found, sims = map(np.concatenate, zip(*parts)) if parts else ([], [], [])
        return pa.table({"query_id": pa.array(query, pa.int64()), "vec_id": pa.array(found, pa.int64()),
                         "similarity": pa.array(sims, pa.float64())})

    return best


def cosine_topk(queries: DataFrame, vectors: DataFrame, k: int = 5,
                query_id: str = "query_id", vec_id: str = "vec_id",
                vector: str = "embedding", query_block: int = QUERY_BLOCK,
                vector_block: int = VECTOR_BLOCK) -> DataFrame:
    """The ``k`` most similar vectors per query, best first; ids break ties.

    Queries and vectors are cut into blocks by hash and by length, and every block of
    queries meets every block of vectors of its length in a task of its own, which keeps
    ``k`` rows per query. No task holds more than two blocks, nothing passes through the
    driver. Vectors are compared with queries of their own length; see
    ``vector_problems`` for those that differ. Without queries or vectors the result is
    empty.
    """
    q = queries.select(F.col(query_id).cast("bigint").alias("id"), F.col(vector).alias("vec"))
    v = vectors.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).alias("vec"))
    q, v = (df.filter(_usable("vec")).withColumn("n", F.size("vec")) for df in (q, v))
    q_blocks = max(1, math.ceil(q.agg(F.count(F.lit(1))).first()[0] / query_block))
    v_blocks = max(1, math.ceil(v.agg(F.count(F.lit(1))).first()[0] / vector_block))

    def block(of: int):
        return F.pmod(F.xxhash64("id"), F.lit(of)).cast("int")

    def every(of: int):
        return F.explode(F.sequence(F.lit(0), F.lit(of - 1)))

    left = q.withColumn("qb", block(q_blocks)).withColumn("vb", every(v_blocks))
    right = v.withColumn("vb", block(v_blocks)).withColumn("qb", every(q_blocks))
    keys = ["n", "qb", "vb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _best_of_block(k), "query_id bigint, vec_id bigint, similarity double")
    return top_n(found, ["query_id"], [F.desc("similarity"), "vec_id"], k)
