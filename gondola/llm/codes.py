"""Vectors as short codes: a codebook for every part, fitted by dual-tree Lloyd rounds.

A vector becomes integers and is cut into equal parts; every part has a codebook of its
own. Vectors are packed into blocks that are written once, each with a tree of boxes over
every part. In a round, a task walks the trees of its blocks against a tree over the
codebook's entries. Smallest and largest distances between two boxes are integers, so a pair
of nodes is dropped only where it can't hold a nearest entry; a node with one entry left
goes to it whole, with the sum that the tree keeps; what is left in uncertain leaves is
compared row by row. Tasks return sums by part, entry and position: the driver sees the
codebooks and nothing that grows with the rows.

Rows whose vector is null or holds null, NaN or an infinity are dropped, and so are vectors of
another length than the most frequent one (the longer of two as frequent) that the parts
divide. Entries start from the smallest ids, null ids last, repeated ids by vector;
fewer rows than entries make a smaller codebook. An empty table has no codes. Components
must be under ``LIMIT`` once scaled, in any direction: then no sum of squares overflows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from .common import pick, saved, small

#: Components become integers in steps of 1 / SCALE.
SCALE = 4096
#: Scaled components lie within it.
LIMIT = 1 << 29
#: Rows and components of a block at most, rows of a leaf at most.
BLOCK_ROWS, BLOCK_COMPONENTS, LEAF_ROWS = 8192, 1 << 22, 32

SUMS = "part int, entry int, position int, n bigint, total bigint"


class Tree(NamedTuple):
    """Boxes over rows, level by level; a node's children are ``left`` and ``left + 1``.

    Node ``i`` holds the rows ``order[start[i]:end[i]]``; leaves have ``left`` -1.
    """
    order: np.ndarray
    start: np.ndarray
    end: np.ndarray
    left: np.ndarray
    low: np.ndarray
    high: np.ndarray
    total: np.ndarray


def tree_over(points: np.ndarray, leaf: int) -> Tree:
    """Boxes halved at the median of their widest side, down to ``leaf`` rows or equal rows."""
    order = np.arange(len(points))
    spans, left, low, high, total = [(0, len(points))], [], [], [], []
    at = 0
    while at < len(spans):
        a, b = spans[at]
        rows = points[order[a:b]]
        low.append(rows.min(0))
        high.append(rows.max(0))
        total.append(rows.sum(0))
        wide = high[-1] - low[-1]
        if b - a <= leaf or not wide.any():
            left.append(-1)
        else:
            half = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(rows[:, wide.argmax()], half)]
            left.append(len(spans))
            spans += [(a, a + half), (a + half, b)]
        at += 1
    start, end = np.array(spans).T
    return Tree(order, start, end, np.array(left), np.array(low), np.array(high), np.array(total))


def _bounds(a: Tree, i: np.ndarray, b: Tree, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest squared distance between rows of nodes ``i`` and nodes ``j``."""
    apart = np.maximum(a.low[i] - b.high[j], b.low[j] - a.high[i]).clip(0)
    across = np.maximum(a.high[i] - b.low[j], b.high[j] - a.low[i])
    return (apart * apart).sum(1), (across * across).sum(1)


def _halved(tree: Tree, nodes: np.ndarray) -> np.ndarray:
    """The children of every node side by side, a leaf and -1 instead of two."""
    left = tree.left[nodes]
    return np.stack([np.where(left < 0, nodes, left), np.where(left < 0, -1, left + 1)], 1)


class Assigned(NamedTuple):
    entry: np.ndarray       # of every row
    n: np.ndarray           # rows of every entry
    total: np.ndarray       # their sum by position
    whole: int              # rows that were assigned with their node


def nearest(points: np.ndarray, tree: Tree, book: np.ndarray) -> Assigned:
    """The nearest entry of every row, the first of several, and the sums by entry.

    An entry equal to an earlier one never gets a row.
    """
    first = np.sort(np.unique(book, axis=0, return_index=True)[1])
    entries, k = book[first], len(first)
    keys = tree_over(entries, 1)
    ranked = np.empty(len(points), np.int64)  # by position in the tree's order
    n, total, whole = np.zeros(len(book), np.int64), np.zeros(book.shape, np.int64), 0
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(i):
        least, most = _bounds(tree, i, keys, j)
        begins = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
        group = np.cumsum(np.r_[False, i[1:] != i[:-1]])
        near = least <= np.minimum.reduceat(most, begins)[group]
        i, j, least = i[near], j[near], least[near]
        # Sure: one entry left, or a node of equal rows whose distances are exact.
        begins = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
        sizes = np.diff(np.r_[begins, len(i)])
        group = np.repeat(np.arange(len(begins)), sizes)
        node, single = i[begins], keys.left[j] < 0
        point = (tree.low[node] == tree.high[node]).all(1)
        sure = np.logical_and.reduceat(single, begins) & ((sizes == 1) | point)
        if sure.any():
            which = keys.order[keys.start[j]]
            best = np.lexsort((which, least, group))[begins]
            for at, entry in zip(node[sure].tolist(), which[best][sure].tolist(), strict=True):
                ranked[tree.start[at]:tree.end[at]] = entry
                n[first[entry]] += tree.end[at] - tree.start[at]
                total[first[entry]] += tree.total[at]
                whole += int(tree.end[at] - tree.start[at])
        open_ = ~sure[group]
        i, j, single = i[open_], j[open_], single[open_]
        # A leaf whose entries are all single can't be split: its rows are compared.
        done = (tree.left[i] < 0) & single
        if len(i):
            begins = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
            sizes = np.diff(np.r_[begins, len(i)])
            done = np.repeat(np.logical_and.reduceat(done, begins), sizes)
        if done.any():
            rows = _compared(points, tree, i[done], keys.order[keys.start[j[done]]], entries,
                             ranked)
            for entry in range(k):
                own = rows[ranked[rows] == entry]
                n[first[entry]] += len(own)
                total[first[entry]] += points[tree.order[own]].sum(0)
        i, j = i[~done], j[~done]
        a, b = _halved(tree, i), _halved(keys, j)
        i, j = np.repeat(a, 2, 1).ravel(), np.tile(b, 2).ravel()
        both = (i >= 0) & (j >= 0)
        i, j = i[both], j[both]
        by_node = np.lexsort((j, i))
        i, j = i[by_node], j[by_node]
    entry = np.empty(len(points), np.int64)
    entry[tree.order] = first[ranked]
    return Assigned(entry, n, total, whole)


def _compared(points: np.ndarray, tree: Tree, leaves: np.ndarray, which: np.ndarray,
              entries: np.ndarray, ranked: np.ndarray) -> np.ndarray:
    """Rows of uncertain leaves against the entries left to their leaf; their positions."""
    best = np.full(len(points), np.iinfo(np.int64).max)
    seen = np.zeros(len(points), bool)
    for entry in np.unique(which).tolist():  # upwards: the first of equally near ones stays
        own = leaves[which == entry]
        sizes = tree.end[own] - tree.start[own]
        at = np.arange(sizes.sum()) + np.repeat(tree.start[own] - np.cumsum(sizes) + sizes, sizes)
        apart = points[tree.order[at]] - entries[entry]
        distance = (apart * apart).sum(1)
        nearer = distance < best[at]
        best[at[nearer]] = distance[nearer]
        ranked[at[nearer]] = entry
        seen[at] = True
    return np.flatnonzero(seen)


def _integers(values: np.ndarray, dim: int, scale: int) -> np.ndarray:
    scaled = np.floor(values.reshape(-1, dim).astype(np.float64) * scale)
    if len(scaled) and np.abs(scaled).max() > LIMIT:
        raise ValueError(f"a component is over {LIMIT / scale:g}: squared distances may overflow")
    return scaled.astype(np.int64)


def _part_columns(dim: int, parts: int) -> list[slice]:
    width = dim // parts
    return [slice(p * width, (p + 1) * width) for p in range(parts)]


def _block(batches: list[pa.RecordBatch], dim: int, parts: int, scale: int) -> dict:
    """One row: ids, labels, all integers, and the trees of all parts one after the other."""
    rows = pa.Table.from_batches(batches).combine_chunks()
    matrix = _integers(rows["_v"].combine_chunks().flatten().to_numpy(zero_copy_only=False), dim,
                       scale)
    trees = [tree_over(matrix[:, cols], LEAF_ROWS) for cols in _part_columns(dim, parts)]
    lists = {f"{c}s": pa.ListArray.from_arrays(
        pa.array([0, len(matrix)], pa.int32()), rows[c].combine_chunks())
        for c in ("_id", "_label")}
    packed = {name: np.concatenate([getattr(t, name).ravel() for t in trees])
              for name in Tree._fields}
    kinds = {name: np.int64 if name == "total" else np.int32 for name in Tree._fields}
    return lists | {
        "n": pa.array([len(matrix)], pa.int32()),
        "matrix": pa.array([matrix.astype(np.int32).tobytes()], pa.binary()),
        "nodes": pa.array([[len(t.start) for t in trees]], pa.list_(pa.int32())),
        **{name: pa.array([values.astype(kinds[name]).tobytes()], pa.binary())
           for name, values in packed.items()}}


def _blocks(rows: DataFrame, dim: int, parts: int, scale: int) -> DataFrame:
    """All rows in written blocks, as they lie in the table's partitions."""
    limit = max(1, min(BLOCK_ROWS, BLOCK_COMPONENTS // dim))
    kinds = {f.name: f.dataType for f in rows.schema}
    schema = T.StructType([
        T.StructField("_ids", T.ArrayType(kinds["_id"])),
        T.StructField("_labels", T.ArrayType(kinds["_label"])), T.StructField("n", T.IntegerType()),
        T.StructField("matrix", T.BinaryType()),
        T.StructField("nodes", T.ArrayType(T.IntegerType())),
        *[T.StructField(name, T.BinaryType()) for name in Tree._fields]])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, limit - n)
                batch = batch.slice(taken.num_rows)
                held.append(taken)
                n += taken.num_rows
                if n == limit:
                    yield pa.RecordBatch.from_pydict(_block(held, dim, parts, scale))
                    held, n = [], 0
        if n:
            yield pa.RecordBatch.from_pydict(_block(held, dim, parts, scale))

    return saved(rows.mapInArrow(pack, schema))


def _unpacked(batch: pa.RecordBatch, dim: int, parts: int) -> Iterator[
        tuple[int, np.ndarray, list[Tree]]]:
    """Position, integers and trees of every block of a batch."""
    width = dim // parts
    for at, row in enumerate(batch.select(["n", "matrix", "nodes", *Tree._fields]).to_pylist()):
        flat = {name: np.frombuffer(row[name], np.int64 if name == "total" else np.int32)
                .astype(np.int64) for name in Tree._fields}
        node, trees = 0, []
        for part, count in enumerate(row["nodes"]):
            one = slice(node, node + count)
            boxes = {name: flat[name][node * width:(node + count) * width].reshape(count, width)
                     for name in ("low", "high", "total")}
            trees.append(Tree(flat["order"][part * row["n"]:(part + 1) * row["n"]],
                              flat["start"][one], flat["end"][one], flat["left"][one], **boxes))
            node += count
        matrix = np.frombuffer(row["matrix"], np.int32).reshape(row["n"], dim).astype(np.int64)
        yield at, matrix, trees


def _round(blocks: DataFrame, books: np.ndarray, dim: int) -> np.ndarray:
    """The codebooks after one more assignment: floored means, unused entries as they were."""
    parts, k, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), np.int64)
        for batch in batches:
            for _, matrix, trees in _unpacked(batch, dim, parts):
                for p, cols in enumerate(_part_columns(dim, parts)):
                    found = nearest(matrix[:, cols], trees[p], books[p])
                    n[p] += found.n
                    total[p] += found.total
        p, e, at = (x.ravel() for x in np.indices(total.shape))
        used = np.repeat(n.ravel() > 0, width)
        yield pa.RecordBatch.from_pydict({
            name: pa.array(x[used], kind) for name, x, kind in (
                ("part", p, pa.int32()), ("entry", e, pa.int32()), ("position", at, pa.int32()),
                ("n", np.repeat(n.ravel(), width), pa.int64()),
                ("total", total.ravel(), pa.int64()))})

    new = books.copy()
    for row in (blocks.mapInArrow(sums, SUMS).groupBy("part", "entry", "position")
                .agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()):
        new[row.part, row.entry, row.position] = row.total // row.n
    return new


def _kept(df: DataFrame, vec_id: str, vector: str, label: str, parts: int) -> tuple[DataFrame, int]:
    """Sound rows of the one length that counts, and that length (0: no rows)."""
    finite = F.forall("_v", lambda x: x.isNotNull() & (x > float("-inf")) & (x < float("inf")))
    rows = pick(df, _id=vec_id, _v=vector, _label=label).withColumn(
        "_v", F.col("_v").cast("array<double>")).filter(F.col("_v").isNotNull() & finite)
    size = F.size("_v")
    often = (rows.filter((size > 0) & (size % parts == 0)).groupBy(size.alias("dim")).count()
             .orderBy(F.desc("count"), F.desc("dim")).first())
    dim = often.dim if often else 0
    return rows.filter((size == dim) & (size > 0)), dim


def fit_codebooks(df: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6,
                  vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                  scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """Written blocks of all sound rows, and the codebooks (part, entry, position)."""
    rows, dim = _kept(df, vec_id, vector, label, parts)
    if not dim:
        return _blocks(rows, parts, parts, scale), np.zeros((parts, 0, 1), np.int64)
    blocks = _blocks(rows, dim, parts, scale)
    lowest = rows.orderBy(F.col("_id").asc_nulls_last(), "_v").limit(entries).collect()
    first = _integers(np.array([r["_v"] for r in lowest], dtype=np.float64), dim, scale)
    books = first.reshape(len(lowest), parts, dim // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        books = _round(blocks, books, dim)
    return blocks, books


def encoded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """``_id, _label, code, error`` of every row in the blocks."""
    parts, k, width = books.shape
    dim = parts * width
    kinds = {f.name: f.dataType.elementType for f in blocks.schema if f.name in ("_ids", "_labels")}
    schema = T.StructType([
        T.StructField("_id", kinds["_ids"]), T.StructField("_label", kinds["_labels"]),
        T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, matrix, trees in _unpacked(batch, dim, parts):
                error = np.zeros(len(matrix), np.int64)
                code = np.zeros((len(matrix), parts), np.uint8 if k <= 256 else np.uint16)
                for p, cols in enumerate(_part_columns(dim, parts)):
                    code[:, p] = nearest(matrix[:, cols], trees[p], books[p]).entry
                    apart = matrix[:, cols] - books[p][code[:, p]]
                    error += (apart * apart).sum(1)
                digits = code.astype(code.dtype.newbyteorder(">")).tobytes().hex()
                wide = len(digits) // len(matrix)
                yield pa.RecordBatch.from_pydict({
                    "_id": batch.column("_ids")[at].values,
                    "_label": batch.column("_labels")[at].values,
                    "code": pa.array([digits[i:i + wide] for i in range(0, len(digits), wide)]),
                    "error": pa.array(error)})

    return blocks.mapInArrow(encode, schema)


def codebooks_digest(books: np.ndarray) -> str:
    """SHA-256 of all integers in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(df: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6,
                 vec_id: str = "vec_id", vector: str = "embedding",
                 label: str = "label") -> DataFrame:
    """Code and squared error of every sound vector, and the error summed over equal labels.

    ``vec_id, code, error, label_error, codebooks_sha256``; null labels are equal.
    """
    blocks, books = fit_codebooks(df, parts, entries, rounds, vec_id, vector, label)
    rows = saved(encoded(blocks, books))
    sums = rows.groupBy(F.col("_label").alias("_by")).agg(F.sum("error").alias("label_error"))
    return rows.join(small(sums), F.col("_label").eqNullSafe(F.col("_by")), "left").select(
        F.col("_id").alias("vec_id"), "code", "error", "label_error",
        F.lit(codebooks_digest(books)).alias("codebooks_sha256"))


def oracle(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """All rounds written out as SQL over ``embeddings``."""
    def assigned(r: int) -> str:
        return f"""near{r} AS (
  SELECT vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT p.vec_id, p.part, b.entry, SUM((p.v - b.v) * (p.v - b.v))::BIGINT AS d
    FROM points p JOIN book{r} b ON b.part = p.part AND b.pos = p.pos GROUP BY ALL)
  GROUP BY vec_id, part)"""

    def updated(r: int) -> str:
        return f"""book{r + 1} AS (
  SELECT b.part, b.entry, b.pos, COALESCE(m.v, b.v) AS v FROM book{r} b LEFT JOIN (
    SELECT n.part, n.entry, p.pos,
           ((SUM(p.v) - ((SUM(p.v) % COUNT(*)) + COUNT(*)) % COUNT(*)) // COUNT(*))::BIGINT AS v
    FROM near{r} n JOIN points p ON p.vec_id = n.vec_id AND p.part = n.part GROUP BY ALL) m
  ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos)"""

    steps = ",\n".join(f"{assigned(r)},\n{updated(r)}" for r in range(rounds))
    return f"""
WITH kept AS (
  SELECT vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
points AS (
  SELECT vec_id, (i // w)::INT AS part, (i % w)::INT AS pos,
         floor(4096 * embedding[i + 1]::DOUBLE)::BIGINT AS v
  FROM (SELECT vec_id, embedding, len(embedding) // {parts} AS w,
               unnest(range(len(embedding))) AS i FROM kept)),
book0 AS (
  SELECT p.part, s.entry, p.pos, p.v FROM points p JOIN (
    SELECT vec_id, (row_number() OVER (ORDER BY vec_id) - 1)::INT AS entry FROM kept) s
  ON s.vec_id = p.vec_id WHERE s.entry < {entries}),
{steps},
{assigned(rounds)},
coded AS (
  SELECT vec_id, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code,
         SUM(d)::BIGINT AS error FROM near{rounds} GROUP BY vec_id),
digest AS (
  SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256
  FROM book{rounds})
SELECT c.vec_id, c.code, c.error, s.label_error, g.codebooks_sha256
FROM coded c JOIN kept k ON k.vec_id = c.vec_id
JOIN (SELECT k.label, SUM(c.error)::BIGINT AS label_error
      FROM coded c JOIN kept k ON k.vec_id = c.vec_id GROUP BY k.label) s
  ON s.label IS NOT DISTINCT FROM k.label
CROSS JOIN digest g
"""
