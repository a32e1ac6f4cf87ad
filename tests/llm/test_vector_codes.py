"""Vector codes against a plain restatement, and dual-tree rounds against full distances."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.errors import PythonException

from gondola.llm import codes
from gondola.llm.codes import encoded, fit_codebooks, nearest, tree_over, vector_codes

from .rows import key

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain_codes(rows, parts=8, k=16, rounds=6):
    """rows: (id, vector, label), all sound; (id, code, error, label_error, digest)."""
    ints = [[math.floor(4096 * x) for x in v] for _, v, _ in rows]
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1]))
    width = len(ints[0]) // parts if ints else 1
    cut = [[v[p * width:(p + 1) * width] for v in ints] for p in range(parts)]
    books = [[list(cut[p][i]) for i in first[:k]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), at)
                   for at, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for x in cut[p]:
                groups[near(p, x)[1]].append(x)
            for at, own in groups.items():
                books[p][at] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode())
    found = [[near(p, cut[p][i]) for p in range(parts)] for i in range(len(rows))]
    errors, by_label = [sum(d for d, _ in f) for f in found], defaultdict(int)
    for (_, _, label), error in zip(rows, errors, strict=True):
        by_label[label] += error
    return [(i, "".join(f"{at:02x}" for _, at in f), e, by_label[label], digest.hexdigest())
            for (i, _, label), f, e in zip(rows, found, errors, strict=True)]


def vectors(n, seed, dim=16):
    """Vectors of whole floats, a third of them equal, ids that repeat, null ids and labels."""
    rng = random.Random(seed)
    grid = [float(np.float32(rng.gauss(0, 0.2))) for _ in range(64)]
    same = [rng.choice(grid) for _ in range(dim)]
    rows = []
    for i in range(n):
        v = same if i % 3 == 0 else [rng.choice(grid) for _ in range(dim)]
        rows.append((None if i % 17 == 5 else i // 2, v, None if i % 5 == 0 else i % 4))
    return rows


def results(df):
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=key)


@pytest.mark.parametrize("n", [1, 16, 300])
def test_codes_equal_the_plain_rounds(spark, monkeypatch, n):
    monkeypatch.setattr(codes, "BLOCK_ROWS", 50)
    monkeypatch.setattr(codes, "LEAF_ROWS", 4)
    rows = vectors(n, n)
    got = results(vector_codes(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert got == sorted(plain_codes(rows), key=key)


def test_broken_rows_are_dropped_and_other_columns_may_clash(spark):
    sound = vectors(40, 1)
    broken = [(100, None, 1), (101, [], 1), (-5, [math.nan] + [0.0] * 15, 1),
              (-6, [math.inf] * 16, 1), (-7, [None] + [0.0] * 15, 2), (-8, [0.5] * 8, 3),
              (-9, [0.5] * 9, 3), (None, None, None)]
    df = spark.createDataFrame(sound + broken, SCHEMA)
    names = ["_id", "_v", "_label", "code", "error", "n", "VEC_ID", "_by", "part"]
    df = df.selectExpr(*[f"'x' AS {c}" for c in names], *df.columns)
    assert results(vector_codes(df)) == sorted(plain_codes(sound), key=key)


@pytest.mark.parametrize("rows", [[], [(1, None, 1), (2, [], None), (3, [1.0] * 7, 1)]])
def test_no_sound_rows(spark, rows):
    assert results(vector_codes(spark.createDataFrame(rows, SCHEMA))) == []


def test_components_go_down_also_below_zero(spark):
    rows = [(1, [-1 / 8192] * 8, 1), (2, [1 / 8192] * 8, 1)]
    _, books = fit_codebooks(spark.createDataFrame(rows, SCHEMA), rounds=0)
    assert books[:, :, 0].tolist() == [[-1, 0]] * 8


def test_components_that_may_overflow_are_refused(spark):
    rows = [(1, [3e38] * 8, 1)]
    with pytest.raises(PythonException, match="overflow"):
        fit_codebooks(spark.createDataFrame(rows, SCHEMA))


def test_more_entries_need_more_digits(spark):
    rows = [(i, [float(i)] * 2, 0) for i in range(300)]
    blocks, books = fit_codebooks(spark.createDataFrame(rows, SCHEMA), parts=2, entries=300,
                                  rounds=1)
    got = {r["_id"]: r["code"] for r in encoded(blocks, books).collect()}
    assert got == {i: f"{i:04x}" * 2 for i in range(300)}


@pytest.mark.parametrize(("n", "k", "width", "spread"), [
    (1, 1, 3, 9), (400, 16, 8, 2), (3000, 16, 8, 900), (3000, 16, 2, 900), (900, 64, 1, 5)])
def test_dual_trees_assign_like_full_distances(n, k, width, spread):
    rng = np.random.default_rng(n + k)
    points = np.floor(rng.normal(size=(n, width)) * spread).astype(np.int64)
    points[:n // 3] = points[0]
    book = points[rng.integers(0, n, k)]  # some entries are equal
    found = nearest(points, tree_over(points, 16), book)
    want = ((points[:, None] - book) ** 2).sum(2).argmin(1)
    assert (found.entry == want).all()
    assert (found.n == np.bincount(want, minlength=k)).all()
    total = np.zeros_like(book)
    np.add.at(total, want, points)
    assert (found.total == total).all()


def test_nodes_far_from_all_entries_but_one_go_whole():
    rng = np.random.default_rng(3)
    centres = np.array([[0, 0], [10_000, 0], [0, 10_000], [9000, 9000]])
    points = centres[rng.integers(0, 4, 4000)] + rng.integers(-50, 50, (4000, 2))
    found = nearest(points, tree_over(points, 16), centres)
    assert 0.9 * len(points) < found.whole <= len(points)
