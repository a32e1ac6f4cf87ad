"""Search in stored cells against the search over all vectors."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from gondola.operators import vector_cells as C, vectors as V

SCHEMA = "vec_id bigint, embedding array<float>"


def clustered(n, seed, dim=8, centres=12):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    x = middle[rng.integers(0, centres, n)] + 0.05 * rng.normal(size=(n, dim))
    x[: n // 5] = x[0]  # a common vector
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


def rows(df):
    return sorted((r.query_id, r.vec_id, r["rank"], round(r.similarity, 7)) for r in df.collect())


@pytest.mark.parametrize(("cells", "block"), [(7, 50), (40, 1000)])
def test_same_rows_as_over_all_vectors(spark, tmp_path, cells, block):
    data = clustered(600, 3) + [(9000, None), (9001, [0.0] * 8), (9002, [1.0, 2.0]), (9003, [3.0, 1.0])]
    vectors = spark.createDataFrame(data, SCHEMA)
    queries = spark.createDataFrame([r for r in data if r[0] % 20 == 0 or r[0] > 8999],
                                    "query_id bigint, embedding array<float>")
    C.store_cells(vectors, str(tmp_path / "v"), cells)
    got = C.cells_topk(queries, str(tmp_path / "v"), 4, query_block=9, vector_block=block)
    assert rows(got) == rows(V.cosine_topk(queries, vectors, 4))


def test_cells_out_of_reach_are_skipped(spark, tmp_path):
    data = clustered(2000, 5)
    C.store_cells(spark.createDataFrame(data, SCHEMA), str(tmp_path / "v"), 40)
    cells = C.read_cells(spark, str(tmp_path / "v"))
    number, c = cells[8]
    assert c.size.sum() == 2000
    queries = np.array([r[1] for r in data[::20]])
    unit = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    everything = np.array([r[1] for r in data])
    everything /= np.linalg.norm(everything, axis=1, keepdims=True)
    least = np.sort(unit @ everything.T, axis=1)[:, -3]
    batch = pa.RecordBatch.from_pydict({
        "id": pa.array(range(len(queries)), pa.int64()), "vec": pa.array(queries.tolist()),
        "n": pa.array([8] * len(queries), pa.int32()), "least": pa.array(least)})
    opened = sum(out.num_rows for again in (False, True)
                 for out in C._wanted(cells, 3, again)(iter([batch])))
    assert opened < 0.5 * len(queries) * len(number)


def test_nothing_stored_and_no_queries(spark, tmp_path):
    vectors = spark.createDataFrame(clustered(30, 1), SCHEMA)
    queries = vectors.withColumnRenamed("vec_id", "query_id")
    C.store_cells(vectors, str(tmp_path / "v"), 4)
    assert C.cells_topk(queries.limit(0), str(tmp_path / "v")).collect() == []
    C.store_cells(vectors.limit(0), str(tmp_path / "none"), 4)
    assert C.cells_topk(queries, str(tmp_path / "none")).collect() == []


def table(ids, x):
    return pa.table({"id": pa.array(ids, pa.int64()), "vec": pa.array(list(x), pa.list_(pa.float32()))})


def test_a_task_holds_few_similarities_of_large_blocks():
    """Ties and copies included, and a vector that holds an infinite number."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(6000, 4)).astype(np.float32)
    x[1000:1400] = x[3]
    x[17, 2] = np.inf
    q = np.concatenate([x[:1500], rng.normal(size=(1500, 4)).astype(np.float32)])
    tracemalloc.start()
    got = V._best_of_block(3)(table(range(len(q)), q), table(range(len(x)), x))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120e6  # all 18 million similarities are 144 MB
    unit = lambda m: m.astype(float) / np.linalg.norm(m.astype(float), axis=1, keepdims=True)
    sims = np.round(unit(q[:, :]) @ unit(np.delete(x, 17, axis=0)).T, V.PLACES)
    ids = np.delete(np.arange(len(x)), 17)
    want = [(i, ids[j], sims[i, j]) for i in range(len(q)) if i != 17
            for j in np.lexsort((ids, -sims[i]))[:3]]
    assert list(zip(*(got[c].to_pylist() for c in got.column_names))) == [tuple(r) for r in want]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_vectors_are_stored_as_they_are(spark, tmp_path, kind):
    vectors = spark.createDataFrame(clustered(50, 2), f"vec_id bigint, embedding array<{kind}>")
    C.store_cells(vectors, str(tmp_path / "v"), 4)
    assert spark.read.parquet(str(tmp_path / "v/vectors")).schema["vec"].dataType.simpleString() == f"array<{kind}>"
    queries = vectors.withColumnRenamed("vec_id", "query_id")
    for q in (queries, queries.withColumn("embedding", queries.embedding.cast("array<double>"))):
        assert rows(C.cells_topk(q, str(tmp_path / "v"), 3)) == rows(V.cosine_topk(q, vectors, 3))


def test_all_vectors_meet_in_few_blocks(spark, monkeypatch, sf_dir):
    """The search over all vectors copies none of them for blocks of a few hundred rows."""
    seen = []
    search = V.cosine_topk
    monkeypatch.setattr(V, "cosine_topk", lambda *a, **k: seen.append(k) or search(*a, **k))
    from gondola.plans.queries.models import QUERIES
    assert QUERIES["r2_all_vectors"](spark, sf_dir).count() > 0
    assert all(k.get("query_block", V.QUERY_BLOCK) >= 8_192 and k.get("vector_block", V.VECTOR_BLOCK) >= 8_192
               for k in seen)
