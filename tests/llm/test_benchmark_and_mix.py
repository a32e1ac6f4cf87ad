"""Decontamination, mixing and the pipeline against plain restatements."""

import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gondola.llm.decontaminate import decontaminate
from gondola.llm.mixing import mix_sources
from gondola.llm.simhash import simhash_components

from .rows import awkward_documents, clashing, documents, key, passage

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def items():
    a, b = passage(1), passage(2)
    return [(1, " ".join(a[:25])), (2, "One, TWO"), (3, " ".join(b[10:20]).upper()), (4, None),
            (5, " .. "), (10, " ".join(a[5:18])), (None, "w0 w1 w4"), (6, " ".join(passage(77, 12))),
            (7, " ".join(passage(1)[:4] + ["nowhere"] + passage(1)[4:12]))]


def plain_hits(rows, width=10):
    windows = {}
    for i, t in items():
        w = terms(t)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[k:k + width]), set()).add("" if i is None else str(i))
    out = []
    for d, t in rows:
        w = terms(t)
        hit, named = set(), set()
        for run, ids in windows.items():
            for k in range(len(w) - len(run) + 1):
                if tuple(w[k:k + len(run)]) == run:
                    hit.update(range(k, k + len(run)))
                    named |= ids
        out.append((d, len(w), len(hit), len(named),
                    hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("slop", [0, 1])
def test_decontaminate(spark, slop):
    rows = [r[:2] for r in awkward_documents()]
    bench = spark.createDataFrame(items(), "item_id bigint, text string")
    got = decontaminate(clashing(documents(spark)), clashing(bench), slop=slop).collect()
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted(plain_hits(rows), key=key)


def test_proximity_matches(spark):
    """A phrase with one word too many in it is near, not exact."""
    phrase = passage(8, 10)
    rows = [(1, " ".join(phrase)), (2, " ".join(phrase[:5] + ["x"] + phrase[5:])),
            (3, " ".join(phrase[:5] + ["x", "y", "z"] + phrase[5:])), (4, " ".join(phrase[:9]))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, " ".join(phrase))], "item_id bigint, text string")
    got = {r.doc_id: (r.n_hit, r.n_near > 0) for r in decontaminate(docs, bench, slop=1).collect()}
    assert got == {1: (10, False), 2: (0, True), 3: (0, False), 4: (0, False)}


def test_decontaminate_empty_tables(spark):
    bench = spark.createDataFrame(items(), "item_id bigint, text string")
    assert decontaminate(documents(spark, []), bench).collect() == []
    none = decontaminate(documents(spark), bench.limit(0)).collect()
    assert len(none) == len(awkward_documents()) and not any(r.contaminated for r in none)


def sources(spark):
    sizes = {"a": 300, "b": 60, "c": 20, None: 10, "empty": 3}
    rows, i = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            text = None if s == "empty" else " ".join(passage(i, 5 + i % 7))
            rows.append((i, text, "en", s, 0))
            i += 1
    return documents(spark, rows)


def entropy(weights):
    return -sum(w * math.log(w) for w in weights) / math.log(len(weights))


def test_mix_reaches_its_entropy(spark):
    docs = sources(spark)
    mix = mix_sources(clashing(docs), target_entropy=0.9, block_tokens=500).collect()
    weights = {r.source: r.weight for r in mix}
    assert set(weights) == {"a", "b", "c", None}
    assert entropy(weights.values()) == pytest.approx(0.9, abs=1e-4)
    tokens = {r.doc_id: len((r.text or "").split()) for r in docs.collect()}
    total = sum(tokens.values())
    for s, w in weights.items():
        got = sum(r.n_tokens for r in mix if r.source == s)
        assert w * total - 2 <= got <= w * total + 11  # one document over at most
        epochs = {}
        for r in mix:
            if r.source == s:
                epochs.setdefault(r.epoch, []).append(r.doc_id)
        for e in range(max(epochs)):  # all but the last are whole
            assert sorted(epochs[e]) == sorted(d.doc_id for d in docs.collect() if d.source == s)
        assert all(len(set(x)) == len(x) for x in epochs.values())
    assert all(0 <= r.position < 1 for r in mix)
    blocks = {}
    for r in mix:
        blocks.setdefault(r.mix_block, []).append(r)
    for b in blocks.values():
        share = sum(r.n_tokens for r in b if r.source == "a") / sum(r.n_tokens for r in b)
        assert share == pytest.approx(weights["a"], abs=0.1)


def test_mix_keeps_its_repetition_limit(spark):
    docs = sources(spark)
    mix = mix_sources(docs, max_repetition=1.8).collect()
    tokens = {}
    for r in docs.collect():
        tokens[r.source] = tokens.get(r.source, 0) + len((r.text or "").split())
    total = sum(tokens.values())
    most = max(r.weight * total / tokens[r.source] for r in mix)
    assert most == pytest.approx(1.8, abs=1e-4)
    with pytest.raises(ValueError):
        mix_sources(docs, max_repetition=0.5)
    with pytest.raises(ValueError):
        mix_sources(docs)
    plain = mix_sources(docs, target_entropy=0.1).collect()
    assert {r.exponent for r in plain} == {1.0} and len(plain) == 390


def test_mix_edges(spark):
    assert mix_sources(documents(spark, []), target_entropy=0.5).collect() == []
    got = mix_sources(documents(spark), max_repetition=2.0, block_tokens=100)
    assert got.filter("doc_id = 16").count() >= 1
    one = mix_sources(documents(spark).filter("source = 'src0'"), target_entropy=1.0).collect()
    assert {r.weight for r in one} == {1.0}


def test_small_blocks_give_the_same_mix(spark, monkeypatch):
    from gondola.llm import mixing

    docs = sources(spark)
    whole = sorted(map(tuple, mix_sources(docs, target_entropy=0.9).collect()), key=key)
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 3)
    monkeypatch.setattr(mixing, "FAN", 4)
    assert sorted(map(tuple, mix_sources(docs, target_entropy=0.9).collect()), key=key) == whole


def test_rows_without_an_id_are_drawn_one_by_one(spark):
    """Null and repeated ids are spread like others: a permutation, over many blocks."""
    rows = [(None, " ".join(["w"] * (1 + i % 40)) + f" {i}", "en", "a", 0) for i in range(3000)]
    rows += [(7, f"seven {i}", "en", "a", 0) for i in range(500)]
    rows += [(None, "the same text", "en", "a", 0)] * 1000 + [(None, None, "en", "a", 0)] * 3
    df = documents(spark, rows).repartition(5)
    mix = mix_sources(df, target_entropy=0.5).collect()
    assert len(mix) == 4503
    first = sorted(mix, key=lambda r: r.position)[:1000]
    assert 0.8 < sum(r.n_tokens for r in first) / 1000 / (sum(r.n_tokens for r in mix) / 4503) < 1.2
    assert 60 < sum(r.doc_id == 7 for r in first) < 170
    assert len({r.position for r in mix}) >= 4500
    again = mix_sources(documents(spark, rows[::-1]).repartition(3), target_entropy=0.5).collect()
    assert sorted(map(tuple, again), key=key) == sorted(map(tuple, mix), key=key)


def test_both_limits(spark):
    """The entropy is reached as far as the repetition limit lets it."""
    rows = [(i, "a b c d e", "en", "big", 0) for i in range(400)] + [(1000, "x", "en", "tiny", 0)]
    df = documents(spark, rows)
    free = mix_sources(df, target_entropy=0.9)
    assert free.filter("source = 'tiny'").count() > 500
    bound = mix_sources(df, target_entropy=0.9, max_repetition=3.0)
    assert bound.filter("source = 'tiny'").count() <= 3
    loose = mix_sources(df, target_entropy=0.9, max_repetition=10_000.0)
    assert {r.exponent for r in loose.collect()} == {r.exponent for r in free.collect()}


def test_epochs_come_in_lots(spark, monkeypatch):
    from gondola.llm import mixing

    rows = [(i, "a b c d e", "en", "big", 0) for i in range(40)] + [(1000, "x", "en", "tiny", 0)]
    df = documents(spark, rows)
    whole = sorted(map(tuple, mix_sources(df, target_entropy=0.99).collect()), key=key)
    monkeypatch.setattr(mixing, "EPOCHS", 7)
    assert sorted(map(tuple, mix_sources(df, target_entropy=0.99).collect()), key=key) == whole


# --- the pipeline

def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), sf_dir).columns == docs.columns


def test_pipeline_decisions(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    quality, lines, groups, benchmark, mix = (f for _, f in corpus_pipeline.STAGES)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = quality(spark, docs, sf_dir)
    kept = {r.doc_id for r in good.collect()}
    known = [(i in kept) == bool(q) for i, q in labels.items()]
    assert sum(known) / len(known) > 0.9
    left = lines(spark, good, sf_dir)
    assert left.count() == good.count()
    one = groups(spark, left, sf_dir)
    components = simhash_components(left).select("component_id").distinct()
    assert {r.doc_id for r in one.collect()} == {r.component_id for r in components.collect()}
    clean = benchmark(spark, one, sf_dir)
    bench = [terms(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    runs = {tuple(w[k:k + 10]) for w in bench for k in range(max(1, len(w) - 9))}

    def dirty(text):
        w = terms(text)
        return any(tuple(w[k:k + 10]) in runs for k in range(max(1, len(w) - 9)))

    assert {r.doc_id for r in clean.collect()} == {
        r.doc_id for r in one.collect() if not dirty(r.text)}
    drawn = mix(spark, clean, sf_dir)
    assert {r.doc_id for r in drawn.collect()} <= {r.doc_id for r in clean.collect()}
    assert drawn.agg(F.max("epoch")).first()[0] <= 1


def test_contaminated_rows_go_alone(spark, tmp_path):
    """A null or repeated id with one contaminated text keeps its clean ones."""
    spark.createDataFrame([(1, " ".join(passage(1, 12)))], "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    bad, clean, other = " ".join(passage(1, 12) + ["x"]), " ".join(passage(2)), " ".join(passage(3))
    rows = [(None, bad), (None, clean), (None, None), (4, bad), (4, clean), (4, clean), (5, other),
            (6, bad)]
    docs = documents(spark, [(i, t, "en", "s", 0) for i, t in rows])
    kept = corpus_pipeline.without_benchmark(spark, docs, str(tmp_path)).collect()
    assert sorted((r[:2] for r in kept), key=key) == sorted(
        [r for r in rows if r[1] != bad], key=key)


def test_pipeline_on_awkward_rows(spark, tmp_path, sf_dir):
    """Every stage takes nulls, blanks, repeats and more columns."""
    docs = documents(spark).withColumn("score", F.lit("x")).withColumn("_id", F.lit(1))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert out.count() <= docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() > 0
