"""Fingerprints against a plain restatement, estimates against whole shingle sets."""

import hashlib
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from gondola.llm import fingerprints as module
from gondola.llm.fingerprints import (containment, distinct_shingles, fingerprints, merged,
                                      resemblance, sketch)

from .rows import awkward_documents, clashing, documents, key, passage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
K = 128


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def plain_shingles(text, size=5):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    hashes = [signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in words]
    out = set()
    for i in range(max(1, len(hashes) - size + 1) if hashes else 0):
        h = 42
        for w in hashes[i:i + size]:
            h = xxhash.xxh64_intdigest(struct.pack("<q", w), h)
        out.add(signed(h))
    return out


def plain_sketch(text, k=K):
    return sorted(plain_shingles(text))[:k]


def plain_near(a, b, k=K):
    union = sorted(set(a) | set(b))
    union = union if len(a) < k and len(b) < k else union[:k]
    return len(set(union) & set(a) & set(b)) / len(union) if union else 1.0


def plain_rows(rows):
    """doc_id, n_chars, edited_sha256, fingerprints, near_edited, near_next."""
    def place(r):
        t = r[1]
        digest = 42 if t is None else signed(xxhash.xxh64_intdigest(t.encode(), 42))
        return (r[0] is not None, r[0] or 0, digest)

    docs = [(r[0], r[1] or "") for r in sorted(rows, key=place)]
    out = []
    for at, (i, text) in enumerate(docs):
        after = docs[(at + 1) % len(docs)][1]
        n = len(text) // 4
        edited = text[:len(text) - n] + after[:n]
        a, b, c = map(plain_sketch, (text, edited, after))
        prints = ["".join(f"{h & (1 << 64) - 1:016x}" for h in s) for s in (a, b)]
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *prints,
                    plain_near(a, b), plain_near(a, c)))
    return out


def results(df):
    return sorted((tuple(r)[:7] for r in df.collect()), key=key)


def test_fingerprints_equal_the_plain_ones(spark):
    rows = awkward_documents()
    df = fingerprints(clashing(documents(spark)))
    assert df.columns[:7] == ["doc_id", "n_chars", "edited_sha256", "fingerprint",
                              "edited_fingerprint", "near_edited", "near_next"]
    assert results(df) == sorted(plain_rows(rows), key=key)


@pytest.mark.parametrize("rows", [
    [], [(1, None)], [(1, "One two THREE four five six seven")], [(None, "a b"), (None, "c d")],
    [(5, "x"), (3, "quarter of the beginning of me"), (-4, "é" * 9)]])
def test_few_rows(spark, rows):
    rows = [(i, t, None, None, None) for i, t in rows]
    assert results(fingerprints(documents(spark, rows))) == sorted(plain_rows(rows), key=key)


def test_copies_of_a_row_follow_each_other(spark, monkeypatch):
    monkeypatch.setattr(module, "COPIES", 7)
    text = " ".join(passage(1, 40))
    rows = [(3, text)] * 50 + [(None, text)] * 20 + [(None, None)] * 9 + [
        (3, "other"), (4, " ".join(passage(2, 30))), (None, "one")]
    rows = [(i, t, None, None, None) for i, t in rows]
    got = results(fingerprints(documents(spark, rows).repartition(5)))
    assert got == sorted(plain_rows(rows), key=key)


def test_estimates_are_near_the_whole_sets(spark):
    base = passage(7, 3000)
    rows = [(i, " ".join(base[:3000 - 300 * i] + passage(50 + i, 300 * i))) for i in range(9)]
    df = spark.createDataFrame(rows, "i int, text string").withColumn("s", sketch("text"))
    pairs = df.alias("a").join(df.alias("b"), F.col("a.i") <= F.col("b.i")).select(
        "a.i", F.col("b.i").alias("j"), resemblance(F.col("a.s"), F.col("b.s")).alias("r"),
        containment(F.col("a.s"), F.col("b.s")).alias("c"),
        distinct_shingles(F.col("a.s")).alias("n"))
    sets = {i: plain_shingles(t) for i, t in rows}
    for i, j, r, c, n in pairs.collect():
        a, b = sets[i], sets[j]
        assert abs(r - len(a & b) / len(a | b)) < 0.15
        assert abs(c - len(a & b) / len(a)) < 0.2
        assert abs(n / len(a) - 1) < 0.35


def test_sketches_merge_by_group(spark):
    rows = [(k % 3 or None, t[1]) for k, t in enumerate(awkward_documents())] + [(9, None)]
    df = spark.createDataFrame(rows, "host int, text string").repartition(4)
    got = merged(df.withColumn("s", sketch("text")), "host", "s")
    want = {}
    for host, text in rows:
        want[host] = want.get(host, set()) | plain_shingles(text)
    assert {r.host: r.sketch for r in got.collect()} == {
        h: sorted(s)[:K] for h, s in want.items()}


def test_no_python(spark):
    plan = fingerprints(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
