"""The quality classifier's features, ratios and scores against a plain restatement."""

import math
import os
import subprocess
import sys
import textwrap
import zlib

import numpy as np
import pytest

from gondola.llm import nbsvm
from gondola.llm.nbsvm import quality

from .rows import passage

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
MASK = 0xFFFFFFFF


def plain_shapes(data):
    words, run = [], b""
    for byte in [*data, 32]:
        if byte > 32:
            run += bytes([byte])
        elif run:
            words.append(run)
            run = b""
    out = []
    for at, w in enumerate(words):
        first, last = (65 <= c <= 90 for c in (w[0], w[-1]))
        mark = w[-1] < 128 and not chr(w[-1]).isalnum()
        same = at > 0 and words[at - 1] == w
        out.append(min(len(w), 15) | mark << 4 | last << 5 | first << 6 | same << 7)
    return out


def plain_features(text):
    data = (text or "").encode()
    out = set()
    for kind, symbols in ((0, list(data)), (4, plain_shapes(data))):
        for n in range(1, 5):
            for i in range(len(symbols) - n + 1):
                gram = 0
                for s in symbols[i:i + n]:
                    gram = gram << 8 | s
                h = (gram ^ (kind + n) * 0x9E3779B1 & MASK) * 0x85EBCA6B & MASK
                out.add(((h ^ h >> 15) * 0xC2B2AE35 & MASK) >> 14)
    return sorted(out)


@pytest.mark.parametrize("text", [
    None, "", " \n\t", "a", "Aa bB. bB. C", "one two, two", "Éàü — \U0001F600 X\x7f", "x" * 40])
def test_features_equal_the_plain_ones(text):
    marks = np.zeros(nbsvm.BUCKETS, bool)
    assert nbsvm.features(text, marks).tolist() == plain_features(text)
    assert not marks.any()


def labelled(n=60):
    docs = [(i, " ".join(passage(i, 30)) if i % 2 else "Buy NOW!! $$ " * (i % 7 + 3), None)
            for i in range(n)]
    return docs, [(i, i % 2) for i in range(0, n, 1) if i % 3]


def test_ratios_and_scores_equal_the_plain_ones(spark):
    docs, marked = labelled()
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string").repartition(3)
    labels = spark.createDataFrame(marked, "doc_id bigint, quality int")
    model = nbsvm.train(df, labels, "quality")
    texts = {i: plain_features(t) for i, t, _ in docs}
    counts = {c: np.zeros(nbsvm.BUCKETS) for c in (0, 1)}
    for i, label in marked:
        if zlib.crc32(str(i).encode()) % 5:
            counts[label][texts[i]] += 1
    shares = {c: (v + 1) / (v + 1).sum() for c, v in counts.items()}
    ratio = np.log(shares[1]) - np.log(shares[0])
    assert model.ratio == pytest.approx(ratio)
    want = {}
    for i, row in texts.items():
        length = math.sqrt(sum(ratio[b] ** 2 for b in row)) or 1.0
        at = sum(model.weights[b] for b in row) / length + model.bias
        want[i] = 1 / (1 + math.exp(-(model.slope * at + model.offset)))
    got = {r.doc_id: r for r in quality(df, labels).collect()}
    assert {i: r.score for i, r in got.items()} == pytest.approx(want)
    assert all(r.predicted == (r.score >= 0.3) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())


def test_workers_need_no_copy_of_the_package(tmp_path):
    """A session started elsewhere, where workers can't import the package."""
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from gondola.llm.nbsvm import quality
        from gondola.session import local_session
        spark = local_session(2)
        docs = spark.createDataFrame([(i, "good plain words here " * (i % 5 + 1) if i % 2
                                       else "BUY $$ now " * (i % 4 + 2)) for i in range(40)],
                                     "doc_id bigint, text string")
        labels = docs.selectExpr("doc_id", "int(doc_id % 2) AS quality")
        print("SCORED", quality(docs, labels).filter("score BETWEEN 0 AND 1").count())
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, timeout=300,
                          capture_output=True, text=True)
    assert "SCORED 40" in done.stdout, done.stderr[-2000:]
