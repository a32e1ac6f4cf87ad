"""Text quality by Naive Bayes support vectors.

Features are indicators of n-grams of bytes and of word shapes, hashed. Each is scaled by the log-count ratio of the classes, counted over all labelled rows, and a
linear model with hinge loss is fitted to a bounded sample by dual coordinate descent.
A fifth of the sample is left out of the fit and turns margins into probabilities.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import pick, position, small

#: Size of the hashed feature space; counts and weights are vectors of this length.
BUCKETS = 1 << 18
LONGEST = 4
#: Labelled rows that the linear model is fitted to; counts are taken over all.
FIT_ROWS = 6_000
#: Bytes of a text whose n-grams are hashed at a time.
BLOCK = 1 << 20
SMOOTHING = 1.0
COST = 1.0
EPOCHS = 30


def _marked(gram: np.ndarray, kind: int, marks: np.ndarray) -> None:
    """Mark the buckets of 32-bit n-grams; each kind of n-gram hashes differently."""
    h = (gram ^ np.uint32(kind * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(15)
    marks[(h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - int(math.log2(len(marks))))] = True


def word_shapes(block: np.ndarray) -> np.ndarray:
    """One small number per word: length, case of its ends, and whether it repeats.

    Bit 7: equal to the word before; 6: starts with a capital; 5: ends with one; 4: ends
    with a mark; below: bytes, 15 at most.
    """
    solid = np.concatenate(([False], (block > 32), [False]))
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint32)
    powers = np.cumprod(np.full(len(block) + 1, 0x9E3779B97F4A7C15, np.uint64))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(block * powers[:-1])))
    # Powers of one base, brought to the same exponent.
    hashes = (sums[ends] - sums[starts]) * powers[len(block) - starts]
    same = np.concatenate(([False], hashes[1:] == hashes[:-1]))
    first, last = block[starts], block[ends - 1]
    capital = [(c >= 65) & (c <= 90) for c in (first, last)]
    mark = (last < 48) | (last > 57) & (last < 65) | (last > 90) & (last < 97) | (
        last > 122) & (last < 128)
    return (np.minimum(ends - starts, 15) | mark << 4 | capital[1] << 5
            | capital[0] << 6 | same << 7).astype(np.uint32)


def features(text: str | None, marks: np.ndarray) -> np.ndarray:
    """Sorted buckets of a text's n-grams; ``marks`` is a cleared scratch vector.

    N-grams of one to ``LONGEST`` bytes, and of one to ``LONGEST`` word shapes.
    """
    data = np.frombuffer(text.encode("utf-8", "surrogatepass") if text else b"", np.uint8)
    for at in range(0, len(data), BLOCK):
        block = data[at:at + BLOCK + LONGEST - 1]
        for kind, symbols in ((0, block), (LONGEST, word_shapes(block))):
            gram = np.zeros(len(symbols), np.uint32)
            for n in range(1, min(LONGEST, len(symbols)) + 1):
                gram = (gram[:len(symbols) - n + 1] << np.uint32(8)) | symbols[n - 1:]
                _marked(gram, kind + n, marks)
    found = np.flatnonzero(marks)
    marks[found] = False
    return found.astype(np.int32)


def log_count_ratio(positive: np.ndarray, negative: np.ndarray) -> np.ndarray:
    p, q = positive + SMOOTHING, negative + SMOOTHING
    return np.log(p / p.sum()) - np.log(q / q.sum())


def dual_descent(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray,
                 cost: float = COST, epochs: int = EPOCHS, seed: int = 42) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge loss over unit rows ``ratio x indicator``.

    Both classes weigh the same: a row's cost is in inverse proportion to its class.
    """
    y = np.where(labels > 0, 1.0, -1.0)
    share = {c: max(1, int((y == c).sum())) for c in (1.0, -1.0)}
    caps = np.array([cost * len(y) / (2 * share[c]) for c in y])
    norms = np.array([math.sqrt(float((ratio[r] ** 2).sum())) or 1.0 for r in rows])
    w, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(y))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            r = rows[i]
            x = ratio[r] / norms[i]
            slope = y[i] * (float(w[r] @ x) + bias) - 1.0
            # The row's squared length is 1, and 1 more for the bias.
            new = min(max(alpha[i] - slope / 2.0, 0.0), caps[i])
            step = new - alpha[i]
            if step:
                w[r] += step * y[i] * x
                bias += step * y[i]
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w * ratio, bias


def margin(row: np.ndarray, ratio: np.ndarray, weights: np.ndarray, bias: float) -> float:
    """``weights`` already hold the ratio; the row's length is divided out."""
    length = math.sqrt(float((ratio[row] ** 2).sum())) or 1.0
    return float(weights[row].sum()) / length + bias


def sigmoid_fit(margins: np.ndarray, labels: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and offset of the probability of label 1, by Newton steps (Platt)."""
    n1, n0 = float((labels > 0).sum()), float((labels <= 0).sum())
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, math.log((n1 + 1) / (n0 + 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -35, 35)))
        g, s = target - p, p * (1 - p)
        grad = np.array([(g * margins).sum(), g.sum()])
        hess = np.array([[(s * margins ** 2).sum() + 1e-9, (s * margins).sum()],
                         [(s * margins).sum(), s.sum() + 1e-9]])
        step = np.linalg.solve(hess, grad)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


@dataclass
class Model:
    """A fitted classifier; ``prior`` is the score if the labels had one class or none."""
    ratio: np.ndarray
    weights: np.ndarray
    bias: float = 0.0
    slope: float = 0.0
    offset: float = 0.0
    prior: float | None = None


def probability(row: np.ndarray, ratio: np.ndarray, weights: np.ndarray, bias: float,
                slope: float, offset: float, prior: float | None) -> float:
    """Probability of label 1 for a row of buckets, from a model's fields."""
    if prior is not None:
        return prior
    at = slope * margin(row, ratio, weights, bias) + offset
    return 1 / (1 + math.exp(-min(max(at, -700.0), 700.0)))


def held_out(doc_id: str = "doc_id"):
    """Whether a document's label is kept from training: crc32 of its id, modulo five."""
    as_text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(as_text.cast("binary")) % 5 == 0


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of each class that have a bucket, in pieces of the feature space."""
    marks, counts = np.zeros(BUCKETS, bool), np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
            counts[label][features(text.as_py(), marks)] += 1
    if counts.any():
        pieces = counts.reshape(2, -1, 1 << 12)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(pieces.shape[1]), pa.int32())]
            + [pa.array([p.tobytes() for p in side]) for side in pieces],
            names=["piece", "negative", "positive"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pieces of all tasks added up."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, *sides in zip(*(c.to_pylist() for c in batch.columns)):
            new = np.stack([np.frombuffer(s, np.int64) for s in sides])
            sums[piece] = sums[piece] + new if piece in sums else new
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32())]
            + [pa.array([v[k].tobytes() for v in sums.values()]) for k in range(2)],
            names=["piece", "negative", "positive"])


def _fit(ratio, cost: float, epochs: int):
    """Arrow function for the one task that holds the sample: weights and sigmoid."""
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, sample, ratios = np.zeros(BUCKETS, bool), [], ratio.value
        for batch in batches:
            for doc, text, label in zip(batch.column(0).to_pylist(), batch.column(1),
                                        batch.column(2).to_pylist()):
                sample.append((doc, label, features(text.as_py(), marks)))
        if not sample:
            return
        sample.sort(key=lambda x: (x[0], x[1], len(x[2])))
        rows, labels = [x[2] for x in sample], np.array([x[1] for x in sample])
        aside = np.arange(len(rows)) % 5 == 0
        if len(set(labels[aside])) < 2 or len(set(labels[~aside])) < 2:
            aside[:] = False
        used = np.flatnonzero(~aside)
        weights, bias = dual_descent([rows[i] for i in used], labels[used], ratios,
                                     cost, epochs)
        known = np.flatnonzero(aside) if aside.any() else used
        slope, offset = sigmoid_fit(np.array([
            margin(rows[i], ratios, weights, bias) for i in known]), labels[known])
        yield pa.RecordBatch.from_pydict({
            "weights": [weights.tobytes()], "bias": [bias], "slope": [slope], "offset": [offset]})

    return fit


def train(docs: DataFrame, labels: DataFrame, label: str, fit_rows: int = FIT_ROWS,
          cost: float = COST, epochs: int = EPOCHS, doc_id: str = "doc_id",
          text: str = "text") -> Model:
    """Fit on the labelled rows that aren't held out.

    Ratios are counted over all of them, the weights fitted to the ``fit_rows`` whose
    ids hash lowest. A document with several labels counts once for each; null labels
    and ids are left out.
    """
    spark = docs.sparkSession
    known = (pick(labels, _id=doc_id, label=label).filter("_id IS NOT NULL AND label IS NOT NULL")
             .select("_id", F.when(F.col("label") > 0, 1).otherwise(0).alias("label"))
             .filter(~held_out("_id")))
    texts = pick(docs, doc_id=doc_id, text=text)

    def labelled(rows: DataFrame) -> DataFrame:
        return texts.join(small(rows), F.col("doc_id") == F.col("_id")).select(
            F.col("doc_id").cast("bigint"), "text", "label")

    parts = labelled(known).select("text", "label").mapInArrow(
        _counts, "piece int, negative binary, positive binary")
    counts = np.zeros((2, BUCKETS))
    size = 1 << 12
    tasks = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for piece, *sides in (parts.repartition(tasks, "piece")
                          .mapInArrow(_added, "piece int, negative binary, positive binary")
                          .collect()):  # two counts a bucket
        for k, side in enumerate(sides):
            counts[k, piece * size:(piece + 1) * size] = np.frombuffer(side, np.int64)
    shares = dict(known.join(texts.select("doc_id"), F.col("doc_id") == F.col("_id"), "left_semi")
                  .groupBy("label").count().collect())
    if len(shares) < 2:
        zeros = np.zeros(BUCKETS)
        return Model(zeros, zeros, prior=(shares.get(1, 0) + 1) / (sum(shares.values()) + 2))
    ratio = log_count_ratio(counts[1], counts[0])
    lowest = (known.join(texts.select("doc_id"), F.col("doc_id") == F.col("_id"), "left_semi")
              .orderBy(F.xxhash64("_id"), "_id", "label").limit(fit_rows))
    # The sample alone moves to one task; its texts are read where they lie.
    fitted = (labelled(lowest).repartition(1).mapInArrow(
        _fit(spark.sparkContext.broadcast(ratio), cost, epochs),
        "weights binary, bias double, slope double, offset double").first())
    return Model(ratio, np.frombuffer(fitted["weights"]), fitted["bias"], fitted["slope"],
                 fitted["offset"])


def with_score(docs: DataFrame, model: Model, text: str = "text",
               score: str = "score") -> DataFrame:
    """``docs`` and a last column ``score``; rows stay where they are.

    What is broadcast is plain: arrays and numbers, which workers read without this package.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.ratio, model.weights, float(model.bias), float(model.slope), float(model.offset),
         model.prior))
    names = [f"_c{i}" for i in range(len(docs.columns))] + [score]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, fitted = np.zeros(BUCKETS, bool), shared.value
        for batch in batches:
            scores = [probability(features(t.as_py(), marks), *fitted) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(scores, pa.float64())], names=names)

    plain = docs.toDF(*names[:-1])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema)
    first = plain.select(F.col(names[position(docs, text)]).alias("_text"), *names[:-1])
    return first.mapInArrow(add, f"{kinds}, {score} double").toDF(*docs.columns, score)


def quality(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3,
            doc_id: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per input row.

    ``score`` is the probability of label 1; ``predicted`` is 1 from ``threshold`` on. Only
    the text enters a score. Null and empty texts have no n-grams and get the score of
    the bias; a row whose id is null counts as held out. Rows that repeat get equal
    scores. Labels of one class only, or none, give all rows the smoothed share of
    label 1. An empty table gives an empty result.
    """
    model = train(docs, labels, label, fit_rows, doc_id=doc_id, text=text)
    rows = with_score(pick(docs, doc_id=doc_id, text=text), model)
    return rows.select("doc_id", held_out().alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"))
