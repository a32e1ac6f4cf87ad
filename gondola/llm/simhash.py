"""SimHash near-duplicates by pigeonring filtering.

A fingerprint has one bit per sign of the summed shingle hashes. Two documents
link when their fingerprints differ in at most ``max_bits`` bits, and linked
documents form components.

Candidates come from the pigeonring principle: cut the 64 bits into
``max_bits + 1`` segments on a ring. If two fingerprints differ in at most
``max_bits`` bits, some start segment exists such that every chain of ``l``
consecutive segments from it differs in at most ``floor(l * max_bits / segments)``
bits. The first link of the chain allows no difference, so it is an equi-join on
(start, segment); the longer chains are conditions of that join, before the full
Hamming check.

A bucket that is too large to be compared pair by pair is narrowed by the next segment of
the chain: one side has its own bits there, the other every value that the chain's
budget allows, and both meet in buckets of two segments. Buckets that are still too large
go on with the third, up to the whole ring, where only fingerprints in reach meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import NO_ID, key_of, pick, position, saved, word_chunks
from .components import component_labels

BITS = 64
SEED = 42
#: Side of the largest bucket that is compared pair by pair; larger ones are narrowed.
PAIR_ROWS = 8192
#: Shingle hashes whose bits are counted at a time.
BLOCK = 1 << 14


def fingerprint(text: str | None, shingle: int) -> int:
    """Signed fingerprint of a text: over half of the shingle hashes have the bit."""
    ones, total = np.zeros(BITS, dtype=np.int64), 0
    short: list[bytes] = []
    data = text.encode("utf-8", "surrogatepass").lower() if text else b""
    for words in word_chunks(data, shingle - 1):
        if len(words) < shingle:
            short = words
            continue
        short = []
        runs = zip(*(words[k:] for k in range(shingle)))
        hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(run), SEED) for run in runs),
                             dtype="<u8", count=len(words) - shingle + 1)
        total += len(hashes)
        for at in range(0, len(hashes), BLOCK):
            block = hashes[at:at + BLOCK].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    if total == 0 and short:
        h = np.array([xxhash.xxh64_intdigest(b" ".join(short), SEED)], dtype="<u8")
        ones, total = np.unpackbits(h.view(np.uint8), bitorder="little").astype(np.int64), 1
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id",
                 text: str = "text", *more: str) -> DataFrame:
    """``doc_id``, signed ``fp`` and the bigints ``more`` of every row; null and wordless
    texts get 0."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, pa.int64()), *batch.columns[2:]],
                names=["doc_id", "fp", *more])

    rows = pick(docs, doc_id=doc_id, text=text, **{c: c for c in more}).select(
        F.col("doc_id").cast("bigint"), "text", *more)
    return rows.mapInArrow(of, ", ".join(f"{c} bigint" for c in ("doc_id", "fp", *more)))


def _masks(max_bits: int) -> list[int]:
    """Bits of each ring segment."""
    n = max_bits + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(cuts, cuts[1:])]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _chain_holds(masks: list[int], max_bits: int) -> Column:
    """Whether all chains from the bucket's start segment stay within their budgets."""
    n, differing = len(masks), F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    per_start = []
    for start in range(n):
        chains = [F.bit_count(differing.bitwiseAND(F.lit(_signed(reduce(
            int.__or__, (masks[(start + k) % n] for k in range(length))))))) <=
            length * max_bits // n for length in range(2, n)]
        per_start.append((F.col("a.start") == start) & reduce(Column.__and__, chains, F.lit(True)))
    return reduce(Column.__or__, per_start) & (F.bit_count(differing) <= max_bits)


def _flips(masks: list[int], max_bits: int, start: int, length: int) -> list[int]:
    """Differences that a chain of ``length`` segments may have, within all of its budgets."""
    n, found = len(masks), [(0, 0)]
    for link in range(2, length + 1):
        own = masks[(start + link - 1) % n]
        bits = [1 << b for b in range(BITS) if own >> b & 1]
        budget = link * max_bits // n
        found = [(flip | sum(some), used + k) for flip, used in found
                 for k in range(budget - used + 1) for some in combinations(bits, k)]
    return [flip for flip, _ in found]


def _sides(rows: DataFrame, masks: list[int], max_bits: int,
           length: int) -> tuple[DataFrame, DataFrame]:
    """``fp, start, key`` by a row's own first ``length`` segments, and by all allowed ones."""
    n = len(masks)
    mask = F.element_at(F.array(*[
        F.lit(_signed(reduce(int.__or__, (masks[(start + k) % n] for k in range(length)))))
        .cast("bigint") for start in range(n)]), F.col("start") + 1)
    own = rows.select("fp", "start", F.col("fp").bitwiseAND(mask).alias("key"))
    if length == 1:
        return own, own
    flips = rows.sparkSession.createDataFrame(
        [(start, _signed(f)) for start in range(n)
         for f in _flips(masks, max_bits, start, length)], "start int, flip bigint")
    near = F.col("fp").bitwiseXOR(F.col("flip")).bitwiseAND(mask)
    return own, rows.join(F.broadcast(flips), "start").select("fp", "start", near.alias("key"))


def links(prints: DataFrame, max_bits: int = 2, pair_rows: int = PAIR_ROWS) -> DataFrame:
    """All edges ``a < b`` between distinct fingerprints ``fp`` within ``max_bits`` bits."""
    if max_bits == 0:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    masks = _masks(max_bits)
    rows = prints.select("fp", F.explode(F.array(*[F.lit(i) for i in range(len(masks))]))
                         .alias("start"))
    found = []
    for length in range(1, len(masks) + 1):
        own, allowed = _sides(rows, masks, max_bits, length)
        last = length == len(masks)
        if not last:
            own, allowed, crowded = _by_size(own, allowed, pair_rows)
        found.append(own.alias("a").join(allowed.alias("b"), (
            (F.col("a.start") == F.col("b.start")) & (F.col("a.key") == F.col("b.key"))
            & (F.col("a.fp") < F.col("b.fp")) & _chain_holds(masks, max_bits)))
            .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b")))
        if last or crowded.isEmpty():
            break
        rows = crowded
    return reduce(DataFrame.unionByName, found).distinct()


def _by_size(own: DataFrame, allowed: DataFrame,
             pair_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both sides in buckets that can be compared, and ``fp, start`` of the rows in others."""
    count = F.count(F.lit(1))
    sizes = own.groupBy("start", "key").agg(count.alias("n"))
    if allowed is own:
        both = saved(own.join(sizes.filter("n > 1"), ["start", "key"]))
        near = both.filter(F.col("n") <= pair_rows)
        return near, near, both.filter(F.col("n") > pair_rows).select("fp", "start")
    pairs = sizes.join(allowed.groupBy("start", "key").agg(count.alias("m")), ["start", "key"])
    pairs = saved(pairs.filter("m > 1").withColumn(
        "large", F.col("n") * F.col("m") > pair_rows * pair_rows))
    sides = [saved(side.join(pairs, ["start", "key"])) for side in (own, allowed)]
    crowded = sides[0].unionByName(sides[1]).filter("large").select("fp", "start").distinct()
    return *(side.filter("NOT large") for side in sides), saved(crowded)


def labels(prints: DataFrame, max_bits: int = 2, pair_rows: int = PAIR_ROWS) -> DataFrame:
    """``fp, label`` of distinct fingerprints ``fp``: one label per component."""
    prints = saved(prints.select("fp"))
    linked = component_labels(saved(links(prints, max_bits, pair_rows))).toDF("fp", "label")
    return prints.join(linked, "fp", "left").withColumn("label", F.coalesce("label", "fp"))


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 2,
                       doc_id: str = "doc_id", text: str = "text",
                       pair_rows: int = PAIR_ROWS) -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row per input row.

    Words are what stands between ASCII white space, A-Z lower-cased; a shingle is
    ``shingle`` of them, or all where a text has fewer. ``fingerprint`` is 16
    hexadecimal digits, ``component_id`` the smallest id in reach.

    Null and wordless texts have fingerprint zero and link like any other. Rows
    that repeat stay and share a component. A null id never becomes a component's
    id, unless the component has no other. An empty table gives an empty result.
    """
    prints = saved(fingerprints(docs, shingle, doc_id, text))
    classes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    labelled = classes.join(labels(classes, max_bits, pair_rows), "fp")
    ids = labelled.groupBy("label").agg(F.min("least_id").alias("component_id"))
    component = labelled.join(ids, "label").select("fp", "component_id")
    return prints.join(component, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_component(docs: DataFrame, shingle: int = 3, max_bits: int = 2,
                      doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with all its columns, of each component the row with the smallest id.

    Null ids come after all others; of equal ids the lowest text hash stays, and of rows
    that repeat with the same id and text one. So every component keeps one row, also
    where it has no id, or an id that other texts in other components have too.
    """
    names = [f"_c{i}" for i in range(len(docs.columns))]
    at_id, at_text = (names[position(docs, c)] for c in (doc_id, text))
    rows = docs.toDF(*names).withColumns(key_of(at_id, at_text))
    prints = saved(fingerprints(rows, shingle, "_id", at_text, "_th"))
    labelled = labels(prints.select("fp").distinct(), max_bits)
    # Copies are reduced to one row of each fingerprint before they meet their label.
    first = prints.groupBy("fp").agg(F.min(F.struct(
        (F.col("doc_id") == NO_ID).alias("without"), F.col("doc_id").alias("_id"), "_th")).alias("x"))
    keep = (first.join(labelled, "fp").groupBy("label").agg(F.min("x").alias("x"))
            .select("x._id", "x._th"))
    # Kept rows alone are reduced to one of each, first where they are.
    return (rows.join(keep, ["_id", "_th"], "left_semi").dropDuplicates(["_id", "_th"])
            .select(*names).toDF(*docs.columns))
