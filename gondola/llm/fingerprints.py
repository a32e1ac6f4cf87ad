"""Document fingerprints: bottom-k sketches of shingle hashes, from array functions alone.

A sketch holds the ``k`` smallest distinct XXH64 values of a text's five-word shingles in
ascending order, all of them where there are fewer. The sketch of two parts is the k smallest
of their sketches, so sketches merge by group, and two sketches estimate how much of the
texts is shared: the k smallest of both are a sample of the union.

Words stand between ASCII white space and have A-Z lower-cased. A text of fewer words is one
shingle, a blank one has none; two texts without shingles are alike, one without and one with
aren't. Null texts count as empty.

The next document is the one with the next larger id, null ids before all others, equal
ids by text; the first follows the last. Ids are whole numbers. Keys alone are put in
order; a document then gets the beginning that its predecessor asks for out of one shuffle
of the texts. Rows equal in id and text are one key with a count, so no group of them meets
in a task; of such copies all but the last are followed by a copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.ranking import top_n
from .common import NO_ID, ascii_lower, key_of, pick, saved, small, split_words

#: Words of a shingle, hashes of a sketch.
SHINGLE, K = 5, 128
WHITE = r"\x20\x09-\x0D"
#: Copies of a row that one task writes at most.
COPIES = 100_000


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.transform(F.array(value), then)[0]


def sketch(text: Column | str, shingle: int = SHINGLE, k: int = K) -> Column:
    """The ``k`` smallest distinct shingle hashes of a text, ascending."""
    words = F.transform(split_words(ascii_lower(text), WHITE), lambda w: F.xxhash64(w))

    def hashes(ws: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(ws) - shingle, F.lit(0)))
        whole = F.transform(starts, lambda i: F.xxhash64(
            *[F.get(ws, i + j) for j in range(shingle)]))
        return F.when(F.size(ws) > 0, whole).otherwise(F.array().cast("array<bigint>"))

    return F.slice(F.sort_array(F.array_distinct(_let(words, hashes))), 1, k)


def as_text(hashes: Column) -> Column:
    """Sixteen hex digits for every hash of a sketch."""
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def _sample(a: Column, b: Column, k: int) -> Column:
    """A sample of the union: the k smallest, or all where both sketches are whole sets."""
    both = F.array_union(a, b)
    return F.when((F.size(a) < k) & (F.size(b) < k), both).otherwise(
        F.slice(F.sort_array(both), 1, k))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of both texts that both have, 0 to 1."""
    def share(u: Column) -> Column:
        common = F.size(F.array_intersect(u, F.array_intersect(a, b)))
        return F.when(F.size(u) == 0, F.lit(1.0)).otherwise(common / F.size(u))
    return _let(_sample(a, b, k), share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first text's shingles that the second has, 0 to 1."""
    def share(u: Column) -> Column:
        own = F.size(F.array_intersect(u, a))
        common = F.size(F.array_intersect(u, F.array_intersect(a, b)))
        return F.when(F.size(a) == 0, F.lit(1.0)).when(own == 0, F.lit(0.0)).otherwise(common / own)
    return _let(_sample(a, b, k), share)


def distinct_shingles(hashes: Column, k: int = K) -> Column:
    """Distinct shingles of a text: counted in a sketch that isn't full, else estimated from
    how far its hashes reach."""
    reach = (F.element_at(hashes, -1).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(hashes) < k, F.size(hashes).cast("double")).otherwise((k - 1) / reach)


def merged(df: DataFrame, by: str, hashes: str, k: int = K) -> DataFrame:
    """``by, sketch``: one sketch of all rows that share ``by``, a null one too.

    Repeated hashes go first and the rest is cut to k in every task, so no group's
    hashes meet in one.
    """
    each = pick(df, _by=by, _h=hashes)
    single = each.select("_by", F.explode("_h").alias("h")).distinct()
    lists = (top_n(single, ["_by"], ["h"], k).groupBy(F.col("_by").alias("_of"))
             .agg(F.sort_array(F.collect_list("h")).alias("sketch")))
    groups = each.select("_by").distinct()
    return groups.join(lists, F.col("_by").eqNullSafe(F.col("_of")), "left").select(
        F.col("_by").alias(by),
        F.coalesce("sketch", F.array().cast("array<bigint>")).alias("sketch"))


def next_keys(keys: DataFrame) -> DataFrame:
    """``keys`` (``_id, _th``, distinct) with the key after each, ``next``; the first is after the last.

    Spark cuts them into ranges; only the first key of each range meets the others.
    """
    key = F.struct("_id", "_th")
    blocked = saved(keys.repartitionByRange("_id", "_th")
                    .withColumn("_block", F.spark_partition_id()))
    firsts = blocked.groupBy("_block").agg(F.min(key).alias("_first"))
    ends = firsts.select(F.col("_block").alias("_of"), F.coalesce(
        F.lead("_first").over(Window.orderBy("_block")),
        F.first("_first").over(Window.orderBy("_block"))).alias("_after"))
    inside = F.lead(key).over(Window.partitionBy("_block").orderBy("_id", "_th"))
    return (blocked.withColumn("_inside", inside).join(small(ends), F.col("_block") == F.col("_of"))
            .withColumn("next", F.coalesce("_inside", "_after"))
            .drop("_block", "_of", "_inside", "_after"))


def edited_by_next(df: DataFrame, shingle: int = SHINGLE, k: int = K, doc_id: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """Sketches of every text, of its edited text and of the next text.

    ``doc_id, n_chars, edited, sketch, edited_sketch, next_sketch``. The edited text has its last
    quarter replaced by as much of the beginning of the next document.
    """
    docs = pick(df, _doc=doc_id, text=text).withColumns(key_of("_doc", "text")).drop("_doc")
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    keys = docs.select("_id", "_th", F.char_length("text").alias("n_chars"))
    keys = saved(keys.groupBy("_id", "_th").agg(F.count(F.lit(1)).alias("copies"),
                                                F.max("n_chars").alias("n_chars")))
    repeats = not keys.filter("copies > 1").isEmpty()
    if repeats:
        docs = docs.dropDuplicates(["_id", "_th"])
    docs = docs.withColumn("sketch", sketch("text", shingle, k))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    asked = next_keys(keys.select("_id", "_th", "n_chars")).select(
        F.col("_id").alias("_to"), F.col("_th").alias("_to_th"), quarter.alias("_asked"),
        F.col("next._id").alias("_id"), F.col("next._th").alias("_th"))
    given = docs.join(asked, ["_id", "_th"]).select(
        F.col("_to").alias("_id"), F.col("_to_th").alias("_th"),
        F.left("text", "_asked").alias("_begin"), F.col("sketch").alias("next_sketch"))
    n = F.char_length("text")
    pairs = docs.join(given, ["_id", "_th"])
    if repeats:
        pairs = _with_copies(saved(pairs), keys)
    edited = F.concat(F.left("text", n - F.floor(n / 4).cast("int")), F.col("_begin"))
    known = F.when(F.col("_id") != NO_ID, F.col("_id"))
    return pairs.select(known.alias("doc_id"), n.cast("bigint").alias("n_chars"),
                        edited.alias("edited"), "sketch", "next_sketch").withColumn(
        "edited_sketch", sketch("edited", shingle, k))


def _with_copies(pairs: DataFrame, keys: DataFrame) -> DataFrame:
    """A row for each copy of a key, the others followed by a copy of themselves."""
    counted = keys.filter("copies > 1").select("_id", "_th", (F.col("copies") - 1).alias("more"))
    n = F.char_length("text")
    lots = F.explode(F.sequence(F.lit(0), F.floor((F.col("more") - 1) / COPIES))).alias("_lot")
    own = (pairs.join(small(counted), ["_id", "_th"])
           .select("_id", "_th", "text", "sketch",
                   F.left("text", F.floor(n / 4).cast("int")).alias("_begin"),
                   F.col("sketch").alias("next_sketch"), "more", lots)
           .repartition("_id", "_th", "_lot"))
    size = F.least(F.lit(COPIES), F.col("more") - F.col("_lot") * COPIES).cast("int")
    return pairs.unionByName(own.withColumn("_each", F.explode(F.sequence(F.lit(1), size)))
                             .select(*pairs.columns))


def fingerprints(df: DataFrame, shingle: int = SHINGLE, k: int = K) -> DataFrame:
    """Fingerprint of every text and of its edited text, and how alike they are.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``,
    then the number of distinct shingles, and the shares of them in the edited and the
    next text.
    """
    rows = edited_by_next(df, shingle, k)
    own, edited, after = (F.col(c) for c in ("sketch", "edited_sketch", "next_sketch"))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(own).alias("fingerprint"), as_text(edited).alias("edited_fingerprint"),
        resemblance(own, edited, k).alias("near_edited"),
        resemblance(own, after, k).alias("near_next"),
        distinct_shingles(own, k).alias("n_shingles"),
        containment(own, edited, k).alias("in_edited"), containment(own, after, k).alias("in_next"))
