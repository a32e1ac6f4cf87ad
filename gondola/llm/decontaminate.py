"""Benchmark decontamination over a positional inverted index.

The index stores one posting (term, document, position) for every occurrence in the
training texts of a term that a benchmark item has. It is written once, in the order
of the texts, so building it moves no row between executors.

A benchmark window is looked up from its rarest term: the postings of that term, moved
by the term's offset, are the places where the window may start. They are intersected
with the moved postings of the next rarest term, and what is left with those of all
other terms at once. A term may stand up to ``slop`` words off its place; a window
whose terms all stand in place is an exact phrase, any other a proximity match.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from .common import NO_ID, ascii_lower, key_of, pick, saved, small, split_words

WINDOW = 10
SLOP = 1
#: Characters between words, once A-Z are lower-cased.
BETWEEN = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
#: No word; its posting holds a document's number of words.
END = " "


def words(text: str) -> Column:
    """Words of a text column, A-Z lower-cased; none for null."""
    return split_words(ascii_lower(text), BETWEEN)


def item_windows(items: DataFrame, width: int, item_id: str, text: str) -> DataFrame:
    """``wid, terms, item`` of every distinct window of every item."""
    rows = pick(items, item=item_id, text=text).select(
        F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"), words("text").alias("w"))
    n = F.size("w")
    starts = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n - width + 1, F.lit(1))))
    cut = rows.select("item", F.explode(F.transform(
        starts, lambda k: F.slice(F.col("w"), k, F.lit(width)))).alias("terms"))
    return cut.select(F.xxhash64("terms").alias("wid"), "terms", "item").distinct()


def build_index(docs: DataFrame, vocabulary: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Written postings ``term, _id, _th, pos``; ``vocabulary`` has ``word, term``."""
    tokens = pick(docs, doc_id=doc_id, text=text).select(
        *[c.alias(k) for k, c in key_of().items()],
        F.posexplode(F.array_append(words("text"), F.lit(END))).alias("pos", "word"))
    return saved(tokens.join(small(vocabulary), "word").select("term", "_id", "_th", "pos"))


def window_plan(windows: DataFrame, index: DataFrame) -> DataFrame:
    """``wid, k, term, size, rank`` with the rarest term of each window first.

    A window with a term that no document has cannot occur and is left out.
    """
    frequency = index.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    ranked = (windows.select("wid", "terms").distinct()
              .select("wid", F.size("terms").alias("size"), F.posexplode("terms").alias("k", "word"))
              .withColumn("term", F.xxhash64("word")).join(frequency, "term"))
    # At most ``width`` terms a window.
    terms = (ranked.groupBy("wid", "size")
             .agg(F.array_sort(F.collect_list(F.struct("df", "k", "term"))).alias("terms"))
             .filter(F.size("terms") == F.col("size")))
    return (terms.select("wid", "size", F.posexplode("terms").alias("rank", "t"))
            .select("wid", "size", "rank", "t.k", "t.term"))


def matches(index: DataFrame, plan: DataFrame, slop: int) -> DataFrame:
    """``_id, _th, wid, start, size, exact`` of every phrase and proximity match."""
    place = ["_id", "_th", "wid", "start", "size"]
    offs = F.explode(F.array(*[F.lit(d) for d in range(-slop, slop + 1)]))

    def wanted(found: DataFrame, terms: DataFrame) -> DataFrame:
        """The postings that the other terms of each candidate may have."""
        return (found.join(terms.drop("size"), "wid")
                .select(*place, "off", "rank", "term",
                        (F.col("start") + F.col("k")).alias("base"), offs.alias("d"))
                .withColumn("pos", F.col("base") + F.col("d")).drop("base"))

    def met(candidates: DataFrame, postings: DataFrame) -> DataFrame:
        """Per candidate: terms found, and how far from their places in all."""
        key = ["term", "_id", "_th", "pos"]
        each = (candidates.join(postings.select(*key).distinct(), key)
                .groupBy(*place, "off", "rank").agg(F.min(F.abs("d")).alias("d")))
        return each.groupBy(*place, "off").agg(
            F.count(F.lit(1)).alias("n"), F.sum("d").alias("more"))

    def of(terms: DataFrame) -> DataFrame:
        return index.join(small(terms.select("term").distinct()), "term", "left_semi")

    first, second, rest = (plan.filter(c) for c in ("rank = 0", "rank = 1", "rank > 1"))
    from_rarest = (index.join(small(first), "term")
                   .select("_id", "_th", "wid", (F.col("pos") - F.col("k")).alias("start"), "size")
                   .filter(F.col("start") >= -slop).distinct()
                   .withColumn("off", F.lit(0).cast("bigint")))
    from_rarest = saved(from_rarest)
    two = saved(met(wanted(from_rarest.filter("size > 1"), second), of(second))
                .withColumn("off", F.col("more")).drop("n", "more"))
    where = small(saved(two.select("_id", "_th").distinct()))
    all_found = (met(wanted(two.filter("size > 2"), rest),
                     index.join(where, ["_id", "_th"], "left_semi"))
                 .filter(F.col("n") == F.col("size") - 2)
                 .select(*place, (F.col("off") + F.col("more")).alias("off")))
    ended = from_rarest.filter("size = 1").unionByName(two.filter("size = 2"))
    return all_found.unionByName(ended.select(*place, "off")).select(
        *place, (F.col("off") == 0).alias("exact"))


def _n_covered(spans: Column) -> Column:
    """Words under the union of sorted ``start, size`` spans."""
    def step(acc: Column, x: Column) -> Column:
        end = x["start"] + x["size"]
        return F.struct(
            F.greatest(acc["end"], end).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), end - F.greatest(acc["end"], x["start"]))).alias("n"))

    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(spans, zero, step, lambda acc: acc["n"])


def decontaminate(docs: DataFrame, items: DataFrame, width: int = WINDOW, slop: int = SLOP,
                  doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", with_key: bool = False) -> DataFrame:
    """What of the benchmark every row has, one row per input row.

    ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near``: words
    under windows that occur exactly, items with such windows, their ids sorted as
    strings and joined by commas, and places where a window matches only by proximity.
    A window is ``width`` consecutive words of an item, or all of a shorter one.

    Words are runs of letters and digits; null and wordless texts have none and no
    windows. Rows that repeat get the same result each. Null item ids count as one
    item with an empty id; null document ids stay null (as does the smallest bigint).
    Without items nothing is contaminated; an empty table gives an empty result.
    ``with_key`` adds ``_id`` and ``_th``, the ``key_of`` a row, which tells rows apart
    whose ids are null or repeat.
    """
    windows = saved(item_windows(items, width, item_id, item_text))
    vocabulary = saved(
        windows.select(F.explode("terms").alias("word")).distinct()
        .unionByName(items.sparkSession.range(1).select(F.lit(END).alias("word")))
        .withColumn("term", F.xxhash64("word")))
    index = build_index(docs, vocabulary, doc_id, text)
    end = F.xxhash64(F.lit(END))
    plan = saved(window_plan(windows, index.filter(F.col("term") != end)))
    found = saved(matches(index.filter(F.col("term") != end), plan, slop))

    exact = found.filter("exact")
    spans = (exact.groupBy("_id", "_th", "start").agg(F.max("size").alias("size"))
             .groupBy("_id", "_th")
             .agg(_n_covered(F.array_sort(F.collect_list(F.struct("start", "size")))).alias("n_hit")))
    hit_items = (exact.select("_id", "_th", "wid").distinct()
                 .join(windows.select("wid", "item"), "wid")
                 .groupBy("_id", "_th").agg(F.array_sort(F.collect_set("item")).alias("items")))
    near = (found.filter("not exact").select("_id", "_th", "wid", "start")
            .join(exact.select("_id", "_th", "wid", "start"),
                  ["_id", "_th", "wid", "start"], "left_anti")
            .groupBy("_id", "_th").agg(F.count(F.lit(1)).alias("n_near")))
    hits = (spans.join(hit_items, ["_id", "_th"]).join(near, ["_id", "_th"], "full"))
    lengths = index.filter(F.col("term") == end).select("_id", "_th", F.col("pos").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return lengths.join(hits, ["_id", "_th"], "left").select(
        F.nullif("_id", F.lit(NO_ID)).alias("doc_id"),
        F.col("n_words").cast("bigint").alias("n_words"), n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256)
        .alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        *(["_id", "_th"] if with_key else []))


ORACLE = rf"""
WITH items AS (
  SELECT item_id, regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, terms, len(terms) AS size FROM (
    SELECT item_id, unnest([w[k:k + 9] FOR k IN range(1, greatest(len(w) - 9, 1) + 1)]) AS terms
    FROM items WHERE len(w) > 0)),
texts AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, size, k, w[k:k + size - 1] AS terms FROM (
    SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k
    FROM texts, sizes WHERE len(w) >= size)),
found AS (SELECT doc_id, item_id, k, size FROM places JOIN windows USING (terms, size)),
hit AS (
  SELECT doc_id, count(DISTINCT at_word) AS n_hit FROM (
    SELECT doc_id, unnest(range(k, k + size)) AS at_word FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT coalesce(item_id::VARCHAR, ''), ','
                    ORDER BY coalesce(item_id::VARCHAR, '')) AS ids
  FROM found GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
