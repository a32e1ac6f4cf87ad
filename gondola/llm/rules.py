"""Quality rules, with the frequency of lines across documents.

Base rules look at one text. The method counts, per host, the documents that have a
line (normalised and hashed), takes out lines in more documents than the host's
limit, and rejects documents of which too little is left.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from .common import key_of, pick, saved, without_lines

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
#: Words of the windows whose repetition within a text counts.
WINDOW = 8
#: A line is common above so many documents of its host.
LIMIT_DOCS = 10
#: Percentage of its words that a document must keep.
LEAST_LEFT = 30
LEAST_WORDS, MOST_REPEATED = 20, 30


def _repeated_words(hashes: Column) -> Column:
    """Words in windows that occur twice or more, from the hashes of all windows in order."""
    def again(sorted_: Column) -> Column:
        """Places of equal neighbours, then the union of their windows."""
        equal = F.filter(sorted_, lambda x, i: (x["h"] == F.get(sorted_, i - 1)["h"])
                         | (x["h"] == F.get(sorted_, i + 1)["h"]))
        places = F.array_sort(F.transform(equal, lambda x: x["at"]))
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(places, zero, lambda acc, p: F.struct(
            (p + WINDOW).alias("end"),
            (acc["n"] + p + WINDOW - F.greatest(acc["end"], p)).alias("n")), lambda acc: acc["n"])

    sorted_ = F.sort_array(F.transform(
        hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
    once = F.transform(F.array(sorted_), again)[0]
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), once).otherwise(0)


def _measured(rows: DataFrame) -> DataFrame:
    """The base figures, and ``lines``: hash, words and place of every line with a word."""
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    lines = F.filter(
        F.transform(F.split("text", "\n", -1), lambda line, at: F.struct(
            line.alias("line"), at.alias("at"))),
        lambda x: x["line"].rlike(WORD))
    step = (rows.withColumn("text", F.coalesce("text", F.lit("")))
            .withColumn("words", words).withColumn("lines", lines))
    hashed = step.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    # The lambda reads ``hashes`` as a column, so it is computed once per text.
    windows = F.when(F.size("words") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("words") - WINDOW),
        lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)]))
    ).otherwise(F.array().cast("array<bigint>"))
    return hashed.withColumn("windows", windows).select(
        "doc_id", "host", "_id", "_th",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct(F.transform("lines", lambda x: x["line"]))))
        .cast("bigint").alias("n_dup_lines"),
        _repeated_words(F.col("windows")).cast("bigint").alias("n_repeat_words"))


def _lines(rows: DataFrame) -> DataFrame:
    """``host, _id, _th, a, b, n, at``: 96 bits of hash, words and place of each line."""
    raw = rows.select("host", "_id", "_th", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    plain = F.trim(F.regexp_replace(F.translate(
        "line", string.ascii_uppercase, string.ascii_lowercase), r"[\x20\x09-\x0D]+", " "))
    return raw.select("host", "_id", "_th", "at", plain.alias("line")).filter("line <> ''").select(
        "host", "_id", "_th", F.xxhash64("line").alias("a"), F.hash("line").alias("b"),
        (F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1).alias("n"), "at")


def quality_rules(docs: DataFrame, limit_docs: int = LIMIT_DOCS, least_left: int = LEAST_LEFT,
                  doc_id: str = "doc_id", text: str = "text", host: str = "source",
                  with_text: bool = True) -> DataFrame:
    """Base figures and verdict of every row.

    ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, n_left_words`` and, if asked for, ``left_text``, the text
    without common lines. A line is normalised by lower-casing A-Z and reducing
    white space. It is common if more than ``limit_docs`` documents of the host have it, however
    large the host is. A document is kept if it passes the base rules and at least ``least_left`` of a
    hundred of its words are left.

    Null texts count as empty and fail. A null host is a host of its own. Rows that
    repeat with the same id and text are one document to the counts and get the same
    verdict each. An empty table gives an empty result.
    """
    rows = pick(docs, doc_id=doc_id, text=text, host=host).withColumns(key_of())
    measured = _measured(rows)
    lines = saved(_lines(rows))
    having = lines.groupBy("host", "a", "b").agg(F.countDistinct("_id", "_th").alias("having"))
    common = having.filter(F.col("having") > limit_docs)
    common = common.select(F.col("host").alias("_host"), "a", "b")
    # At most as many places as the document has lines; a repeated row has each twice.
    gone = (lines.join(common, F.col("host").eqNullSafe(F.col("_host"))
                       & (lines["a"] == common["a"]) & (lines["b"] == common["b"]))
            .select("_id", "_th", "at", "n").distinct()
            .groupBy("_id", "_th").agg(F.sum("n").alias("n_gone"), F.collect_set("at").alias("gone")))
    base_failed = ((F.col("n_words") < LEAST_WORDS)
                   | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED))
    left = F.col("n_words") - F.coalesce("n_gone", F.lit(0))
    judged = measured.join(gone, ["_id", "_th"], "left").select(
        "_id", "_th", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", base_failed.alias("base_failed"),
        (~base_failed & (left * 100 >= F.col("n_words") * least_left)).alias("kept"),
        left.alias("n_left_words"), "gone")
    if with_text:
        texts = rows.select("_id", "_th", "text").dropDuplicates(["_id", "_th"])
        judged = judged.join(texts, ["_id", "_th"]).withColumn(
            "left_text", without_lines(F.col("text"), F.col("gone"))).drop("text")
    return judged.drop("_id", "_th", "gone")


ORACLE = rf"""
WITH t AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS (
  SELECT doc_id, k, w[k:k + 7] AS win FROM (
    SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS k FROM t WHERE len(w) >= 8)),
again AS (
  SELECT doc_id, k FROM wins QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(k, k + 8)) AS p FROM again) GROUP BY doc_id),
lines AS (
  SELECT doc_id, source, line,
         trim(regexp_replace(translate(line, '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                             '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS plain,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id),
common AS (
  SELECT source, plain FROM lines GROUP BY source, plain
  HAVING count(DISTINCT doc_id) > {LIMIT_DOCS}),
gone AS (
  SELECT doc_id, sum(n)::BIGINT AS n FROM lines l JOIN common c
    ON l.source IS NOT DISTINCT FROM c.source AND l.plain = c.plain GROUP BY doc_id),
figures AS (
  SELECT t.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         len(w) - coalesce(gone.n, 0) AS n_left_words
  FROM t LEFT JOIN rep USING (doc_id) LEFT JOIN dup USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
       NOT base_failed AND 100 * n_left_words >= {LEAST_LEFT} * n_words AS kept, n_left_words
FROM figures
"""
