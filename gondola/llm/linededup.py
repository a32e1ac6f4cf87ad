"""Line deduplication over windows of three consecutive lines.

Windows overlap by two lines. The first occurrence of a window, by document id and
place, stays; all lines that any later occurrence covers go. Only windows that occur
twice are joined back, and only line positions, not lines, meet per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import key_of, pick, position, without_lines

WINDOW = 3
#: A line that counts has something besides ASCII white space.
SOLID = r"[^\x20\x09-\x0D]"


def _windows(keyed: DataFrame, width: int) -> DataFrame:
    """``_id, _th, w1, w2, places``: 96 bits of hash of each window, its line positions."""
    solid = F.filter(
        F.transform(F.split("text", "\n", -1), lambda line, at: F.struct(
            line.alias("line"), at.alias("at"))),
        lambda x: x["line"].rlike(SOLID))
    hashed = F.transform(solid, lambda x: F.struct(
        F.xxhash64(x["line"]).alias("a"), F.hash(x["line"]).alias("b"), x["at"].alias("at")))
    rows = keyed.select("_id", "_th", hashed.alias("lines"))
    shifted = [F.slice("lines", k + 1, F.greatest(F.size("lines"), F.lit(1)))
               for k in range(width)]
    runs = rows.select("_id", "_th", F.explode(F.arrays_zip(
        *[s.alias(f"l{k}") for k, s in enumerate(shifted)])).alias("w"))
    part = [F.col("w")[f"l{k}"] for k in range(width)]
    return runs.filter(part[-1].isNotNull()).select(
        "_id", "_th",
        F.xxhash64(*[p["a"] for p in part]).alias("w1"),
        F.hash(*[p["b"] for p in part]).alias("w2"),
        F.array(*[p["at"] for p in part]).alias("places"))


def later_lines(keyed: DataFrame, width: int = WINDOW) -> DataFrame:
    """``_id, _th`` and ``gone``: the line positions that later occurrences cover."""
    windows = _windows(keyed, width)
    at = F.struct("_id", "_th", F.element_at("places", 1).alias("place"))
    first = (windows.groupBy("w1", "w2")
             .agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"))
             .filter("n > 1").select("w1", "w2", "first"))
    later = windows.join(first, ["w1", "w2"]).filter(at != F.col("first"))
    # At most as many entries as the document has lines.
    return (later.select("_id", "_th", F.explode("places").alias("place"))
            .groupBy("_id", "_th").agg(F.collect_set("place").alias("gone")))


def line_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               width: int = WINDOW) -> DataFrame:
    """``doc_id, n_lines, n_removed, text`` (what is left), one row per input row.

    Lines end at ``\\n``; windows run over lines that aren't blank, blank ones are never
    removed. A text with fewer than ``width`` such lines stays. Null texts have no
    lines and stay null; a text all of whose lines go becomes empty.

    Null ids come before all others. Rows with the same id and text are one
    occurrence, so a repeated row removes nothing from its twin; same id, other
    text: the order is by hash of the text. An empty table gives an empty result.
    """
    rows = pick(docs, doc_id=doc_id, text=text).withColumns(key_of())
    found = later_lines(rows, width)
    joined = rows.join(found, ["_id", "_th"], "left")
    return joined.select(
        "doc_id",
        F.coalesce(F.size(F.split("text", "\n", -1)), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.when(F.col("gone").isNotNull(), F.size("gone")), F.lit(0))
        .cast("bigint").alias("n_removed"),
        without_lines(F.col("text"), F.col("gone")).alias("text"))


def documents_without_later_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                                  n_chars: str | None = "n_chars",
                                  width: int = WINDOW) -> DataFrame:
    """``docs`` with all its columns, its texts as ``line_dedup`` leaves them.

    ``n_chars``, if given and there, becomes the length of what is left.
    """
    names = [f"_c{i}" for i in range(len(docs.columns))]
    at_text = position(docs, text)
    rows = docs.toDF(*names).withColumns(key_of(names[position(docs, doc_id)], names[at_text]))
    found = later_lines(rows.select("_id", "_th", F.col(names[at_text]).alias("text")), width)
    left = without_lines(F.col(names[at_text]), F.col("gone"))
    cut = rows.join(found, ["_id", "_th"], "left").withColumn("_left", left)
    columns = [F.col("_left") if i == at_text else F.col(c) for i, c in enumerate(names)]
    if n_chars and n_chars.lower() in [c.lower() for c in docs.columns]:
        at = position(docs, n_chars)
        kind = docs.schema.fields[at].dataType
        columns[at] = F.when(F.col("gone").isNull(), F.col(names[at])).otherwise(
            F.length("_left").cast(kind))
    return cut.select(*[c.alias(n) for c, n in zip(columns, names)]).toDF(*docs.columns)


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS place
  FROM documents WHERE text IS NOT NULL),
runs AS (
  SELECT doc_id, place, line AS l0,
         lead(line, 1) OVER w AS l1, lead(line, 2) OVER w AS l2,
         lead(place, 1) OVER w AS place1, lead(place, 2) OVER w AS place2
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
  WINDOW w AS (PARTITION BY doc_id ORDER BY place)),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY l0, l1, l2 ORDER BY doc_id, place) AS nth
  FROM runs WHERE l2 IS NOT NULL),
gone AS (
  SELECT DISTINCT doc_id, unnest([place, place1, place2]) AS place FROM numbered WHERE nth > 1),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.place) AS n_removed,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.place) FILTER (WHERE g.place IS NULL), '') AS text
  FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.place = l.place GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, k.text
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""
