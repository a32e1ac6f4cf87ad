"""What the training-data operators share: column picking, written tables, words."""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import shared_dir

#: Key of rows whose id is null. Joins need a value; such rows match by text.
NO_ID = -(1 << 63)

#: Bytes of a text that are split into words at a time.
CHUNK_BYTES = 1 << 22


#: A table of at most so many rows and bytes is broadcast; past them, an equi-join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20


def position(df: DataFrame, column: str) -> int:
    """Where a column is; an exact name wins over one that differs in case."""
    names, lower = df.columns, [c.lower() for c in df.columns]
    return names.index(column) if column in names else lower.index(column.lower())


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The columns ``new=old`` of ``df`` and no others.

    Works by position, so extra columns may have any name, also one that differs
    from a wanted one in case only, or comes twice.
    """
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_c{position(df, old)}").alias(new)
                          for new, old in columns.items()])


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it has few rows and bytes.

    A value counts with the bytes of its text, and sixteen more.
    """
    long = [F.octet_length(f.name) for f in df.schema.fields
            if f.dataType.typeName() in ("string", "binary")]
    width = sum((F.coalesce(n, F.lit(0)) for n in long), F.lit(16 * len(df.columns)))
    n, total = df.limit(rows + 1).agg(F.count(F.lit(1)), F.sum(width.cast("bigint"))).first()
    return F.broadcast(df) if n <= rows and (total or 0) <= size else df


def saved(df: DataFrame, **partitioned) -> DataFrame:
    """``df`` written below the shared folder and read back.

    Cuts the lineage with files that outlive the executor that wrote them.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    df.write.parquet(path, **partitioned)
    return spark.read.schema(df.schema).parquet(path)


def key_of(doc_id: str = "doc_id", text: str = "text") -> dict[str, Column]:
    """Join key of a document row: its id, and a hash of its text for ids that repeat."""
    return {"_id": F.coalesce(F.col(doc_id).cast("bigint"), F.lit(NO_ID)),
            "_th": F.xxhash64(F.col(text))}


def ascii_lower(text: Column | str) -> Column:
    """A-Z lower-cased and nothing else; ``lower`` does that for texts of one-byte characters."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def split_words(text: Column | str, between: str) -> Column:
    """What stands between runs of the characters ``between``; none for null.

    Splitting costs less than half of extracting the words.
    """
    return F.coalesce(F.array_remove(F.split(text, f"[{between}]+", -1), ""),
                      F.array().cast("array<string>"))


def word_chunks(data: bytes, overlap: int = 0) -> Iterator[list[bytes]]:
    """Words between ASCII white space, some megabytes at a time.

    Every chunk after the first begins with the last ``overlap`` words before it.
    """
    at, carried = 0, []
    while at < len(data):
        end = min(len(data), at + CHUNK_BYTES)
        while end < len(data) and data[end] not in b"\x20\x09\x0a\x0b\x0c\x0d":
            end += 1
        words = data[at:end].split() if at or end < len(data) else data.split()
        at = end
        if words:
            yield carried + words
            carried = (carried + words)[-overlap:] if overlap else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 of each word."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def without_lines(text: Column, gone: Column) -> Column:
    """The lines of a text at other positions than ``gone``; the text if that is null.

    A set difference by hash, so the work is linear in the lines.
    """
    lines = F.split(text, "\n", -1)
    one = F.array(F.struct(lines.alias("lines"), gone.alias("gone")))
    kept = F.transform(one, lambda s: F.transform(
        F.array_except(F.transform(s["lines"], lambda _, at: at), s["gone"]),
        lambda at: F.get(s["lines"], at)))
    return F.when(gone.isNull(), text).otherwise(F.array_join(kept[0], "\n"))
