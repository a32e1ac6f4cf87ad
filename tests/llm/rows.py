"""Small document tables with every awkward case, and plain restatements."""

from __future__ import annotations

import random

LONG = " ".join(f"w{i * i % 9973}" for i in range(30_000))


def passage(seed: int, n: int = 60) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def awkward_documents() -> list[tuple]:
    """doc_id, text, lang, source, n_chars: nulls, blanks, repeats, ties, one long text."""
    a, b, c = (passage(s) for s in (1, 2, 3))
    lines = "\n".join(" ".join(passage(s, 9)) for s in range(10, 16))
    texts = [
        (1, " ".join(a)), (2, " ".join(a)), (3, " ".join(a[:30] + b[:20])),
        (4, " ".join(b)), (5, "  ".join(b[5:40]) + "\t" + " ".join(c[:12])),
        (6, None), (7, ""), (8, " \n\t "), (9, "one"), (10, "one two"),
        (11, lines), (12, "first line\n" + lines), (13, lines + "\n\nlast line"),
        (14, LONG), (15, LONG + " end"), (None, " ".join(a)), (None, None),
        (16, " ".join(c)), (16, " ".join(c)), (16, " ".join(reversed(c))),
        (17, " ".join(["same"] * 50)), (18, "Éàü ñ — \U0001F600 " + " ".join(c[:20])),
        (19, "a\x0bb\x0cc\rd\x1ce\x85f\xa0g " + " ".join(a[10:25])),
    ]
    return [(i, t, None if k == 2 else "en", None if k % 7 == 3 else f"src{k % 2}",
             None if t is None else len(t)) for k, (i, t) in enumerate(texts)]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows=None):
    return spark.createDataFrame(awkward_documents() if rows is None else rows, SCHEMA)


def clashing(df):
    """More columns, with names that operators use themselves."""
    from pyspark.sql import functions as F

    names = ["_id", "_th", "h1", "words", "n_words", "score", "fp", "label", "Text", "DOC_ID",
             "gone", "host", "value", "epoch", "key", "term", "_c0", "start"]
    return df.select(*[F.lit("x").alias(n) for n in names], *df.columns)


def key(row):
    """Order of rows that may hold nulls."""
    return tuple((v is None, v) for v in row)
