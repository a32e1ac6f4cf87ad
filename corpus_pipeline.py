"""Documents to a training mix: stages over the ``documents`` table.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written below
the shared folder and read back as the next stage's documents. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gondola.llm.common import key_of, position, saved
from gondola.llm.decontaminate import decontaminate
from gondola.llm.linededup import documents_without_later_lines
from gondola.llm.mixing import mix_sources
from gondola.llm.nbsvm import train, with_score
from gondola.llm.simhash import one_per_component

#: Documents scored lower go.
LEAST_QUALITY = 0.3
#: Size of the mix in totals of what is left, and how often a source may be read.
MIX_BUDGET, MIX_REPETITION = 1.25, 1.35


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on their labels, accepts."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality")
    scored = with_score(docs, model, score="_score")
    kept = scored.toDF(*[f"_c{i}" for i in range(len(docs.columns))], "_score").filter(
        F.col("_score") >= LEAST_QUALITY)
    return kept.drop("_score").toDF(*docs.columns)


def without_later_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the three-line windows of earlier ones."""
    return documents_without_later_lines(docs)


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash component, one without an id
    where none has any."""
    return one_per_component(docs, shingle=3, max_bits=2)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word window of a benchmark item occurs.

    Every text is judged by itself, also where ids are null or repeat.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate(docs, items, width=10, slop=0, with_key=True)
    hit = found.filter("contaminated").select("_id", "_th").distinct()
    names = [f"_c{i}" for i in range(len(docs.columns))]
    at_id, at_text = (names[position(docs, c)] for c in ("doc_id", "text"))
    rows = docs.toDF(*names).withColumns(key_of(at_id, at_text))
    return rows.join(hit, ["_id", "_th"], "left_anti").select(*names).toDF(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix in their order, as even in sources as the limit allows."""
    return mix_sources(docs, max_repetition=MIX_REPETITION, budget=MIX_BUDGET)


STAGES = [
    ("quality classifier", good_quality),
    ("line dedup", without_later_lines),
    ("simhash near-dedup", one_per_group),
    ("benchmark decontamination", without_benchmark),
    ("mix sources", mixed),
]

#: The first stage trains a model and the third hashes with XXH64: no SQL for either.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, one after the other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
