"""One query per training-data operator, with the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (codes, decontaminate as decontamination, linededup, mixing, prefix_trie, rules,
               substring as substrings, warc)
from .codes import vector_codes
from .decontaminate import decontaminate
from .fingerprints import fingerprints
from .linededup import line_dedup
from .mixing import mix_sources
from .nbsvm import quality
from .pii import personal_data
from .prefix_trie import conversation_trie
from .rules import quality_rules
from .secrets import scan_secrets
from .simhash import simhash_components
from .substring import substring_dedup
from .warc import warc_round_trip

#: Share of the largest possible entropy that the mix has at least.
MIX_ENTROPY = 0.998


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, and findings that the forest takes for none."""
    return scan_secrets(table(spark, sf_dir, "documents"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document as the labels mark it."""
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def warc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archives that it was written to."""
    return warc_round_trip(table(spark, sf_dir, "pages"))


def substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 13-word windows of earlier ones."""
    return substring_dedup(table(spark, sf_dir, "documents"), with_text=False).drop("kept_text")


def rules_with_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules of every document, and what common lines leave of it."""
    return quality_rules(table(spark, sf_dir, "documents"), with_text=False)


def pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return personal_data(table(spark, sf_dir, "documents")).drop("found")


def mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of a mix with nearly even sources."""
    return mix_sources(table(spark, sf_dir, "documents"), target_entropy=MIX_ENTROPY)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the three-line windows of earlier ones."""
    return line_dedup(table(spark, sf_dir, "documents"))


def benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words in every document."""
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                         width=10, slop=1).drop("n_near")


def simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document, two bits apart at most."""
    return simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def conversations_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return conversation_trie(table(spark, sf_dir, "conversations"))


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-128 fingerprint of every document, and its likeness to edited and next texts."""
    return fingerprints(table(spark, sf_dir, "documents"), shingle=5, k=128)


def codes_of_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code of every vector in eight codebooks of sixteen entries, six rounds."""
    return vector_codes(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6)


QUERIES = {
    "op1_secret_scan": secrets,
    "op2_quality_nbsvm": quality_scores,
    "op3_warc": warc_pages,
    "op4_substring_dedup": substring,
    "op5_quality_rules": rules_with_line_frequency,
    "op6_pii": pii,
    "op7_mix_sources": mixing_sources,
    "op8_line_dedup": lines,
    "op9_decontaminate": benchmark_hits,
    "op10_simhash_dedup": simhash_dedup,
    "op11_prefix_trie": conversations_trie,
    "op12_fingerprints": document_fingerprints,
    "op13_vector_codes": codes_of_vectors,
}

ORACLES = {
    "op3_warc": warc.ORACLE,
    "op4_substring_dedup": substrings.ORACLE,
    "op5_quality_rules": rules.ORACLE,
    "op7_mix_sources": mixing.oracle(MIX_ENTROPY),
    "op8_line_dedup": linededup.ORACLE,
    "op9_decontaminate": decontamination.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op13_vector_codes": codes.oracle(),
}
