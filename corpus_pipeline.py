"""From raw documents to a training mix: ``run(spark, sf_dir)`` applies ``STAGES`` in order.

Every stage takes what the one before it kept, written as Parquet below the session's shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kindred.llm import decontaminate, mixing, quality, secret_scan, simhash
from kindred.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the rules learn from the labels of these documents.

    Null, empty and short texts go; rows alike in their text get the same verdict; no rows give none.
    """
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge_quality(docs, model, keep=[*docs.columns]).filter("kept").select(docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates.

    Texts without a word are one group, nulls among them; of a group the row with the smallest id stays, and of
    several with that id one of them.
    """
    return simhash.keep_first(docs, distance=3, words_per_shingle=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. Null and empty texts have none and stay, as do repeated rows."""
    found = decontaminate.find_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.filter(F.size("matches") == 0).select(docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced and their number of characters as it then is; null texts stay null."""
    return secret_scan.redact_secrets(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, whole, each with its ``size`` in words, the ``source_size`` and ``target`` of
    its source, and ``taken``, the number of words that the mix takes of it; more than ``size`` where it repeats.

    Documents without words are not taken. Null sources are one source; each of several equal rows has its own place.
    """
    return mixing.mix_sources(docs, keep=docs.columns).filter("taken > 0")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("mixing_sources", mix_to_weights),
]

# Forests, fingerprints and automata are not SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
