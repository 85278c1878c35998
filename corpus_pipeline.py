"""A corpus made ready for training, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from treeseek.llm import exact_dedup, mixing, packing, quality_rules, simhash
from treeseek.llm.queries import tokenizer_path
from treeseek.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules go."""
    return quality_rules.accepted(docs)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text stays."""
    return exact_dedup.deduplicate(docs).kept()


def keep_dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word similarity of 0.8 or more stays."""
    return simhash.one_of_similar(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source comes near its target: documents are left out or repeated."""
    return mixing.mix(docs).documents()


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of each document with their places in token windows."""
    return packing.pack(docs, tokenizer_path()).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", keep_good),
    ("exact dedup", keep_distinct),
    ("simhash near-dedup", keep_dissimilar),
    ("mixing to weights", mix_sources),
    ("packing", pack_windows),
]

# Fingerprints and tokens are beyond SQL; the stages are tested against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
