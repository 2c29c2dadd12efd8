"""The corpus pipeline over ``documents``.

quality classifier -> SimHash near-dedup -> substring dedup -> source mix -> BPE ids.

Each stage works on what its predecessor kept, written as Parquet and read
again. Null texts count as empty and are judged like any other; a document
whose words are all repeats of smaller doc_ids stays with an empty text; a
document that the mix takes twice stands twice. An empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barlake.llm import classifier, mixing, simhash, substrings, tokens, workers
from barlake.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (score of 0.3 or more)."""
    return classifier.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.3)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: 3-word shingles, 3 bits."""
    return simhash.keep_one(docs, width=3, radius=3)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 13-word windows that a smaller doc_id has."""
    return substrings.without_repeats(docs, width=13)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: weights 3, 1, 2 by source, 150 % of all words."""
    return mixing.mixed(docs, weights=(3, 1, 2), share=1.5)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the ids of the text (null text: empty)."""
    plain = docs.selectExpr("doc_id", "lang", "source", "coalesce(text, '') as text")
    return tokens.bpe_encode(plain, vocabulary()).selectExpr("doc_id", "lang", "source", "size(ids) as n_tokens", "ids")


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("bpe", bpe),
]

#: A trained classifier, SimHash components and BPE are beyond SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = workers.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
