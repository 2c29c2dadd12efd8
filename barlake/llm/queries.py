"""The registered queries of the operators: thin digests over ``barlake.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import (chat, classifier, idfiles, mixing, neighbours, outliers, packing, pages, phrases, simhash, substrings,
                         tokens, whitening)
from barlake.llm.oracle import ORACLE  # noqa: F401


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix takes every document: weights 3, 1, 2 by source, 150 % of all words."""
    got = mixing.mix_report(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5)
    return got.select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth one."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0, top=10)


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without 13-word windows that a smaller doc_id has."""
    return substrings.removal_report(table(spark, sf_dir, "documents"), width=13)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, 3 bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, radius=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that says control strings, formatted as prefix trees and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    return chat.formatted_digests(rows.unionByName(added))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    return pages.main_texts(table(spark, sf_dir, "pages"))


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through BPE encoding and decoding."""
    return tokens.bpe_digests(table(spark, sf_dir, "documents"), vocabulary())


def op8_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics of every document and whether it is kept."""
    return outliers.quality_outliers(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score; labels of the held-out fold are not used."""
    docs = table(spark, sf_dir, "documents")
    scored = classifier.scored(docs, classifier.train(docs, table(spark, sf_dir, "labels")), columns=["doc_id"])
    return scored.select(F.col("row.doc_id").alias("doc_id"), classifier.held_out(F.col("row.doc_id")).alias("held_out"),
                         "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op10_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written to seekable files and read back."""
    return idfiles.read_digests(idfiles.write_ids(table(spark, sf_dir, "documents"), vocabulary()))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of each language."""
    return phrases.collocations(table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the first 16 whitened components."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"), top=16)


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2,048 tokens, each window filled with its seed's lexical neighbours."""
    return packing.packed(table(spark, sf_dir, "documents"), vocabulary(), end_id=1, window=2048)


QUERIES = {
    "op1_mix": op1_mix,
    "op2_neighbours": op2_neighbours,
    "op3_substrings": op3_substrings,
    "op4_simhash": op4_simhash,
    "op5_chat": op5_chat,
    "op6_main_text": op6_main_text,
    "op7_bpe_codec": op7_bpe_codec,
    "op8_outliers": op8_outliers,
    "op9_quality": op9_quality,
    "op10_id_files": op10_id_files,
    "op11_phrases": op11_phrases,
    "op12_whitening": op12_whitening,
    "op13_packing": op13_packing,
}
