"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import decontamination, fertility, ngram_join, packing, suffix_dedup
from tallybook.llm.shared import stage, table

#: Bytes of a string that may stand in the corpus once. A passage of over 50 words is longer: 50
#: short words and their blanks are about 250 bytes.
REPEATED_BYTES = 240


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the bands of tokeniser fertility keep."""
    return fertility.kept_documents(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, similarity of 0.8 or more."""
    return ngram_join.one_of_each_group(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of strings of REPEATED_BYTES that also start elsewhere; all documents stay."""
    return suffix_dedup.without_repeats(docs, REPEATED_BYTES).withColumn("n_chars", F.char_length("text").cast("long"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2048 tokens."""
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Tokenizers have no SQL; the tests compare the pipeline with plain answers instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read back for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
