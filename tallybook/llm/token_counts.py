"""Token counts through a digest cache."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm.shared import TEXT, split_by_filter, stage
from tallybook.llm.vocabularies import in_use, vocabulary_digest, vocabulary_path

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
CACHE = "content string, vocabulary string, n_tokens long"


def content_digest() -> Column:
    """SHA-256 of the normalised content: null is the empty text, and nothing else may change,
    as the vocabularies tell all other texts apart."""
    return F.sha2(F.coalesce(F.col(TEXT), F.lit("")), 256)


def _counts(name: str):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = in_use(name)[0]
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                some = batch.slice(low, 1024)
                sizes = np.diff(known.encode_column(some.column(TEXT))[1])
                yield pa.RecordBatch.from_arrays([some.column("content"), pa.array(sizes)], names=["content", "n_tokens"])

    return emit


def read_cache(spark: SparkSession, path: str, version: str) -> DataFrame:
    """Stored counts of one vocabulary version, one row per content."""
    spark.createDataFrame([], CACHE).write.mode("append").parquet(path)  # so that it exists
    stored = spark.read.schema(CACHE).parquet(path).filter(F.col("vocabulary") == version)
    return stored.groupBy("content").agg(F.min("n_tokens").alias("n_tokens"))  # two runs may store the same


def update_cache(docs: DataFrame, cache: str, name: str = VOCABULARY) -> DataFrame:
    """Encode the distinct texts of ``docs`` whose digest the cache lacks, append their counts, and return the cache.

    Only digests move to find them. A text found once is encoded where it lies; of texts
    found several times one copy moves (a fixed-size filter tells the two kinds apart).
    """
    spark = docs.sparkSession
    version = vocabulary_digest(name)
    texts = docs.select(F.coalesce(TEXT, F.lit("")).alias(TEXT)).withColumn("content", content_digest())
    stored = read_cache(spark, cache, version)
    found = texts.groupBy("content").agg(F.count(F.lit(1)).alias("n")).join(stored, "content", "left")
    settled = stage(
        found.filter(F.col("n_tokens").isNotNull() | (F.col("n") > 1)).select("content", F.col("n_tokens").isNull().alias("missing")),
        "settled",
    )
    key = F.xxhash64("content")
    maybe, once = split_by_filter(texts, key, settled, key)
    # Of those the filter holds back: texts that are neither stored nor repeated, and one copy of repeated ones.
    held = maybe.join(settled, "content", "left").filter(F.coalesce("missing", F.lit(True))).select("content", TEXT)
    distinct = held.groupBy("content").agg(F.first(TEXT).alias(TEXT))
    missing = once.select("content", TEXT).unionByName(distinct)
    fresh = missing.mapInArrow(_counts(vocabulary_path(name)), "content string, n_tokens long")
    fresh.select("content", F.lit(version).alias("vocabulary"), "n_tokens").write.mode("append").parquet(cache)
    return read_cache(spark, cache, version)


def token_counts(docs: DataFrame, cache: str, name: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens).

    Tokens are those of every whole text under the vocabulary file ``name``, without any
    added special tokens; a null text is empty. Counts come from the cache, a Parquet
    folder that this call brings up to date; they are kept per digest of the text and
    digest of the vocabulary file, so a changed text or vocabulary never meets an old
    count. Columns of these three names are replaced, others are kept; an empty table
    gives an empty one and leaves the cache as it is.
    """
    counts = update_cache(docs, cache, name)
    old = [c for c in docs.columns if c in ("n_bytes", "n_tokens", "over_limit")]
    keyed = docs.drop(*old).withColumns(
        {"_llm_content": content_digest(), "n_bytes": F.coalesce(F.octet_length(TEXT), F.lit(0)).cast("long")}
    )
    counts = stage(counts.select(F.col("content").alias("_llm_content"), "n_tokens"), "counts")  # so that hot texts' joins split
    return (
        keyed.join(counts, "_llm_content", "left")
        .withColumn("over_limit", F.col("n_tokens") > limit)
        .drop("_llm_content")
    )
