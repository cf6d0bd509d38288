"""The identity of every arriving file: its SHA-256 and size, before anyone reads it."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.config import Engagement

READ_BYTES = 1 << 20
# A file up to this size is hashed as one value; a larger one is streamed.
WHOLE_FILE_BYTES = 256 << 20


def _stream_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash each listed file block by block, so that no file has to fit in memory."""
    from pyarrow import fs

    for batch in batches:
        digests = []
        for path in batch.column("path").to_pylist():
            system, inner = fs.FileSystem.from_uri(path)
            digest = hashlib.sha256()
            with system.open_input_stream(inner, buffer_size=READ_BYTES) as stream:
                while block := stream.read(READ_BYTES):
                    digest.update(block)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("path"), batch.column("length"), pa.array(digests, pa.string())],
            names=["path", "length", "sha256"],
        )


def file_digests(
    spark: SparkSession, path: str, whole_file_bytes: int = WHOLE_FILE_BYTES
) -> DataFrame:
    """path, length and sha256 of every file under ``path``, in parallel over files."""
    files = spark.read.format("binaryFile").load(path)
    small = files.where(F.col("length") <= whole_file_bytes).select(
        F.regexp_replace("path", "^file:/+", "file:///").alias("path"),
        "length",
        F.sha2("content", 256).alias("sha256"),
    )
    # The content column is pruned here, so large files are listed but not loaded.
    large = files.where(F.col("length") > whole_file_bytes).select(
        F.regexp_replace("path", "^file:/+", "file:///").alias("path"), "length"
    )
    spread = large.repartition("path")
    return small.unionByName(
        spread.mapInArrow(_stream_digests, "path string, length bigint, sha256 string")
    )


def source_manifest(
    spark: SparkSession, path: str, engagement: Engagement, audit: DataFrame | None = None
) -> DataFrame:
    """One row per file: identity, receipt time, engagement and, if audited, format."""
    files = file_digests(spark, path).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("filename"),
        "sha256",
        F.col("length").alias("byte_size"),
        F.current_timestamp().alias("received_at"),
        F.lit(engagement.provider).alias("provider"),
        F.lit(engagement.engagement).alias("engagement"),
        F.lit(engagement.period).alias("period"),
    )
    if audit is None:
        return files
    formats = audit.select(
        F.regexp_replace("source_path", "^file:/+", "file:///").alias("path"), "encoding", "delimiter"
    )
    return files.join(formats, "path", "left")
