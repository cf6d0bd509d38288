"""Row identity, staged tables and bounded membership filters of the operators."""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.workspace import new_path

#: Stands for a missing doc_id: it sorts after every other and equals itself in joins.
NO_ID = (1 << 63) - 1
#: Bits of a membership filter: 8 MB, whatever the number of keys. A full filter lets all rows
#: pass, so it saves work and never decides a result.
FILTER_BITS = 26
_BLOCK_BITS = 15

ID, TEXT, RANK, DIGEST = "doc_id", "text", "_llm_id", "_llm_digest"
KEY = (RANK, DIGEST)


#: Paths staged so far by the innermost function that ``leaves_one``.
_staged: ContextVar[list[str] | None] = ContextVar("_staged", default=None)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, the size is known."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    if (paths := _staged.get()) is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def leaves_one(build: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For a function that ends in staging its result: the tables staged on the way are deleted then.

    Nothing reads them any more, as the result is written. They would fill the disk until the session ends.
    """

    @wraps(build)
    def run(*args, **kwargs) -> DataFrame:
        outer, own = _staged.get(), []
        token = _staged.set(own)
        try:
            result = build(*args, **kwargs)
        finally:
            _staged.reset(token)
        spark = result.sparkSession
        for name in own[:-1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        if outer is not None:
            outer.extend(own[-1:])
        return result

    return run


def identified(docs: DataFrame) -> DataFrame:
    """``docs`` with a text that is never null and a key: doc_id and a digest of the text.

    Rows that agree in both are the same document twice and get the same answers.
    """
    text = F.coalesce(F.col(TEXT), F.lit(""))
    return docs.withColumns(
        {TEXT: text, RANK: F.coalesce(F.col(ID).cast("long"), F.lit(NO_ID)), DIGEST: F.xxhash64(text)}
    )


def _slots(keys: DataFrame, key: Column) -> DataFrame:
    slot = key.bitwiseAND((1 << FILTER_BITS) - 1)
    return (
        keys.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", _BLOCK_BITS).alias("_llm_block"))
        .agg(F.bitmap_construct_agg(F.col("slot").bitwiseAND((1 << _BLOCK_BITS) - 1)).alias("_llm_bits"))
    )


def task_filter(keys: DataFrame, column: str):
    """A broadcast bitmap of hashed keys for use inside tasks; see ``passes``.

    A key's low bits are its slot. High bits would not do for keys that are minima of hashes.
    """
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    width = 1 << (_BLOCK_BITS - 3)
    for row in _slots(keys, F.col(column)).collect():  # at most 2048 rows of 4 KB
        bits[row[0] * width : (row[0] + 1) * width] = np.frombuffer(row[1], np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bits)


def passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which unsigned 64-bit keys may be in the filter."""
    slot = keys & np.uint64((1 << FILTER_BITS) - 1)
    return (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def split_by_filter(df: DataFrame, key: Column, keys: DataFrame, keys_key: Column) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be among ``keys``, and rows whose key is surely not.

    The filter is a broadcast table of at most 2048 rows of 4 KB; the rows of ``df`` do
    not move. ``keys`` should be a staged table, as both results read it.
    """
    slot = key.bitwiseAND((1 << FILTER_BITS) - 1)
    place = slot.bitwiseAND((1 << _BLOCK_BITS) - 1)
    byte = F.conv(F.hex(F.substring(F.col("_llm_bits"), F.shiftright(place, 3).cast("int") + 1, F.lit(1))), 16, 10)
    marked = (
        df.withColumns({"_llm_place": place, "_llm_block": F.shiftright(slot, _BLOCK_BITS)})
        .join(F.broadcast(_slots(keys, keys_key)), "_llm_block", "left")
        .withColumn("_llm_byte", F.coalesce(byte.cast("int"), F.lit(0)))
    )
    hit = F.expr("(shiftright(_llm_byte, cast(_llm_place & 7 as int)) & 1) = 1")
    extra = ("_llm_place", "_llm_block", "_llm_bits", "_llm_byte")
    return marked.filter(hit).drop(*extra), marked.filter(~hit).drop(*extra)


def document_key() -> Column:
    return F.xxhash64(RANK, DIGEST)


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is not among the staged keys ``rejected``.

    Rows that the filter lets through stay where they are; only the others are joined.
    """
    keyed = docs.withColumn("_llm_text", F.col(TEXT))
    near, far = split_by_filter(identified(keyed), document_key(), rejected, document_key())
    left = near.join(rejected, list(KEY), "left_anti").unionByName(far)
    return left.withColumn(TEXT, F.col("_llm_text")).select(*docs.columns)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
