"""Benchmark decontamination: short test items inside long documents.

An item is found in a document if the document has at least a share ``threshold`` of the
item's distinct word shingles. A document that does so lacks few enough of them to have
one of the item's least-hashed ``m``, where m is one more than it may lack. So the
MinHash signature of an item is its m least shingle hashes, with m taken from the largest
item of its size partition; documents are searched for them whole, since a signature of
a long document would forget the short items in it. Then nothing is missed, and exact
containment settles each candidate.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm import hashing as H
from tallybook.llm.shared import DIGEST, KEY, RANK, TEXT, identified, stage, without

SHINGLE = 5
THRESHOLD = 0.8
#: Items are searched for in blocks of about this many shingles; a block is broadcast.
BLOCK_SHINGLES = 1_000_000
_COARSE_BITS = 20

#: Words are of letters and digits; every byte beyond ASCII counts as a letter.
_GAP = np.array([not (c >= 128 or chr(c).isalnum()) for c in range(256)])

_WORD = re.compile(r"(?:[0-9A-Za-z]|[^\x00-\x7f])+")


def lowered_shingles(column: pa.Array, size: int, shorter: tuple[int, ...] = ()):
    """Per chunk of texts in lower case: first row, rows, and hash and row of every shingle.

    ``shorter`` are lengths of further windows. A hash depends on the number of words,
    so windows of one length never match those of another.
    """
    data, bounds = H.text_bytes(pc.utf8_lower(column))
    for i, j in H.chunks(bounds):
        hashes, _, _, first = H.words(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i], gap=_GAP)
        every = [H.shingles(hashes, first, n) for n in (size, *shorter)]
        yield i, j - i, *map(np.concatenate, zip(*every, strict=True))


def _item_sets(size: int):
    kinds = pa.schema([("item_id", pa.int64()), ("digest", pa.int64()), ("hashes", pa.list_(pa.int64())), ("n_short", pa.int32())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, rows, found, row in lowered_shingles(batch.column(TEXT), size):
                flat, bounds = H.distinct_sets(found, row, rows)
                sets = np.split(H.signed(flat), bounds[1:-1])
                digest = [int(H.signed(H.mix(np.array([x.view(np.uint64).sum(), len(x)], np.uint64)))[0]) for x in sets]
                ids = batch.column("item_id").slice(i, rows)
                words = [len(_WORD.findall(x)) for x in pc.utf8_lower(batch.column(TEXT).slice(i, rows)).to_pylist()]
                short = [n if n < size else 0 for n in words]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(digest, pa.int64()), pa.array(sets, pa.list_(pa.int64())), pa.array(short, pa.int32())], schema=kinds
                )

    return emit


def item_sets(items: DataFrame, size: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """Staged distinct shingle sets of the items, and the ids of every set that more than one item has."""
    number = F.coalesce(F.col("item_id").cast("long"), F.lit(-1)).alias("item_id")
    texts = items.select(number, F.coalesce(TEXT, F.lit("")).alias(TEXT))
    sets = stage(texts.mapInArrow(_item_sets(size), "item_id long, digest long, hashes array<long>, n_short int").filter(F.size("hashes") > 0), "sets")
    same = sets.groupBy("digest", "hashes", "n_short").agg(F.min("item_id").alias("item_id"), F.count(F.lit(1)).alias("n_items"))
    same = stage(same, "items")
    shared = sets.select("digest", "item_id").join(same.filter("n_items > 1").select("digest"), "digest", "left_semi")
    return same, stage(shared.distinct(), "members")


@dataclass(frozen=True)
class Block:
    """Item sets laid out for search: sorted distinct hashes, and per hash the items that have it."""

    ids: np.ndarray
    digests: np.ndarray
    sizes: np.ndarray
    needed: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    items: np.ndarray
    #: The hashes of all signatures, and which of their high bits occur.
    sketched: np.ndarray
    coarse: np.ndarray
    #: The numbers of words of items shorter than a shingle.
    shorter: tuple[int, ...]


def least_shared(size: int, threshold: float) -> int:
    """The fewest shared shingles that reach the threshold, free of rounding."""
    return max(1, int(np.ceil(np.round(threshold * size, 9))))


def block_of(rows: list, threshold: float) -> Block:
    sets = [np.array(r.hashes, np.int64).view(np.uint64) for r in rows]
    sizes = np.array([len(x) for x in sets], np.int64)
    needed = np.array([least_shared(int(n), threshold) for n in sizes], np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(sets)), sizes)
    # Size partitions by powers of two; a signature has the length its largest item needs.
    partition = np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64)
    longest = np.zeros(partition.max(initial=0) + 1, np.int64)
    np.maximum.at(longest, partition, sizes - needed + 1)
    rank = np.concatenate([np.arange(n) for n in sizes]) if sets else np.zeros(0, np.int64)  # sets are sorted
    sketched = rank < longest[partition[item]]
    order = np.argsort(flat, kind="stable")
    hashes, first = np.unique(flat[order], return_index=True)
    least = np.unique(flat[sketched])
    coarse = np.zeros(1 << _COARSE_BITS, bool)
    coarse[(least >> np.uint64(64 - _COARSE_BITS)).astype(np.int64)] = True
    shorter = tuple(sorted({r.n_short for r in rows} - {0}))
    ids, digests = (np.array([r[c] for r in rows], np.int64) for c in ("item_id", "digest"))
    return Block(ids, digests, sizes, needed, hashes, np.append(first, len(flat)), item[order], least, coarse, shorter)


def _among(sorted_hashes: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes are among the sorted ones, and where."""
    place = np.minimum(np.searchsorted(sorted_hashes, found), max(0, len(sorted_hashes) - 1))
    return (sorted_hashes[place] == found if len(sorted_hashes) else np.zeros(len(found), bool)), place


def _contained(block, size: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: Block = block.value
        for batch in batches:
            for i, rows, found, row in lowered_shingles(batch.column(TEXT), size, b.shorter):
                # Signatures alone choose the documents; only theirs are compared in full.
                near = np.flatnonzero(b.coarse[(found >> np.uint64(64 - _COARSE_BITS)).astype(np.int64)])
                chosen = np.zeros(rows, bool)
                chosen[row[near[_among(b.sketched, found[near])[0]]]] = True
                found, row = found[chosen[row]], row[chosen[row]]
                hit, place = _among(b.hashes, found)
                pairs = np.unique((row[hit] << 32) | place[hit])
                row, place = pairs >> 32, pairs & 0xFFFFFFFF
                many = b.first[place + 1] - b.first[place]
                at = np.repeat(b.first[place], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                pair = (np.repeat(row, many) << 32) | b.items[at]
                pair, shared = np.unique(pair, return_counts=True)
                item = pair & 0xFFFFFFFF
                kept = shared >= b.needed[item]
                item, rows = item[kept], pa.array((pair[kept] >> 32) + i)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(rows) for c in ("doc_id", *KEY)),
                        pa.array(b.ids[item]),
                        pa.array(b.digests[item]),
                        pa.array(b.sizes[item]),
                        pa.array(shared[kept].astype(np.int64)),
                    ],
                    names=["doc_id", *KEY, "item_id", "digest", "n_shingles", "n_shared"],
                )

    return emit


def _found_sets(docs: DataFrame, sets: DataFrame, threshold: float, size: int) -> DataFrame:
    """Rows (doc_id, key, item_id, digest, n_shingles, n_shared): the staged sets found in documents."""
    spark = docs.sparkSession
    total = sets.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0)).alias("n")).first().n
    blocks = max(1, -(-total // BLOCK_SHINGLES))
    texts = identified(docs.select(F.col("doc_id").cast("long").alias("doc_id"), TEXT)).select("doc_id", *KEY, TEXT)
    schema = f"doc_id long, {RANK} long, {DIGEST} long, item_id long, digest long, n_shingles long, n_shared long"
    found = None
    for n in range(blocks):
        rows = sets.filter(F.pmod("digest", F.lit(blocks)) == n).collect()  # about BLOCK_SHINGLES hashes
        block = spark.sparkContext.broadcast(block_of(rows, threshold))
        some = texts.mapInArrow(_contained(block, size), schema)
        found = some if found is None else found.unionByName(some)
    return found


def containments(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """Rows (doc_id, key, item_id, n_shingles, n_shared, containment) of all items found in documents.

    Words are runs of letters and digits in lower case; an item or document with fewer
    words than a shingle has all its words as one. Such an item is found wherever its
    words follow each other, in longer documents too. An item without words is never found,
    a document without words has none. Items with equal shingle sets are searched for
    once and reported each; a null item_id is -1, and an item that is there twice under
    one id is one. Repeated documents are reported each. The items are the stated queries
    of a search against all documents: they are broadcast in blocks of bounded size, and
    the documents are read once per block.
    """
    sets, members = item_sets(items, size)
    found = _found_sets(docs, sets, threshold, size)
    others = members.withColumnRenamed("item_id", "_llm_member")
    each = found.join(others, "digest", "left").withColumn("item_id", F.coalesce("_llm_member", "item_id"))
    columns = ("doc_id", *KEY, "item_id", "n_shingles", "n_shared")
    return each.select(*columns, (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


def clean_documents(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """The rows of ``docs`` in which no item is found."""
    found = _found_sets(docs, item_sets(items, size)[0], threshold, size)
    return without(docs, stage(found.select(*KEY).distinct(), "contaminated"))
