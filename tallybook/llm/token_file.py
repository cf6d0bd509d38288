"""Token-id output: one canonical Huffman code for the corpus, in blocks that decode alone.

A token file is a folder: ``codebook`` has each id's code length, ``segments`` the ids of
consecutive documents as bits, with the bit offset of every block of 256 ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybook.llm import huffman
from tallybook.llm.shared import DIGEST, RANK, TEXT, identified, stage
from tallybook.llm.vocabularies import id_bytes, in_use, vocabulary_path
from tallybook.workspace import new_path

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
#: A segment is closed once it has this many ids; it holds whole documents.
SEGMENT_IDS = 1 << 18

_SEGMENTS = (
    "start long, n_tokens long, doc_ids array<bigint>, doc_tokens array<bigint>, checkpoints array<bigint>, bits binary"
)


def _encoded(name: str, end_id: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, before, known = TaskContext.get().partitionId(), 0, 0, in_use(name)[0]
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                some = batch.slice(low, 256)
                ids, firsts = known.encode_ended(some.column(TEXT), end_id)
                rows, sizes = some.num_rows, np.diff(firsts)
                ends = before + np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(rows, part, np.int64)),
                        pa.array(np.arange(place, place + rows, dtype=np.int64)),
                        pa.array(ends - sizes),
                        some.column("doc_id"),
                        pa.array(sizes),
                        id_bytes(ids, firsts),
                    ],
                    names=["part", "place", "before", "doc_id", "n_tokens", "ids"],
                )
                place, before = place + rows, int(ends[-1])

    return emit


def encoded_in_order(docs: DataFrame, name: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Staged ids in ascending doc_id order (ties by text digest, a null id last).

    ``part`` is the range a document is in, ``place`` and ``before`` the documents and ids before it there.
    """
    ordered = (
        identified(docs.select(F.col("doc_id").cast("long").alias("doc_id"), TEXT))
        .repartitionByRange(RANK, DIGEST)
        .sortWithinPartitions(RANK, DIGEST)
    )
    schema = "part long, place long, before long, doc_id long, n_tokens long, ids binary"
    return stage(ordered.select("doc_id", TEXT).mapInArrow(_encoded(vocabulary_path(name), end_id), schema), "ids")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for low in range(0, batch.num_rows, 1024):
            ids = np.frombuffer(b"".join(batch.column(0).slice(low, 1024).to_pylist()), "<u4")
            found = np.bincount(ids, minlength=len(total))
            found[: len(total)] += total
            total = found
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"id": used, "n": total[used]})


def id_counts(encoded: DataFrame) -> DataFrame:
    """How often each id occurs in the whole corpus; one row per id of the vocabulary."""
    return encoded.select("ids").mapInArrow(_counted, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _segments(lengths: np.ndarray):
    def close(docs: list) -> dict:
        joined = np.frombuffer(b"".join(d[2] for d in docs), "<u4")
        bits, checkpoints = huffman.encode(joined, huffman.canonical_codes(lengths), lengths)
        return {
            "start": [docs[0][0]],
            "n_tokens": [len(joined)],
            "doc_ids": [[d[1] for d in docs]],
            "doc_tokens": [[len(d[2]) // 4 for d in docs]],
            "checkpoints": [checkpoints],
            "bits": [bits],
        }

    kinds = pa.schema(
        [("start", pa.int64()), ("n_tokens", pa.int64())]
        + [(x, pa.list_(pa.int64())) for x in ("doc_ids", "doc_tokens", "checkpoints")]
        + [("bits", pa.binary())]
    )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, size, after = [], 0, None
        for batch in batches:
            for part, place, start, doc_id, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if docs and ((part, place) != after or size >= SEGMENT_IDS):
                    yield pa.RecordBatch.from_pydict(close(docs), kinds)
                    docs, size = [], 0
                docs.append((start, doc_id, ids))
                size += len(ids) // 4
                after = (part, place + 1)
        if docs:
            yield pa.RecordBatch.from_pydict(close(docs), kinds)

    return emit


def write_token_file(docs: DataFrame, path: str, name: str = VOCABULARY, end_id: int = END_ID, max_bits: int = huffman.MAX_BITS):
    """Encode every whole text of ``docs`` and write a token file.

    Each document is followed by ``end_id``; a null text is empty. Documents are in
    ascending doc_id order by ``start``, the number of ids before them; equal ids are
    ordered by a digest of the text, a null id comes last. An empty table gives a file
    without segments. Columns other than doc_id and text are not looked at.

    The driver sees one count per id of the vocabulary and makes the code from them. The
    ids move once, with the sort. A lost task writes its part anew.
    """
    spark = docs.sparkSession
    encoded = encoded_in_order(docs, name, end_id)
    found = id_counts(encoded).collect()  # at most one row per id
    counts = np.zeros(1 + max((r.id for r in found), default=0), np.int64)
    for row in found:
        counts[row.id] = row.n
    lengths = huffman.code_lengths(counts, max_bits)
    book = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(book, "id long, bits int").coalesce(1).write.parquet(f"{path}/codebook")

    sizes = encoded.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    firsts = sizes.select("part", F.coalesce(before, F.lit(0)).alias("first"))  # one row per task
    rows = encoded.join(F.broadcast(firsts), "part").select("part", "place", (F.col("first") + F.col("before")).alias("start"), "doc_id", "ids")
    rows.mapInArrow(_segments(lengths), _SEGMENTS).sortWithinPartitions("start").write.parquet(f"{path}/segments")


def _decoded(lengths: np.ndarray):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = huffman.decoding_table(lengths)
        for batch in batches:
            for row in range(batch.num_rows):
                start, count, doc_ids, sizes, checkpoints, bits = (c[row] for c in batch.columns)
                data = huffman.decode(bits.as_py(), checkpoints.values.to_numpy(), count.as_py(), table).astype("<u4").tobytes()
                sizes = sizes.values.to_numpy()
                ends = np.cumsum(sizes)
                begins = ends - sizes
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.values,
                        pa.array(start.as_py() + begins),
                        pa.array(sizes),
                        pa.array([data[a:b] for a, b in zip((begins * 4).tolist(), (ends * 4).tolist(), strict=True)], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return emit


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) of every document of a token file."""
    book = spark.read.schema("id long, bits int").parquet(f"{path}/codebook").collect()  # one row per id
    lengths = np.zeros(1 + max((r.id for r in book), default=0), np.uint8)
    for row in book:
        lengths[row.id] = row.bits
    segments = spark.read.schema(_SEGMENTS).parquet(f"{path}/segments")
    return segments.mapInArrow(_decoded(lengths), "doc_id long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, name: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Write a token file in the shared folder and return, from it, each document's place and ids."""
    path = new_path(docs.sparkSession, "tokens")
    write_token_file(docs, path, name, end_id)
    return read_token_file(docs.sparkSession, path)
