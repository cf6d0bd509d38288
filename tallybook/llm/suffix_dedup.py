"""Repeated byte strings, found by grouping windows under anchors (see ``repeats``); no suffix is ordered."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm import hashing as H
from tallybook.llm.repeats import Rule, bytes_as_units, merged, with_spans
from tallybook.llm.shared import TEXT, identified

BYTES = 400
SPREAD = 100


def rule(size: int = BYTES) -> Rule:
    """An anchor is at most SPREAD shorter than a window, and at least half as long.

    The longer it is, the fewer windows share one by chance; the shorter, the fewer stretches there are.
    """
    return Rule(size=size, anchor=max(1, size // 2, size - SPREAD), units=bytes_as_units, earlier_id=False)


def repeated_bytes(docs: DataFrame, size: int = BYTES) -> DataFrame:
    """``docs`` and ``_llm_spans``, the byte ranges covered by strings of ``size`` UTF-8
    bytes that also start anywhere else, in the same document or another.

    Windows are grouped by their anchor, the least-hashed of the shorter
    strings in them; stretches of neighbouring windows under one anchor are compared as a whole, and
    single windows only for one stretch of each kind where stretches differ. Equal groups
    are exactly the repeated strings, up to a clash of two 64-bit hashes at once.

    A null text is empty. Rows that agree in doc_id and text are two places. An empty
    table gives an empty one. Other columns are kept. A text is one unit of work in
    memory, about 100 bytes for each of its bytes.
    """
    return with_spans(identified(docs), rule(size))


def kept_bytes(texts: pa.Array, spans: pa.Array):
    """Per row: the text's bytes, and begin and end of its removed runs."""
    data, bounds = H.text_bytes(texts)
    flat = spans.flatten()
    begin, end = (flat.field(n).to_numpy(zero_copy_only=False) for n in range(2))
    at = spans.offsets.to_numpy() - spans.offsets[0].as_py()
    for i in range(len(texts)):
        low, high = merged(begin[at[i] : at[i + 1]], end[at[i] : at[i + 1]])
        yield data[bounds[i] : bounds[i + 1]], low, high


def _without(text: np.ndarray, low: np.ndarray, high: np.ndarray) -> bytes:
    keep = np.ones(len(text), bool)
    for a, b in zip(low.tolist(), high.tolist(), strict=True):
        keep[a:b] = False
    return text[keep].tobytes()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, removed, spans, digests = [], [], [], []
        for text, low, high in kept_bytes(batch.column(TEXT), batch.column("_llm_spans")):
            sizes.append(len(text))
            removed.append(int(np.sum(high - low)))
            spans.append(len(low))
            digests.append(hashlib.sha256(_without(text, low, high) if len(low) else text).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(digests, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def removal_digests(docs: DataFrame, size: int = BYTES) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the bytes that stay."""
    marked = repeated_bytes(docs.select(F.col("doc_id").cast("long").alias("doc_id"), TEXT), size)
    return marked.select("doc_id", TEXT, "_llm_spans").mapInArrow(
        _digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for text, low, high in kept_bytes(batch.column(TEXT), batch.column("_llm_spans")):
            # A run that begins or ends inside a character leaves that character whole.
            tail = (text & 0xC0) == 0x80
            for n in range(len(low)):
                while low[n] < high[n] and tail[low[n]]:
                    low[n] += 1
                while low[n] < high[n] and high[n] < len(text) and tail[high[n]]:
                    high[n] -= 1
            kept.append(_without(text, low, high).decode())
        place = batch.schema.get_field_index(TEXT)
        yield batch.set_column(place, pa.field(TEXT, pa.string()), pa.array(kept, pa.string())).drop_columns(["_llm_spans"])


def without_repeats(docs: DataFrame, size: int = BYTES) -> DataFrame:
    """``docs`` with the repeated bytes cut out of the text; characters cut in two stay whole."""
    marked = repeated_bytes(docs, size).select(*docs.columns, "_llm_spans")
    return marked.mapInArrow(_texts, marked.drop("_llm_spans").schema)
