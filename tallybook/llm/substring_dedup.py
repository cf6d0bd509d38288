"""Repeated word windows, found by grouping them under anchors (see ``repeats``), in one step from half the length."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm import hashing as H
from tallybook.llm.repeats import Rule, merged, with_spans, words_as_units
from tallybook.llm.shared import TEXT, identified

WORDS = 50


def rule(words: int = WORDS) -> Rule:
    """An anchor is a window of half the words."""
    return Rule(size=words, anchor=max(1, words // 2), units=words_as_units, earlier_id=True)


def repeated_words(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` and ``_llm_spans``, the word ranges that windows of ``words`` words cover
    whose words also start in a document with a smaller doc_id.

    The window of half the length that stands for a full window (the least-hashed one in
    it) is its anchor. Only windows whose anchor is found in two documents are compared in
    full. A full window can repeat only if its anchor does, so nothing is lost.

    Words are separated by space and the characters from tab to carriage return and are
    compared unchanged. A null text has no words; a null doc_id counts as greater than
    all others; rows with the same doc_id never make each other's words repeats. An empty
    table gives an empty one. Other columns are kept. A text is one unit of work in
    memory, about 100 bytes for each of its bytes.
    """
    return with_spans(identified(docs), rule(words))


def kept_words(texts: pa.Array, spans: pa.Array):
    """Per row: number of words, covered words, and the other words joined by spaces (bytes)."""
    data, bounds = H.text_bytes(texts)
    flat = spans.flatten()
    begin, end = (flat.field(n).to_numpy(zero_copy_only=False) for n in range(2))
    at = spans.offsets.to_numpy() - spans.offsets[0].as_py()
    for i in range(len(texts)):
        text = data[bounds[i] : bounds[i + 1]].tobytes()
        words = text.split()  # bytes.split() splits at exactly space and tab to carriage return
        low, high = merged(begin[at[i] : at[i + 1]], end[at[i] : at[i + 1]])
        kept, place = [], 0
        for a, b in zip(low.tolist(), high.tolist(), strict=True):
            kept += words[place:a]
            place = b
        kept += words[place:]
        yield len(words), int(np.sum(high - low)), b" ".join(kept)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = list(kept_words(batch.column(TEXT), batch.column("_llm_spans")))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows], pa.string()),
            ],
            names=["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def removal_digests(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per document: doc_id, n_words, n_removed and the SHA-256 of the words that stay."""
    marked = repeated_words(docs.select(F.col("doc_id").cast("long").alias("doc_id"), TEXT), words)
    return marked.select("doc_id", TEXT, "_llm_spans").mapInArrow(
        _digests, "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [r[2].decode() for r in kept_words(batch.column(TEXT), batch.column("_llm_spans"))]
        place = batch.schema.get_field_index(TEXT)
        yield batch.set_column(place, pa.field(TEXT, pa.string()), pa.array(kept, pa.string())).drop_columns(["_llm_spans"])


def without_repeats(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` with the words that stay, joined by one space, as text."""
    marked = repeated_words(docs, words).select(*docs.columns, "_llm_spans")
    return marked.mapInArrow(_texts, marked.drop("_llm_spans").schema)
