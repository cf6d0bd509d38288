"""Which windows of ``size`` units (bytes or words) occur more than once in a corpus.

Windows are not moved one by one. Every window has an anchor, the least-hashed of the
shorter windows inside it. It depends on the window's content alone, so equal windows
have equal anchors, and neighbouring windows mostly share one: a *run* is a stretch of
window starts with the same anchor. The passes over the texts are

1. ``anchor_counts``: count anchors; those found once settle their runs (no repeat);
2. ``candidate_runs``: runs under repeated anchors, with a hash of all units they span.
   Runs with equal spans repeat as a whole;
3. ``candidate_windows``: single windows, only for one run per distinct span and only
   under anchors with several distinct spans, that is around the edges of passages.

Every count is an aggregation with map-side combining, every look-up a join that can be
split under a hot key. Documents move only if they have windows to look at (a fixed-size
filter tells which), each of the last two passes reads the input again instead of
keeping it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm import hashing as H
from tallybook.llm.shared import (
    DIGEST,
    KEY,
    RANK,
    TEXT,
    document_key,
    leaves_one,
    passes,
    split_by_filter,
    stage,
    task_filter,
)
from tallybook.llm.vocabularies import in_use

#: units of a run of texts: hashes of the units and the first unit of every row
Units = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]

ANCHOR, SPAN = "_llm_anchor", "_llm_span"
_PLACE = np.uint64((1 << 32) - 1)


def bytes_as_units(data: np.ndarray, bounds: np.ndarray):
    return H.byte_units(data), bounds


def words_as_units(data: np.ndarray, bounds: np.ndarray):
    hashes, _, _, first = H.words(data, bounds)
    return hashes, first


@dataclass(frozen=True)
class Rule:
    """What makes a window of ``size`` units a repeat.

    ``earlier_id``: only if it also starts in a document with a smaller doc_id;
    otherwise if it also starts anywhere else, the same document included.
    """

    size: int
    anchor: int
    units: Units
    earlier_id: bool

    def stats(self) -> list[Column]:
        """Per key: how often, and the least and greatest doc_id."""
        if self.earlier_id:
            return [F.min(RANK).alias("_llm_low"), F.max(RANK).alias("_llm_high")]
        return [F.count(F.lit(1)).alias("_llm_n")]

    def repeated(self) -> Column:
        """Of a key: some occurrence is a repeat."""
        return F.col("_llm_low") < F.col("_llm_high") if self.earlier_id else F.col("_llm_n") > 1

    def repeat(self) -> Column:
        """Of an occurrence joined with its key's figures: it is a repeat itself."""
        return F.col(RANK) > F.col("_llm_low") if self.earlier_id else F.col("_llm_n") > 1


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    size = 1
    rows = len(values) - width + 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:rows], values[width - size : width - size + rows])


def runs(units: np.ndarray, first: np.ndarray, rule: Rule, hasher: H.Hasher):
    """Row, first start, last start and anchor hash of every run."""
    empty = np.zeros(0, np.int64)
    if len(units) < rule.size:
        return empty, empty, empty, empty.astype(np.uint64)
    short = hasher.windows(rule.anchor)
    place = np.arange(len(short), dtype=np.uint64)
    least = _least((short & ~_PLACE) | place, rule.size - rule.anchor + 1)
    length = np.diff(first)
    row = np.repeat(np.arange(len(length)), length)[: len(least)]
    fits = np.arange(len(least)) + rule.size <= first[row + 1]
    change = np.ones(len(least), bool)
    change[1:] = (least[1:] != least[:-1]) | (row[1:] != row[:-1])
    start = np.flatnonzero(change & fits)
    after = np.append(np.flatnonzero(change), len(least))
    last = np.minimum(after[np.searchsorted(after, start, side="right")], first[row[start] + 1] - rule.size + 1) - 1
    return row[start], start, last, short[(least[start] & _PLACE).astype(np.int64)]


def _text_runs(batch: pa.RecordBatch, rule: Rule):
    """Per chunk of a batch: its first row, its hasher, first units and runs."""
    data, bounds = H.text_bytes(batch.column(TEXT))
    for i, j in H.chunks(bounds):
        units, first = rule.units(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
        hasher = H.Hasher(units)
        yield i, hasher, first, runs(units, first, rule, hasher)


def _anchors(rule: Rule):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_use()
        for batch in batches:
            ids = batch.column(RANK).to_numpy(zero_copy_only=False)
            for i, _, _, (row, _, _, anchor) in _text_runs(batch, rule):
                yield pa.RecordBatch.from_pydict({RANK: ids[i + row], ANCHOR: H.signed(anchor)})

    return emit


def anchor_counts(docs: DataFrame, rule: Rule) -> DataFrame:
    """Anchors that may head repeated windows."""
    rows = docs.select(RANK, TEXT).mapInArrow(_anchors(rule), f"{RANK} long, {ANCHOR} long")
    return rows.groupBy(ANCHOR).agg(*rule.stats()).filter(rule.repeated()).select(ANCHOR)


def _candidates(rule: Rule, wanted):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_use()
        for batch in batches:
            ids, digests = (batch.column(c).to_numpy(zero_copy_only=False) for c in KEY)
            for i, hasher, first, (row, start, last, anchor) in _text_runs(batch, rule):
                hit = passes(wanted.value, anchor)
                row, start, last, anchor = row[hit], start[hit], last[hit], anchor[hit]
                yield pa.RecordBatch.from_pydict(
                    {
                        RANK: ids[i + row],
                        DIGEST: digests[i + row],
                        "start": start - first[row],
                        "length": last - start + 1,
                        ANCHOR: H.signed(anchor),
                        SPAN: H.signed(hasher.ranges(start, last + rule.size)),
                    }
                )

    return emit


def candidate_runs(docs: DataFrame, rule: Rule, wanted) -> DataFrame:
    schema = f"{RANK} long, {DIGEST} long, start long, length long, {ANCHOR} long, {SPAN} long"
    return docs.select(*KEY, TEXT).mapInArrow(_candidates(rule, wanted), schema)


def classified(candidates: DataFrame, rule: Rule) -> DataFrame:
    """Candidate runs with ``whole`` (all its windows repeat) and ``look`` (its windows are to be compared)."""
    # The figures are staged before they are joined, so that each join can be split under a hot key.
    head = F.struct(*KEY, "start")
    spans = stage(candidates.groupBy(ANCHOR, SPAN).agg(*rule.stats(), F.min(head).alias("_llm_head")), "spans")
    several = stage(spans.groupBy(ANCHOR).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(ANCHOR), "several")
    spans = stage(spans.join(several.withColumn("_llm_several", F.lit(True)), ANCHOR, "left"), "spans")
    chosen = F.col(RANK) == F.col("_llm_low") if rule.earlier_id else head == F.col("_llm_head")
    look = F.coalesce("_llm_several", F.lit(False)) & chosen
    marked = candidates.join(spans, [ANCHOR, SPAN]).withColumns({"whole": rule.repeat(), "look": look})
    return marked.filter("whole or look").select(*KEY, "start", "length", ANCHOR, "whole", "look")


def _windows(rule: Rule):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_use()
        for batch in batches:
            data, bounds = H.text_bytes(batch.column(TEXT))
            ids, digests = (batch.column(c).to_numpy(zero_copy_only=False) for c in KEY)
            looks = batch.column("looks")
            flat = looks.flatten()
            start, length, anchor = (flat.field(n).to_numpy(zero_copy_only=False) for n in range(3))
            at = looks.offsets.to_numpy() - looks.offsets[0].as_py()
            for i, j in H.chunks(bounds):
                units, first = rule.units(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
                hasher = H.Hasher(units)
                run = slice(at[i], at[j])
                row = np.repeat(np.arange(j - i), np.diff(at[i : j + 1]))
                n = length[run]
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                begin = np.repeat(start[run], n) + step
                row, heads = np.repeat(row, n), np.repeat(anchor[run], n)
                place = first[row] + begin
                yield pa.RecordBatch.from_pydict(
                    {
                        RANK: ids[i + row],
                        DIGEST: digests[i + row],
                        "start": begin,
                        ANCHOR: heads,
                        SPAN: H.signed(hasher.ranges(place, place + rule.size)),
                    }
                )

    return emit


def candidate_windows(docs: DataFrame, looks: DataFrame, rule: Rule) -> DataFrame:
    """The single windows of the runs to look at. ``looks`` is staged."""
    near, _ = split_by_filter(docs.select(*KEY, TEXT), document_key(), looks, document_key())
    lists = looks.groupBy(*KEY).agg(F.collect_set(F.struct("start", "length", ANCHOR)).alias("looks"))
    schema = f"{RANK} long, {DIGEST} long, start long, {ANCHOR} long, {SPAN} long"
    return near.join(lists, list(KEY)).select(*KEY, TEXT, "looks").mapInArrow(_windows(rule), schema)


@leaves_one
def repeated_starts(docs: DataFrame, rule: Rule) -> DataFrame:
    """Staged rows (key, start, length): windows starting at ``start .. start + length - 1`` are repeats.

    ``docs`` has passed ``identified``. The rows of one document may touch, not overlap.
    """
    heads = stage(anchor_counts(docs, rule), "anchors")
    wanted = task_filter(heads, ANCHOR)
    runs_found = stage(candidate_runs(docs, rule, wanted), "runs")
    marked = stage(classified(runs_found, rule), "marked")
    looks = stage(marked.filter("look").select(*KEY, "start", "length", ANCHOR), "looks")
    windows = stage(candidate_windows(docs, looks, rule), "windows")
    figures = stage(windows.groupBy(ANCHOR, SPAN).agg(*rule.stats()).filter(rule.repeated()), "figures")
    singles = windows.join(figures, [ANCHOR, SPAN]).filter(rule.repeat())
    whole = marked.filter("whole").select(*KEY, "start", "length")
    return stage(whole.unionByName(singles.select(*KEY, "start", F.lit(1).cast("long").alias("length"))), "repeats")


def with_spans(docs: DataFrame, rule: Rule) -> DataFrame:
    """``docs`` as ``identified`` gives it, and ``_llm_spans``: its maximal covered stretches in order.

    A span is (begin, end) in units. Documents without any do not move.
    """
    starts = repeated_starts(docs, rule)
    covered = F.array_sort(
        F.collect_set(F.struct(F.col("start").alias("begin"), (F.col("start") + F.col("length") + rule.size - 1).alias("end")))
    )
    spans = starts.groupBy(*KEY).agg(covered.alias("_llm_spans"))
    near, far = split_by_filter(docs, document_key(), starts, document_key())
    kind = "array<struct<begin:bigint,end:bigint>>"
    return (
        near.join(spans, list(KEY), "left")
        .withColumn("_llm_spans", F.coalesce("_llm_spans", F.array().cast(kind)))
        .unionByName(far.withColumn("_llm_spans", F.array().cast(kind)))
    )


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of stretches given in order of their begin; touching ones become one."""
    if not len(begin):
        return begin, end
    reach = np.maximum.accumulate(end)
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    return begin[heads], reach[np.append(heads[1:], len(begin)) - 1]

