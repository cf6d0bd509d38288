"""Best-two-fit packing of documents into sequences of bounded length.

A packing is decided on lengths alone, and there are only as many lengths as a sequence
has tokens: the plan is made on one count per length and says how many sequences hold
which lengths. Documents of one length are alike, so the n-th piece of a length takes
the n-th place of that length in the plan. Only the ranks need the data, and they come
from counts per task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallybook.llm.shared import TEXT, stage
from tallybook.llm.vocabularies import id_bytes, in_use, vocabulary_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 0
CAPACITY = 2048


def best_two_fit(counts: np.ndarray) -> list[tuple[int, list[int]]]:
    """The plan for ``counts[length]`` pieces: (number of sequences, their lengths).

    Each sequence is filled greedily, longest piece first and then the longest that still
    fits; then its smallest piece is replaced by the two unpacked pieces that fit the gap
    it leaves best, if they fill it better. As long as the pieces last, the next
    sequence would come out the same, so it is repeated at once.
    """
    left = counts.astype(np.int64).copy()
    capacity = len(left) - 1
    plan = []
    while True:
        there = np.flatnonzero(left)
        if not len(there):
            return plan
        taken: dict[int, int] = {}
        gap, filled = capacity, []
        while gap:
            fits = there[: np.searchsorted(there, gap, side="right")][::-1]
            # the longest length that fits and is not used up by this sequence
            pick = next((int(x) for x in fits if left[x] > taken.get(int(x), 0)), 0)
            if not pick:
                break
            many = min(gap // pick, int(left[pick]) - taken.get(pick, 0))
            filled += [pick] * many
            taken[pick] = taken.get(pick, 0) + many
            gap -= pick * many
        if gap and filled:
            pair = _tightest_pair(left, taken, filled[-1], filled[-1] + gap)
            if pair:
                taken[filled[-1]] -= 1
                filled.pop()
                for x in pair:
                    filled.append(x)
                    taken[x] = taken.get(x, 0) + 1
        times = min(int(left[x]) // n for x, n in taken.items() if n)
        for x, n in taken.items():
            left[x] -= n * times
        plan.append((times, filled))


def _tightest_pair(left: np.ndarray, taken: dict[int, int], above: int, most: int) -> tuple[int, int] | None:
    """Two free lengths whose sum is greatest, over ``above`` and at most ``most``."""
    free = left[: most + 1].copy()
    for x, n in taken.items():
        if x <= most:
            free[x] -= n
    lengths = np.flatnonzero(free > 0)
    if not len(lengths):
        return None
    place = np.searchsorted(lengths, most - lengths, side="right") - 1
    # The same length twice needs two pieces of it; else the next shorter one is taken.
    same = (place >= 0) & (lengths[place] == lengths) & (free[lengths] < 2)
    place = np.where(same, place - 1, place)
    sums = np.where(place >= 0, lengths + lengths[place], -1)
    best = int(np.argmax(sums))
    if sums[best] <= above:
        return None
    a, b = int(lengths[best]), int(lengths[place[best]])
    return max(a, b), min(a, b)


def _pieces(name: str, end_id: int, capacity: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, known = TaskContext.get().partitionId(), in_use(name)[0]
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                some = batch.slice(low, 1024)
                ids, firsts = known.encode_ended(some.column(TEXT), end_id)
                many = -(-np.diff(firsts) // capacity)
                rows = np.repeat(np.arange(len(many)), many)
                piece = np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many)
                edges = np.r_[firsts[rows] + piece * capacity, len(ids)]
                length = np.diff(edges)
                # the piece's number among those of its length in this task
                order = np.argsort(length, kind="stable")
                count = np.bincount(length, minlength=capacity + 1)
                heads = np.cumsum(count) - count
                rank = np.empty(len(length), np.int64)
                rank[order] = np.arange(len(length)) - heads[length[order]] + seen[length[order]]
                seen += count
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("doc_id").take(pa.array(rows)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(piece * capacity),
                        pa.array(length),
                        id_bytes(ids, edges),
                        pa.array(np.full(len(rows), part, np.int64)),
                        pa.array(rank),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids", "part", "rank"],
                )

    return emit


def pieces(docs: DataFrame, name: str = VOCABULARY, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """Staged pieces with their ids; ``rank`` numbers a task's pieces of one length, ``part`` is the task."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(TEXT, F.lit("")).alias(TEXT))
    schema = "doc_id long, piece int, start long, length long, ids binary, part long, rank long"
    return stage(texts.mapInArrow(_pieces(vocabulary_path(name), end_id, capacity), schema), "pieces")


def _places(plan: list[tuple[int, list[int]]], capacity: int):
    """Per length, in order: first rank, first sequence and offset of every place kind of the plan."""
    by_length: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]
    ranks, sequence = [0] * (capacity + 1), 0
    for times, lengths in plan:
        offset = 0
        for x in lengths:
            by_length[x].append((ranks[x], sequence, offset))
            ranks[x] += times
            offset += x
        sequence += times
    return [np.array(x, np.int64).reshape(-1, 3) for x in by_length]


def _placed(places):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = places.value
        for batch in batches:
            length, rank = (batch.column(x).to_numpy() for x in ("length", "rank"))
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for x in np.unique(length):
                mine = np.flatnonzero(length == x)
                first, begin, at = kinds[x].T
                kind = np.searchsorted(first, rank[mine], side="right") - 1
                sequence[mine] = begin[kind] + rank[mine] - first[kind]
                offset[mine] = at[kind]
            rest = batch.drop_columns(["rank"])
            yield rest.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return emit


def packed(docs: DataFrame, name: str = VOCABULARY, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and ``end_id``; a null text is empty, so its document is one
    token long. Documents longer than ``capacity`` are cut into pieces of that length,
    the last one may be shorter; no other document is cut. ``offset`` is the place in the
    sequence, without gaps from 0. Repeated rows are packed each; an empty table gives an
    empty one; columns other than doc_id and text are not looked at.

    The driver makes the plan from one count per length. A hot length is only a count:
    pieces are ranked within their task, and the tasks' counts are summed up per length.
    Ids move only if ``sequences`` is asked for.
    """
    return placed(pieces(docs, name, end_id, capacity), capacity)


def sequences(docs: DataFrame, name: str = VOCABULARY, end_id: int = END_ID, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences: sequence_id, n_tokens, ids (little-endian unsigned 32-bit) and doc_ids in order."""
    rows = placed(pieces(docs, name, end_id, capacity), capacity, with_ids=True)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id", "length")))  # one sequence's pieces
    return (
        rows.groupBy("sequence_id")
        .agg(parts.alias("parts"))
        .select(
            "sequence_id",
            F.aggregate("parts.length", F.lit(0).cast("long"), lambda a, x: a + x).alias("n_tokens"),
            F.unhex(F.array_join(F.transform("parts.ids", F.hex), "")).alias("ids"),
            F.col("parts.doc_id").alias("doc_ids"),
        )
    )


def placed(cut: DataFrame, capacity: int, with_ids: bool = False) -> DataFrame:
    """The staged pieces with their place; their ids too if asked for."""
    per_task = stage(cut.groupBy("length", "part").agg((F.max("rank") + 1).alias("n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row per length
        counts[row.length] = row.n
    places = cut.sparkSession.sparkContext.broadcast(_places(best_two_fit(counts), capacity))
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = per_task.select("length", "part", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    slim = cut.withColumn("ids_crc32", F.crc32("ids")).select(*kept, "part", "rank")
    ranked = slim.join(offsets, ["length", "part"]).select(*kept, (F.col("rank") + F.col("earlier")).alias("rank"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    schema += ", ids binary" * with_ids + ", sequence_id long, offset long"
    return ranked.mapInArrow(_placed(places), schema)
