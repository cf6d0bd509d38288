"""Toxicity by cumulative-link ordinal regression on sparse text features.

A text's severity grade is 0, 1, ... K. One weight per feature is shared by all grades:
P(grade >= k) = sigmoid(score - threshold k), with thresholds in ascending order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm import hashing as H
from tallybook.llm.shared import DIGEST, RANK, TEXT, identified, stage

#: The fit looks at this many labelled documents at most, those with the least key hashes.
SAMPLE_ROWS = 20_000
#: Features kept for the regression, those that tell the classes apart best.
FEATURES = 4_000
#: A feature counts only if this many sampled documents have it.
LEAST_DOCUMENTS = 4
#: Besides whole words, beginnings of words of so many bytes are features.
BEGINNINGS = (4, 5, 6, 7, 8)
GRADES = 3
#: A text is called toxic if its probability of any grade over 0 is at least this.
TOXIC_FROM = 0.25

#: Words are of letters and digits; every byte beyond ASCII counts as a letter.
_GAP = np.ones(256, bool)
_GAP[128:] = False
for _range in ((ord("0"), ord("9")), (ord("A"), ord("Z")), (ord("a"), ord("z"))):
    _GAP[_range[0] : _range[1] + 1] = False


def features(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk of texts: first row, words per row, and (row in chunk, hash) of every feature that occurs."""
    data, bounds = H.text_bytes(column)
    data = H.LOWER[data]
    for i, j in H.chunks(bounds):
        part, edges = data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
        start, end, first = H.word_spans(part, edges, _GAP)
        hasher = H.Hasher(H.byte_units(part))
        row = np.repeat(np.arange(j - i), np.diff(first))
        found, rows = [hasher.ranges(start, end)], [row]
        for size in BEGINNINGS:
            longer = end - start > size
            found.append(H.mix(hasher.ranges(start[longer], start[longer] + size)))
            rows.append(row[longer])
        yield i, np.diff(first), np.concatenate(rows), np.concatenate(found)


@dataclass(frozen=True)
class Model:
    """Sorted feature hashes, their weights, and the thresholds between grades."""

    hashes: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) per score and k = 1 .. K."""
        tails = 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds, -40, 40)))
        return np.where(np.isinf(self.thresholds), 0.0, tails)


def known(hashes: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``found`` are among the sorted ``hashes``, and where."""
    if not len(hashes):
        return np.zeros(len(found), bool), np.zeros(len(found), np.int64)
    place = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
    return hashes[place] == found, place


def weight_of(count: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Value of a feature found ``count`` times in a text of ``words`` words: its share of the words, dampened."""
    return np.sqrt(100.0 * count / np.maximum(words, 20))


def fit(
    row: np.ndarray,
    feature: np.ndarray,
    value: np.ndarray,
    grade: np.ndarray,
    hashes: np.ndarray,
    grades: int = GRADES,
    steps: int = 400,
    ridge: float = 1e-4,
) -> Model:
    """Maximum likelihood with a ridge penalty, by Adam over all sampled rows at once."""
    rows, size = len(grade), len(hashes)
    weights, first, gaps = np.zeros(size), np.array([1.0]), np.zeros(grades - 1)
    state = [weights, first, gaps]
    moment = [(np.zeros_like(x), np.zeros_like(x)) for x in state]
    for step in range(1, steps + 1):
        thresholds = first[0] + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        score = np.bincount(row, value * weights[feature], minlength=rows)
        p = 1 / (1 + np.exp(-np.clip(score[:, None] - thresholds, -40, 40)))
        # P(grade = g) is the difference of neighbouring tails
        tail = np.concatenate([np.ones((rows, 1)), p, np.zeros((rows, 1))], axis=1)
        mass = np.maximum(np.take_along_axis(tail, grade[:, None], 1) - np.take_along_axis(tail, grade[:, None] + 1, 1), 1e-12)
        slope = p * (1 - p)
        level = np.arange(1, grades + 1)
        sign = (level == grade[:, None]).astype(float) - (level == grade[:, None] + 1)
        by_tail = -sign * slope / mass / rows
        by_score = by_tail.sum(axis=1)
        by_threshold = -by_tail.sum(axis=0)
        above = np.cumsum(by_threshold[::-1])[::-1]
        slopes = [
            np.bincount(feature, value * by_score[row], minlength=size) + ridge * weights,
            above[:1],
            above[1:] * np.exp(gaps),
        ]
        for x, g, (m, v) in zip(state, slopes, moment, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(hashes, weights, first[0] + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Staged texts of at most ``rows`` labelled documents, taken by the hash of their key; repeated rows are one."""
    marked = labels.select(F.col("doc_id").cast("long").alias(RANK), F.col("toxic").cast("int").alias("toxic")).dropna()
    marked = marked.groupBy(RANK).agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64(RANK), RANK).limit(rows)
    keyed = identified(docs.select("doc_id", TEXT)).select(RANK, DIGEST, TEXT)
    chosen = (
        keyed.drop(TEXT)
        .join(F.broadcast(marked), RANK)  # at most ``rows`` rows
        .distinct()
        .orderBy(F.xxhash64(RANK, DIGEST), RANK, DIGEST)
        .limit(rows)
    )
    found = keyed.join(F.broadcast(stage(chosen, "chosen")), [RANK, DIGEST]).dropDuplicates([RANK, DIGEST])
    return stage(found.select(TEXT, (F.col("toxic") > 0).cast("int").alias("toxic")), "labelled")


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic = batch.column("toxic").to_numpy()
        for i, _, row, found in features(batch.column(TEXT)):
            distinct, bounds = H.distinct_sets(found, row, int(row.max(initial=-1)) + 1)
            marks = np.repeat(toxic[i : i + len(bounds) - 1], np.diff(bounds))
            key, place = np.unique(distinct, return_inverse=True)
            yield pa.RecordBatch.from_pydict(
                {
                    "feature": H.signed(key),
                    "n": np.bincount(place, minlength=len(key)).astype(np.int64),
                    "toxic": np.bincount(place, marks, minlength=len(key)).astype(np.int64),
                }
            )


def _chosen_counts(hashes: np.ndarray):
    kinds = pa.schema(
        [("toxic", pa.int32()), ("words", pa.int64()), ("features", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))]
    )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_numpy()
            for i, words, row, found in features(batch.column(TEXT)):
                hit, place = known(hashes, found)
                pair, count = np.unique(row[hit] * max(1, len(hashes)) + place[hit], return_counts=True)
                rows = pair // max(1, len(hashes))
                cut = np.searchsorted(rows, np.arange(1, len(words)))
                yield pa.RecordBatch.from_pydict(
                    {
                        "toxic": toxic[i : i + len(words)],
                        "words": words,
                        "features": np.split((pair % max(1, len(hashes))).astype(np.int32), cut),
                        "counts": np.split(count.astype(np.int32), cut),
                    },
                    kinds,
                )

    return emit


def trained(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, grades: int = GRADES) -> Model:
    """The model fitted on a bounded sample of labelled documents.

    Labels only say toxic or not. Grade 0 is not toxic; toxic documents are graded 1 to
    ``grades`` by quantiles of the share of their words that carry features found mostly
    in toxic documents.
    """
    found = sample(docs, labels, rows)
    counts = found.mapInArrow(_document_counts, "feature long, n long, toxic long").groupBy("feature")
    counts = counts.agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).filter(F.col("n") >= LEAST_DOCUMENTS)
    total = found.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    if not total.toxic or total.toxic == total.n:
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.full(grades, np.inf))
    share = total.toxic / total.n
    expected = F.col("n") * share
    surprise = (F.col("toxic") - expected) ** 2 / (expected * (1 - share))
    best = counts.orderBy(surprise.desc(), "feature").limit(FEATURES).collect()
    hashes = np.array([r.feature for r in best], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    mostly = np.array([r.toxic > 0.6 * r.n for r in best], bool)[order]
    hashes = hashes[order]

    rows_found = found.mapInArrow(
        _chosen_counts(hashes), "toxic int, words long, features array<int>, counts array<int>"
    ).collect()  # at most ``rows`` rows
    size = [len(r.features) for r in rows_found]
    row = np.repeat(np.arange(len(size)), size)
    feature = np.array([x for r in rows_found for x in r.features], np.int64)
    count = np.array([x for r in rows_found for x in r.counts], np.float64)
    words = np.array([r.words for r in rows_found], np.float64)
    toxic = np.array([r.toxic for r in rows_found], np.int64)
    marked = np.bincount(row[mostly[feature]], count[mostly[feature]], minlength=len(size)) / np.maximum(words, 1)
    bounds = np.quantile(marked[toxic > 0], np.arange(1, grades) / grades)
    grade = np.where(toxic > 0, 1 + np.searchsorted(bounds, marked, side="left"), 0)
    return fit(row, feature, weight_of(count, words[row]), grade, hashes, grades)


def _scored(model, toxic_from: float):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_model: Model = model.value
        for batch in batches:
            for i, words, row, found in features(batch.column(TEXT)):
                hit, place = known(known_model.hashes, found)
                size = max(1, len(known_model.hashes))
                pair, count = np.unique(row[hit] * size + place[hit], return_counts=True)
                at = pair // size
                value = weight_of(count, words[at])
                score = np.bincount(at, value * known_model.weights[pair % size], minlength=len(words))
                tails = known_model.at_least(score)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(i, len(words)) for c in batch.schema.names if c != TEXT),
                        pa.array(tails.sum(axis=1)),
                        pa.array((tails >= 0.5).sum(axis=1).astype(np.int32)),
                        pa.array(tails[:, 0]),
                        pa.array(tails[:, 0] >= toxic_from),
                    ],
                    names=[*(c for c in batch.schema.names if c != TEXT), "severity", "grade", "p_toxic", "is_toxic"],
                )

    return emit


def severity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, toxic_from: float = TOXIC_FROM) -> DataFrame:
    """Per document: doc_id, severity (expected grade), grade (the highest with P >= 0.5), p_toxic, is_toxic.

    Every whole text is scored; a null or empty text has no features, as has one without
    letters and digits. Labels with a null id or mark are left out; of several marks for
    one doc_id the worst counts. Without any toxic and any other label all severities
    are 0. Repeated rows are scored each; an empty table gives an empty one; columns
    other than doc_id and text are not looked at.
    """
    model = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(TEXT, F.lit("")).alias(TEXT))
    schema = "doc_id long, severity double, grade int, p_toxic double, is_toxic boolean"
    return texts.mapInArrow(_scored(model, toxic_from), schema)
