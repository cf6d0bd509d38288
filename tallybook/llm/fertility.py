"""Quality rules on tokeniser fertility: how well public vocabularies fit a text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm import hashing as H
from tallybook.llm.shared import DIGEST, KEY, RANK, TEXT, identified, leaves_one, stage, without
from tallybook.llm.vocabularies import in_use, vocabulary_path

#: The first one also measures byte fallback and token entropy.
VOCABULARIES = ("piece_bpe_32k.model", "byte_bpe_50k.json")
#: A band reaches so many robust standard deviations to either side of a language's median ...
WIDTH = 4.0
#: ... which count as this at least: a share of the median, and bits of entropy.
LEAST_SHARE, LEAST_BITS = 0.01, 0.1
#: Few texts say little about their language: with n of them a band is 1 + SMALL / n times as wide.
SMALL = 20
#: Byte fallback up to this share is never a reason to reject.
FREE_FALLBACK = 0.05

_BLANK = " \t\n\v\f\r"
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Measures with bands, in thousandths, so that counts of their values give exact medians.
MEASURES = ("chars_per_token", "chars_per_token_2", "byte_share", "entropy")
_STACKED = ", ".join(f"'{x}', {x}" for x in MEASURES)


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _repeat_words(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words per row in windows of three that the row has twice or more."""
    length = np.diff(first)
    row = np.repeat(np.arange(len(length)), length)
    start = np.flatnonzero(np.arange(len(hashes)) + 3 <= first[row + 1]) if len(hashes) else np.zeros(0, np.int64)
    window, at = H.Hasher(hashes).ranges(start, start + 3), row[start]
    order = np.lexsort((window, at))
    same = (window[order][1:] == window[order][:-1]) & (at[order][1:] == at[order][:-1])
    again = np.zeros(len(start), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(hashes) + 3, np.int64)
    np.add.at(covered, start[again], 1)
    np.add.at(covered, start[again] + 3, -1)
    return _per_row(np.cumsum(covered)[: len(hashes)] > 0, first)


def _dup_lines(text: str) -> int:
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(_BLANK)]
    return len(lines) - len(set(lines))


def base_figures(texts: pa.Array) -> dict[str, np.ndarray]:
    data, bounds = H.text_bytes(texts)
    out = {name: np.zeros(len(texts), np.int64) for name in BASE}
    for i, j in H.chunks(bounds):
        part, edges = data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]
        hashes, _, _, first = H.words(part, edges)
        out["n_words"][i:j] = np.diff(first)
        out["word_chars"][i:j] = _per_row(((part & 0xC0) != 0x80) & ~H.GAP[part], edges)
        out["n_symbols"][i:j] = _per_row(_SYMBOL[part], edges)
        out["n_repeat_words"][i:j] = _repeat_words(hashes, first)
    out["n_dup_lines"][:] = [_dup_lines(x) for x in texts.to_pylist()]
    return out


def _entropy(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Entropy in bits of each row's ids."""
    size = np.diff(bounds)
    row = np.repeat(np.arange(len(size)), size)
    pairs = np.sort((row << 32) | ids)
    heads = np.flatnonzero(np.diff(pairs, prepend=-1))
    count = np.diff(np.append(heads, len(pairs)))
    at = pairs[heads] >> 32
    total = np.bincount(at, count * np.log2(count), minlength=len(size))
    n = np.maximum(size, 1)
    return np.log2(n) - total / n


def fertility(texts: pa.Array, names: tuple[str, ...]) -> dict[str, np.ndarray]:
    """Per whole text and vocabulary: tokens; of the first one also byte-fallback tokens and entropy."""
    tokens = []
    for n, known in enumerate(in_use(*names)):
        ids, firsts = known.encode_column(texts)
        tokens.append(np.diff(firsts))
        if not n:
            fallback = _per_row(known.fallback()[ids], firsts)
            entropy = _entropy(ids.astype(np.int64), firsts)
    return {"tokens": tokens, "fallback": fallback, "entropy": entropy}


def _measured(names: tuple[str, ...]):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                some = batch.slice(low, 1024)
                base = base_figures(some.column(TEXT))
                found = fertility(some.column(TEXT), names)
                n = [np.maximum(x, 1) for x in found["tokens"]]
                thousandths = [
                    1000 * base["word_chars"] / n[0],
                    1000 * base["word_chars"] / n[1],
                    1000 * found["fallback"] / n[0],
                    1000 * found["entropy"],
                ]
                kept = [c for c in some.schema.names if c != TEXT]
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(c) for c in kept), *(pa.array(base[c]) for c in BASE)]
                    + [pa.array(np.rint(np.round(x, 6)).astype(np.int64)) for x in thousandths],
                    names=[*kept, *BASE, *MEASURES],
                )

    return emit


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def measures(docs: DataFrame, names: tuple[str, ...] = VOCABULARIES, language: str = "lang") -> DataFrame:
    """Staged figures of every document: doc_id, key, language, the base figures and the measures in thousandths."""
    lang = F.coalesce(F.col(language), F.lit("")) if language in docs.columns else F.lit("")
    slim = identified(docs.select(F.col("doc_id").cast("long").alias("doc_id"), TEXT, lang.alias("_llm_lang")))
    schema = f"doc_id long, {RANK} long, {DIGEST} long, _llm_lang string, "
    schema += ", ".join(f"{x} long" for x in (*BASE, *MEASURES))
    paths = tuple(map(vocabulary_path, names))
    rows = slim.select("doc_id", *KEY, "_llm_lang", TEXT).mapInArrow(_measured(paths), schema)
    return stage(rows.withColumn("base_failed", base_failed()), "measures")


def distinct_texts(figures: DataFrame) -> DataFrame:
    """One row per language and text that passes the base rules, so that copies have no weight in a band."""
    return figures.filter(~F.col("base_failed")).select("_llm_lang", DIGEST, *MEASURES).distinct()


def bands(figures: DataFrame) -> DataFrame:
    """Staged limits in thousandths: one row per language, with a low and a high of every measure."""
    values = distinct_texts(figures).select("_llm_lang", F.expr(f"stack({len(MEASURES)}, {_STACKED}) as (measure, value)"))
    counts = values.groupBy("_llm_lang", "measure", "value").agg(F.count(F.lit(1)).alias("n"))
    quartiles = counts.groupBy("_llm_lang", "measure").agg(F.expr("percentile(value, array(0.25D, 0.5D, 0.75D), n)").alias("q"), F.sum("n").alias("texts"))
    low, middle, high = (F.col("q")[i] for i in range(3))
    least = F.when(F.col("measure") == "entropy", 1000 * LEAST_BITS).otherwise(LEAST_SHARE * middle)
    spread = WIDTH * (1 + SMALL / F.col("texts")) * F.greatest((high - low) / 1.349, least)
    limits = quartiles.select("_llm_lang", "measure", (middle - spread).alias("low"), (middle + spread).alias("high"))
    sides = []
    for measure in MEASURES:
        for side in ("low", "high"):
            of_measure = F.max(F.when(F.col("measure") == measure, F.col(side)))
            if measure == "byte_share":
                of_measure = F.lit(0.0) if side == "low" else F.greatest(of_measure, F.lit(1000 * FREE_FALLBACK))
            elif measure == "entropy" and side == "high":
                of_measure = F.lit(float("inf"))
            sides.append(of_measure.alias(f"_llm_{side}_{measure}"))
    return stage(limits.groupBy("_llm_lang").agg(*sides), "bands")


def judged(figures: DataFrame) -> DataFrame:
    """``figures`` with ``kept``; a language without limits has no document that passes the base rules."""
    kept = ~F.col("base_failed")
    for x in MEASURES:
        kept = kept & F.col(x).between(F.col(f"_llm_low_{x}"), F.col(f"_llm_high_{x}"))
    limited = figures.join(bands(figures), "_llm_lang", "left")
    return limited.select(*figures.columns, F.coalesce(kept, F.lit(False)).alias("kept"))


def quality(docs: DataFrame, names: tuple[str, ...] = VOCABULARIES, language: str = "lang") -> DataFrame:
    """Per document: its base figures, the measures, base_failed and kept.

    Measures: characters per token under each vocabulary, the share of tokens that are
    single bytes for want of a better one (line breaks and tabs aside), and the entropy of
    the tokens, of the whole text; its characters are those of words, which are separated
    by space and the characters from tab to carriage return. A document that passes the base rules is rejected if a measure lies outside its
    language's band: the median of all distinct passing texts of the language, and so many
    robust standard deviations to either side, more with few texts (byte share: above only; entropy: below
    only). Medians and quartiles are exact, over counts of values in thousandths; a text
    counts once for its language, however many copies there are. Every language has bands
    of its own, whatever their number.

    A null or empty text has no words and fails the base rules; a null language is one
    like others; without a language column all documents share one band. Repeated rows
    are judged each; an empty table gives an empty one.
    """
    return judged(measures(docs, names, language))


@leaves_one
def _rejected(docs: DataFrame, names: tuple[str, ...], language: str) -> DataFrame:
    return stage(quality(docs, names, language).filter(~F.col("kept")).select(*KEY).distinct(), "rejected")


def kept_documents(docs: DataFrame, names: tuple[str, ...] = VOCABULARIES, language: str = "lang") -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps."""
    return without(docs, _rejected(docs, names, language))
