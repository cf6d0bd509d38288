"""Header normalisation, similarity and the small pieces evidence is built of."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_header(header: Column) -> Column:
    """Lower case, without spaces, underscores and hyphens."""
    return F.lower(F.regexp_replace(header, r"[ _\-]+", ""))


def money_text(amount: Column) -> Column:
    """Two-place rendering, as every evidence sentence shows money."""
    return amount.cast("decimal(38,2)").cast("string")


def sentence(*parts: Column | str) -> Column:
    """Concatenate literals and columns into one evidence sentence."""
    return F.concat(
        *(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts)
    )


def plural(count: Column, noun: str) -> Column:
    return sentence(count, F.when(count == 1, f" {noun}").otherwise(f" {noun}s"))


# Longest term whose matching state fits one BIGINT with a spare carry bit.
MASK_BITS = 62


def letter_masks(term: Column) -> Column:
    """letter -> bits of the positions it holds in ``term`` (MASK_BITS at most)."""
    letters = F.split(term, "")
    places = F.sequence(F.lit(0), F.greatest(F.length(term) - 1, F.lit(0)))

    def mask(letter: Column) -> Column:
        bits = F.transform(
            F.filter(places, lambda i: F.get(letters, i) == letter),
            lambda i: F.call_function("shiftleft", F.lit(1).cast("bigint"), i),
        )
        return F.aggregate(bits, F.lit(0).cast("bigint"), lambda acc, bit: acc.bitwiseOR(bit))

    return F.map_from_entries(
        F.transform(F.array_distinct(letters), lambda ch: F.struct(ch, mask(ch)))
    )


def _subsequence_by_bits(text: Column, size: Column, masks: Column) -> Column:
    """Longest common subsequence, one bit-vector step per letter of ``text``."""
    full = F.call_function("shiftleft", F.lit(1).cast("bigint"), size) - F.lit(1).cast("bigint")

    def step(state: Column, letter: Column) -> Column:
        hit = state.bitwiseAND(F.coalesce(F.try_element_at(masks, letter), F.lit(0).cast("bigint")))
        return (state + hit).bitwiseOR(state - hit).bitwiseAND(full)

    left = F.aggregate(F.split(text, ""), full, step)
    return size - F.bit_count(left)


def _subsequence_by_rows(text: Column, term: Column) -> Column:
    """The same length by the textbook table, for terms longer than MASK_BITS."""
    letters = F.split(term, "")
    columns = F.sequence(F.lit(1), F.length(term))

    def next_row(above: Column, letter: Column) -> Column:
        def cell(row: Column, j: Column) -> Column:
            diagonal = F.get(above, j - 1) + (F.get(letters, j - 1) == letter).cast("int")
            best = F.greatest(diagonal, F.get(above, j), F.get(row, j - 1))
            return F.concat(row, F.array(best))

        return F.aggregate(columns, F.array(F.lit(0)), cell)

    start = F.array_repeat(F.lit(0), F.length(term) + 1)
    return F.element_at(F.aggregate(F.split(text, ""), start, next_row), -1)


def similarity(text: Column, term: Column, masks: Column) -> Column:
    """2 x common subsequence / total length: 1.0 for equal texts, 0.0 for disjoint.

    Only insertions and deletions count, so a substituted letter costs two.
    ``masks`` is ``letter_masks(term)``, or NULL for a long term.
    """
    size = F.length(term)
    common = (
        F.when((F.length(text) == 0) | (size == 0), F.lit(0))
        .when(masks.isNotNull(), _subsequence_by_bits(text, size, masks))
        .otherwise(_subsequence_by_rows(text, term))
    )
    total = F.length(text) + size
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * common / total)
