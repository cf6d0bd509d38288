"""Mapped columns only, under their canonical names, values untouched."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def canonical_projection(
    raw: DataFrame, mapping: Mapping[str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """``mapping`` is source column -> canonical field; ``keep`` stays as it is."""
    present = [(s, c) for s, c in mapping.items() if s in raw.columns]
    return raw.select(
        *keep, *(F.col(f"`{source}`").alias(canonical) for source, canonical in present)
    )
