"""One severity scale and one materiality test for every control."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def tolerance_literal(tolerance: Decimal | Column) -> Column:
    return tolerance if isinstance(tolerance, Column) else F.lit(tolerance).cast("decimal(38,2)")


def above_materiality(value: Column, tolerance: Decimal | Column) -> Column:
    """Strictly above: a difference equal to the tolerance is not material."""
    return value > tolerance_literal(tolerance)


def severity(
    value: Column,
    tolerance: Decimal | Column,
    *,
    unbalanced_journal: bool | Column = False,
    affects_balance: bool | Column = True,
) -> Column:
    """HIGH, else MEDIUM where a balance moves, else LOW. First match wins."""
    unbalanced = F.lit(unbalanced_journal) if isinstance(unbalanced_journal, bool) else unbalanced_journal
    affects = F.lit(affects_balance) if isinstance(affects_balance, bool) else affects_balance
    return (
        F.when(unbalanced | above_materiality(value, tolerance), "HIGH")
        .when(affects, "MEDIUM")
        .otherwise("LOW")
    )
