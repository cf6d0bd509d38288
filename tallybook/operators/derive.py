"""Deriving one population from another, and named expectations over them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.errors import ExpectationError
from tallybook.operators.totals import zero


def derive_summary(detail: DataFrame, chart: DataFrame, entity: str) -> DataFrame:
    """Closing = opening + debits - credits for every chart account, moved or not.

    ``chart`` holds account_code, account_name and opening_balance.
    """
    moved = detail.groupBy("account_code").agg(
        F.sum("debit").alias("period_debits"), F.sum("credit").alias("period_credits")
    )
    money = "decimal(28,2)"
    return (
        chart.join(moved, "account_code", "left")
        .withColumns(
            {
                "period_debits": F.coalesce("period_debits", zero()).cast(money),
                "period_credits": F.coalesce("period_credits", zero()).cast(money),
            }
        )
        .select(
            F.lit(entity).alias("entity"),
            "account_code",
            "account_name",
            F.col("opening_balance").cast(money).alias("opening_balance"),
            "period_debits",
            "period_credits",
            (F.col("opening_balance") + F.col("period_debits") - F.col("period_credits"))
            .cast(money)
            .alias("closing_balance"),
        )
    )


def expand_journals(journals: DataFrame) -> DataFrame:
    """Nested journals to lines: line_no counts from 1 within each journal.

    ``journals`` holds entity, journal_id, posting_date and
    entries: array<struct<account_code, description, debit, credit>>.
    """
    kept = [c for c in journals.columns if c != "entries"]
    return journals.select(*kept, F.posexplode("entries").alias("_at", "_entry")).select(
        *kept,
        (F.col("_at") + 1).cast("bigint").alias("line_no"),
        "_entry.account_code",
        "_entry.description",
        F.col("_entry.debit").cast("decimal(28,2)").alias("debit"),
        F.col("_entry.credit").cast("decimal(28,2)").alias("credit"),
    )


def is_two_sided() -> Column:
    """True where a line does not carry exactly one positive side."""
    debit_only = (F.col("debit") > 0) & (F.col("credit") == 0)
    credit_only = (F.col("credit") > 0) & (F.col("debit") == 0)
    return ~(debit_only | credit_only)


def two_sided_lines(detail: DataFrame) -> DataFrame:
    return detail.where(is_two_sided())


@dataclass(frozen=True)
class Expectation:
    """A named check: ``measured`` has one row and one column called ``actual``."""

    check_id: str
    statement: str
    expected: str
    measured: DataFrame


def expectation_suite(checks: Sequence[Expectation]) -> DataFrame:
    """One row per check: whether it held, what was expected and what was found."""
    rows = [
        check.measured.select(
            F.lit(check.check_id).alias("check_id"),
            F.lit(check.statement).alias("statement"),
            F.coalesce(F.col("actual").cast("string") == F.lit(check.expected), F.lit(False)).alias("ok"),
            F.lit(check.expected).alias("expected"),
            F.col("actual").cast("string").alias("actual"),
        )
        for check in checks
    ]
    suite = rows[0]
    for row in rows[1:]:
        suite = suite.unionByName(row)
    return suite


def require(suite: DataFrame) -> None:
    """Stop before anything is written if a check failed."""
    failed = suite.where(~F.col("ok")).select("check_id", "expected", "actual").collect()
    if failed:
        raise ExpectationError(
            "; ".join(f"{r.check_id}: expected {r.expected}, found {r.actual}" for r in failed)
        )
