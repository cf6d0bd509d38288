"""Per-account and per-journal totals, and the first line's entity.

All of it combines on the map side: a journal or account holding a third of all
lines reaches the shuffle as one row per task. All sums keep fixed-width buffers (hash
aggregates); the first line's entity is picked from the small result of the accounts,
and looked up by row index for the few journals that need it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zero() -> Column:
    return F.lit(0).cast("decimal(38,2)")


def signed_amount(detail: DataFrame) -> DataFrame:
    """Each line with its amount (debit plus credit) and movement (debit less credit)."""
    return detail.withColumns(
        {
            "amount": (F.col("debit") + F.col("credit")).cast("decimal(38,2)"),
            "movement": (F.col("debit") - F.col("credit")).cast("decimal(38,2)"),
        }
    )


def account_totals(detail: DataFrame) -> DataFrame:
    """Debits, credits and lines per account, over every line whatever its date."""
    by_entity = detail.groupBy("account_code", "entity").agg(
        F.sum("debit").alias("debits"),
        F.sum("credit").alias("credits"),
        F.count(F.lit(1)).alias("lines"),
        F.min("row_index").alias("first_row"),
    )
    return by_entity.groupBy("account_code").agg(
        F.sum("debits").cast("decimal(38,2)").alias("debits"),
        F.sum("credits").cast("decimal(38,2)").alias("credits"),
        F.sum("lines").alias("lines"),
        F.min_by("entity", "first_row").alias("entity"),
    )


def journal_totals(detail: DataFrame) -> DataFrame:
    """Debits, credits, lines and the first line's row index per journal."""
    return detail.groupBy("journal_id").agg(
        F.sum("debit").cast("decimal(38,2)").alias("debits"),
        F.sum("credit").cast("decimal(38,2)").alias("credits"),
        F.count(F.lit(1)).alias("lines"),
        F.min("row_index").alias("first_row"),
    )
