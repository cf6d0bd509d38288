"""Figures about a run, all of them read off its tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.operators.totals import zero
from tallybook.schemas import CONTROL_POSITION, CONTROLS


def by_control(findings: DataFrame) -> DataFrame:
    """Findings, value, and how many are material, for every control of the register.

    Values are never added across controls: they measure unlike quantities.
    """
    register = findings.sparkSession.createDataFrame(
        [(c, CONTROL_POSITION[c]) for c in CONTROLS], "control_id string, control_pos int"
    )
    figures = findings.groupBy("control_id").agg(
        F.count(F.lit(1)).alias("findings"),
        F.sum("value").alias("value"),
        F.count_if("above_materiality").alias("above"),
    )
    count = F.coalesce("findings", F.lit(0))
    above = F.coalesce("above", F.lit(0))
    return register.join(figures, "control_id", "left").select(
        "control_id",
        "control_pos",
        count.alias("findings"),
        F.coalesce("value", zero()).cast("decimal(38,2)").alias("value"),
        above.alias("above"),
        (count - above).alias("below"),
    )


def flagged_accounts(findings: DataFrame) -> DataFrame:
    """Accounts something was raised against at account level (C2 or C3)."""
    return (
        findings.where(F.col("control_id").isin("C2", "C3") & F.col("account_code").isNotNull())
        .select("account_code")
        .distinct()
    )


def agreement(findings: DataFrame, summary: DataFrame) -> DataFrame:
    """Value in scope and value agreed, over the summary's absolute closings.

    ``flagged_total`` counts flagged accounts, ``flagged_in_scope`` those of them
    the summary carries. The accounts themselves are ``flagged_accounts``.
    """
    flagged = flagged_accounts(findings).withColumn("_flag", F.lit(True))
    absolute = F.abs("closing_balance").cast("decimal(38,2)")
    # The summary's rows per account are added up before they meet the flags.
    accounts = summary.groupBy("account_code").agg(
        F.sum(absolute).cast("decimal(38,2)").alias("value"), F.count(F.lit(1)).alias("rows")
    )
    joined = accounts.withColumn("_in_summary", F.lit(True)).join(flagged, "account_code", "full_outer")
    clear = F.col("_flag").isNull()
    return joined.agg(
        F.coalesce(F.sum("value"), zero()).cast("decimal(38,2)").alias("in_scope"),
        F.coalesce(F.sum(F.when(clear, F.col("value"))), zero()).cast("decimal(38,2)").alias("agreed"),
        F.coalesce(F.sum(F.when(~clear, F.col("value"))), zero()).cast("decimal(38,2)").alias("not_agreed"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("accounts"),
        F.count_if(~clear).alias("flagged_total"),
        F.count_if(~clear & F.col("_in_summary").isNotNull()).alias("flagged_in_scope"),
    )


def counters(
    findings: DataFrame,
    control_summary: DataFrame,
    totals: DataFrame,
    resolution: DataFrame,
    detail: DataFrame,
    summary: DataFrame,
    decisions: DataFrame,
    proposer_calls: int,
) -> DataFrame:
    """The sixteen counters of a run, as one row.

    ``totals`` is the per-file control total, ``resolution`` the columns of its files.
    """
    one = F.lit(1).alias("_one")

    def sum_of(column: str):
        return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")

    parts = [
        totals.agg(
            F.count(F.lit(1)).alias("source_files"),
            sum_of("rows_received").alias("rows_received"),
            sum_of("rows_accepted").alias("rows_accepted"),
            sum_of("rows_quarantined").alias("rows_quarantined"),
        ),
        resolution.agg(
            F.count_if(F.col("state") == "resolved").alias("columns_mapped"),
            F.count_if(F.col("state") == "review").alias("columns_in_review"),
        ),
        detail.agg(F.count(F.lit(1)).alias("gl_lines")),
        summary.agg(F.count(F.lit(1)).alias("tb_rows")),
        control_summary.agg(
            F.count(F.lit(1)).alias("controls_registered"),
            F.count_if(F.col("status") == "RUN").alias("controls_run"),
            F.count_if(F.col("status") == "SKIPPED").alias("controls_skipped"),
        ),
        decisions.agg(F.count(F.lit(1)).alias("duplicate_decisions")),
        findings.agg(
            F.count(F.lit(1)).alias("exceptions"),
            F.count_if("above_materiality").alias("exceptions_above_materiality"),
            F.count_if(~F.col("above_materiality")).alias("exceptions_below_materiality"),
        ),
    ]
    # Each part is one row.
    row = parts[0].select("*", one)
    for part in parts[1:]:
        row = row.join(part.select("*", one), "_one")
    return row.select(
        "source_files",
        "columns_mapped",
        "columns_in_review",
        F.lit(proposer_calls).cast("bigint").alias("model_calls"),
        "rows_received",
        "rows_accepted",
        "rows_quarantined",
        "gl_lines",
        "tb_rows",
        "controls_registered",
        "controls_run",
        "controls_skipped",
        "duplicate_decisions",
        "exceptions",
        "exceptions_above_materiality",
        "exceptions_below_materiality",
    )


def bag_difference(actual: DataFrame, expected: DataFrame, columns: list[str]) -> DataFrame:
    """Rows only one side has, with multiplicity: unexpected and not found."""
    left, right = actual.select(*columns), expected.select(*columns)
    unexpected = left.exceptAll(right).withColumn("problem", F.lit("unexpected"))
    return unexpected.unionByName(right.exceptAll(left).withColumn("problem", F.lit("not found")))
