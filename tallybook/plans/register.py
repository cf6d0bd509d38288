"""The register: every control over two populations, and what each one did."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.config import UNIDENTIFIED_RUN, Engagement
from tallybook.errors import ControlArithmeticError
from tallybook.operators import controls as C
from tallybook.operators import dedupe as D
from tallybook.operators.totals import account_totals
from tallybook.schemas import (
    CONTROL_POSITION,
    CONTROL_SUMMARY_COLUMNS,
    CONTROLS,
    ORDER_COLUMNS,
    REGISTER_COLUMNS,
)
from tallybook.workspace import stage, stage_with_index


def has_rows(df: DataFrame | None) -> bool:
    return df is not None and not df.isEmpty()


def all_findings(
    detail: DataFrame,
    summary: DataFrame,
    engagement: Engagement,
    prior: DataFrame | None,
    run_id: str,
    duplicates: DataFrame,
) -> DataFrame:
    """Findings of all seven controls. ``duplicates`` are DEDUPE's own.

    The per-account totals are written first: three controls read them, and their size
    is then known when Catalyst picks the joins.
    """
    tolerance = engagement.tolerance
    totals = stage(account_totals(detail), "account-totals")
    found = [
        C.c1_journal_balance(detail, tolerance, run_id),
        C.c2_detail_vs_summary(totals, summary, tolerance, run_id),
        C.c3_summary_only(totals, summary, tolerance, run_id),
        C.c3_detail_only(totals, summary, tolerance, run_id),
        C.c4_cutoff(detail, engagement.year_start, engagement.year_end, tolerance, run_id),
        C.c6_tb_internal(summary, tolerance, run_id),
        duplicates,
    ]
    if prior is not None:
        found.append(C.c5_rollforward(summary, prior, tolerance, run_id))
    return reduce(DataFrame.unionByName, found)


def register_order(findings: DataFrame) -> DataFrame:
    """Findings in reporting order: control, then code or file order within it."""
    return findings.orderBy(*ORDER_COLUMNS).select(*REGISTER_COLUMNS)


def register_places(findings: DataFrame) -> DataFrame:
    """Findings with ``place``, their number (from 1) in reporting order, without a window over all of them."""
    placed = stage_with_index(findings, [F.asc(c) for c in ORDER_COLUMNS], "register", "place")
    return placed.withColumn("place", F.col("place") + 1)


def control_summary(
    findings: DataFrame,
    detail: DataFrame,
    summary: DataFrame,
    prior: DataFrame | None,
    run_id: str = UNIDENTIFIED_RUN,
) -> DataFrame:
    """One row per registered control, also where it found nothing or was skipped."""
    spark = findings.sparkSession
    skipped = prior is None
    dimension = spark.createDataFrame(
        [(c, CONTROL_POSITION[c]) for c in CONTROLS], "control_id string, control_pos int"
    )
    raised = findings.groupBy("control_id").agg(F.count(F.lit(1)).alias("raised"))
    one = F.lit(1).alias("_one")
    summary_rows = summary.agg(F.count(F.lit(1)).alias("summary_rows"))
    prior_rows = (prior if prior is not None else summary.limit(0)).agg(
        F.count(F.lit(1)).alias("prior_rows")
    )
    # Single-row tables of counts beside the seven-row dimension.
    counted = (
        C.c1_ledger_crosscheck(detail)
        .select("lines", C.c1_detail_text().alias("c1_detail"), one)
        .join(summary_rows.select("*", one), "_one")
        .join(prior_rows.select("*", one), "_one")
    )
    control = F.col("control_id")
    tested = (
        F.when(control.isin("C1", "C4", "DEDUPE"), F.col("lines"))
        .when(control.isin("C2", "C3"), F.col("lines") + F.col("summary_rows"))
        .when(control == "C6", F.col("summary_rows"))
        .when(F.lit(skipped), F.lit(0))
        .otherwise(F.col("summary_rows") + F.col("prior_rows"))
    )
    is_skipped = F.lit(skipped) & (control == "C5")
    return (
        dimension.withColumn("_one", F.lit(1))
        .join(F.broadcast(counted), "_one")
        .join(raised, "control_id", "left")
        .select(
            F.lit(run_id).alias("run_id"),
            control,
            F.when(is_skipped, "SKIPPED").otherwise("RUN").alias("status"),
            tested.cast("bigint").alias("rows_tested"),
            F.coalesce("raised", F.lit(0)).cast("bigint").alias("exceptions_raised"),
            F.when(is_skipped, "no prior period loaded").alias("reason"),
            F.when(control == "C1", F.col("c1_detail")).alias("detail"),
            "control_pos",
        )
        .orderBy("control_pos")
        .select(*CONTROL_SUMMARY_COLUMNS)
    )


def assert_c1_agrees(detail: DataFrame) -> None:
    """Stop the run if C1's two routes to the ledger difference disagree."""
    check = C.c1_ledger_crosscheck(detail).first()
    if not check["agrees"]:
        raise ControlArithmeticError(
            f"C1 does not agree with itself: the whole ledger differs by "
            f"{check['ledger_difference']}, its journals by {check['journal_difference']}"
        )


def run_controls(
    detail: DataFrame,
    summary: DataFrame,
    engagement: Engagement,
    prior: DataFrame | None = None,
    *,
    run_id: str = UNIDENTIFIED_RUN,
    duplicates: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Findings in register order, and the control summary beside them.

    ``detail`` is read by several controls, so it should be a table or a staged
    one; each control then scans only its own columns. The findings are written once
    and both results read them. An empty prior period counts as none.
    """
    prior = prior if has_rows(prior) else None
    if duplicates is None:
        candidates = D.duplicate_candidates(detail)
        duplicates = D.dedupe_findings(D.described_groups(candidates), engagement.tolerance, run_id)
    findings = stage(all_findings(detail, summary, engagement, prior, run_id, duplicates), "findings")
    return register_order(findings), control_summary(findings, detail, summary, prior, run_id)
