"""The reconciliation controls C1 to C6, each as findings over two populations.

``detail`` follows ``DETAIL_SCHEMA`` and ``summary`` follows ``SUMMARY_SCHEMA``.
Detail is never filtered by date before it is totalled: a posting in the wrong
period is a cutoff finding, not a balance difference.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.config import UNIDENTIFIED_RUN
from tallybook.functions.grading import above_materiality, severity
from tallybook.functions.text import money_text, plural, sentence
from tallybook.operators.totals import journal_totals, zero
from tallybook.schemas import CONTROL_POSITION, ORDER_COLUMNS, REGISTER_COLUMNS
from tallybook.workspace import stage


def as_findings(
    rows: DataFrame,
    control: str,
    tolerance: Decimal,
    run_id: str,
    *,
    value: Column,
    record_count: Column,
    evidence: Column,
    account: Column | None = None,
    journal: Column | None = None,
    unbalanced_journal: bool = False,
    affects_balance: bool = True,
    block: int = 0,
    sort_code: Column | None = None,
    sort_row: Column | None = None,
) -> DataFrame:
    """Shape raw differences as register rows, graded on the one scale."""
    missing = F.lit(None).cast("string")
    value = value.cast("decimal(38,2)")
    return rows.select(
        F.lit(run_id).alias("run_id"),
        F.lit(control).alias("control_id"),
        severity(
            value,
            tolerance,
            unbalanced_journal=unbalanced_journal,
            affects_balance=affects_balance,
        ).alias("severity"),
        F.col("entity"),
        (account if account is not None else missing).alias("account_code"),
        (journal if journal is not None else missing).alias("journal_id"),
        value.alias("value"),
        record_count.cast("bigint").alias("record_count"),
        above_materiality(value, tolerance).alias("above_materiality"),
        evidence.alias("evidence"),
        F.lit("OPEN").alias("disposition"),
        F.lit(CONTROL_POSITION[control]).alias("control_pos"),
        F.lit(block).alias("block"),
        (sort_code if sort_code is not None else F.lit("")).alias("sort_code"),
        (sort_row if sort_row is not None else F.lit(0)).cast("bigint").alias("sort_row"),
    )


def last_row_per_account(summary: DataFrame) -> DataFrame:
    """Where a summary repeats an account, the row that arrived last stands for it."""
    others = [c for c in summary.columns if c != "account_code"]
    return (
        summary.groupBy("account_code")
        .agg(F.max_by(F.struct(*others), "row_index").alias("_last"))
        .select("account_code", "_last.*")
    )


# ---- C1: every journal balances -------------------------------------------------


def c1_journal_balance(
    detail: DataFrame, tolerance: Decimal, run_id: str = UNIDENTIFIED_RUN
) -> DataFrame:
    """One finding per journal whose debits and credits differ; always HIGH."""
    totals = stage(journal_totals(detail).where(F.col("debits") != F.col("credits")), "unbalanced")
    # A journal's entity is that of its first line, looked up for unbalanced journals alone.
    firsts = detail.select(F.col("row_index").alias("first_row"), "entity")
    unbalanced = totals.join(firsts, "first_row")
    difference = F.abs(F.col("debits") - F.col("credits"))
    return as_findings(
        unbalanced,
        "C1",
        tolerance,
        run_id,
        journal=F.col("journal_id"),
        value=difference,
        record_count=F.col("lines"),
        unbalanced_journal=True,
        evidence=sentence(
            "journal ", F.col("journal_id"), " does not self-balance across ",
            F.col("lines"), " lines: debits ", money_text(F.col("debits")),
            " against credits ", money_text(F.col("credits")),
            ", a difference of ", money_text(difference),
        ),
        sort_code=F.col("journal_id"),
    )


def c1_ledger_crosscheck(detail: DataFrame) -> DataFrame:
    """The whole ledger's difference by two routes: over the lines, over the journals.

    One scan: grouping sets give the journals' rows and the grand total, and both are folded into one row.
    """
    levels = detail.rollup("journal_id").agg(
        F.sum("debit").cast("decimal(38,2)").alias("debits"),
        F.sum("credit").cast("decimal(38,2)").alias("credits"),
        F.count(F.lit(1)).alias("n"),
        F.grouping("journal_id").alias("level"),
    )
    whole = F.col("level") == 1
    difference = (F.col("debits") - F.col("credits")).cast("decimal(38,2)")

    def of_whole(column: str, empty: Column) -> Column:
        return F.coalesce(F.max(F.when(whole, F.col(column))), empty)

    both = levels.agg(
        of_whole("debits", zero()).alias("total_debits"),
        of_whole("credits", zero()).alias("total_credits"),
        F.coalesce(F.sum(F.when(~whole, difference)), zero()).cast("decimal(38,2)").alias("journal_difference"),
        of_whole("n", F.lit(0)).alias("lines"),
        F.count_if(~whole).alias("journals"),
    )
    ledger = (F.col("total_debits") - F.col("total_credits")).cast("decimal(38,2)")
    return both.select(
        "total_debits",
        "total_credits",
        ledger.alias("ledger_difference"),
        "journal_difference",
        "lines",
        "journals",
        (ledger == F.col("journal_difference")).alias("agrees"),
    )


def c1_detail_text() -> Column:
    """What C1 measured beyond its findings; aborts the job if the routes disagree."""
    journals = plural(F.col("journals"), "journal")
    return F.when(
        F.col("agrees"),
        sentence(
            "whole ledger: debits ", money_text(F.col("total_debits")),
            " against credits ", money_text(F.col("total_credits")),
            ", debits less credits ", money_text(F.col("ledger_difference")),
            ", equal to the sum of the per-journal differences over ", journals,
            "; reported, not raised, because the journals it is made of are already"
            " reported above",
        ),
    ).otherwise(
        F.raise_error(
            sentence(
                "C1 does not agree with itself: the whole ledger differs by ",
                money_text(F.col("ledger_difference")),
                ", the per-journal differences over ", journals, " sum to ",
                money_text(F.col("journal_difference")),
            )
        ).cast("string")
    )


# ---- C2: detail against summary -------------------------------------------------


def c2_detail_vs_summary(
    totals: DataFrame, summary: DataFrame, tolerance: Decimal, run_id: str = UNIDENTIFIED_RUN
) -> DataFrame:
    """Every summary row whose closing balance the detail does not lead to.

    ``totals`` is ``account_totals(detail)``: C2 and both sides of C3 read the same one.
    """
    moved = totals.select("account_code", "debits", "credits", "lines")
    joined = summary.join(moved, "account_code", "left").withColumns(
        {
            "debits": F.coalesce("debits", zero()),
            "credits": F.coalesce("credits", zero()),
            "lines": F.coalesce("lines", F.lit(0)),
        }
    )
    derived = (F.col("opening_balance") + F.col("debits") - F.col("credits")).cast("decimal(38,2)")
    rows = joined.withColumn("derived", derived).where(F.col("derived") != F.col("closing_balance"))
    value = F.abs(F.col("derived") - F.col("closing_balance"))
    code = F.col("account_code")
    return as_findings(
        rows,
        "C2",
        tolerance,
        run_id,
        account=code,
        value=value,
        record_count=F.col("lines") + 1,
        evidence=sentence(
            "account ", code, ": General Ledger derives ", money_text(F.col("derived")),
            " from opening ", money_text(F.col("opening_balance")),
            " plus debits ", money_text(F.col("debits")),
            " less credits ", money_text(F.col("credits")),
            " over ", F.col("lines"), " lines, against a Trial Balance closing balance of ",
            money_text(F.col("closing_balance")), "; a difference of ", money_text(value),
        ),
        sort_code=code,
        sort_row=F.col("row_index"),
    )


# ---- C3: every account is on both sides -----------------------------------------


def c3_summary_only(
    totals: DataFrame, summary: DataFrame, tolerance: Decimal, run_id: str = UNIDENTIFIED_RUN
) -> DataFrame:
    """Summary accounts no detail line was posted to."""
    rows = last_row_per_account(summary).join(
        totals.select("account_code"), "account_code", "left_anti"
    )
    code = F.col("account_code")
    return as_findings(
        rows,
        "C3",
        tolerance,
        run_id,
        account=code,
        value=F.abs("closing_balance"),
        record_count=F.lit(1),
        evidence=sentence(
            "account ", code, " ", F.col("account_name"),
            " appears in the Trial Balance with a closing balance of ",
            money_text(F.col("closing_balance")), " and has no General Ledger lines",
        ),
        sort_code=code,
    )


def c3_detail_only(
    totals: DataFrame, summary: DataFrame, tolerance: Decimal, run_id: str = UNIDENTIFIED_RUN
) -> DataFrame:
    """Accounts with detail lines that the summary does not carry."""
    carried = summary.select("account_code", F.lit(True).alias("_carried")).distinct()
    # Catalyst would move an anti join below the totals, where all lines of an account are one task's to sort.
    rows = totals.join(carried, "account_code", "left").where(F.col("_carried").isNull()).drop("_carried")
    movement = (F.col("debits") - F.col("credits")).cast("decimal(38,2)")
    code = F.col("account_code")
    return as_findings(
        rows,
        "C3",
        tolerance,
        run_id,
        account=code,
        value=F.abs(movement),
        record_count=F.col("lines"),
        block=1,
        evidence=sentence(
            "account ", code, " carries ", F.col("lines"), " General Ledger lines moving ",
            money_text(movement), " and does not appear in the Trial Balance",
        ),
        sort_code=code,
    )


# ---- C4: period cutoff ----------------------------------------------------------


def out_of_period(detail: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Lines dated outside ``start`` to ``end``, both inclusive."""
    return detail.where((F.col("posting_date") < F.lit(start)) | (F.col("posting_date") > F.lit(end)))


def c4_cutoff(
    detail: DataFrame,
    start: dt.date,
    end: dt.date,
    tolerance: Decimal,
    run_id: str = UNIDENTIFIED_RUN,
) -> DataFrame:
    """One finding per misdated line, valued at the line; no balance moves."""
    value = (F.col("debit") + F.col("credit")).cast("decimal(38,2)")
    return as_findings(
        out_of_period(detail, start, end),
        "C4",
        tolerance,
        run_id,
        account=F.col("account_code"),
        journal=F.col("journal_id"),
        value=value,
        record_count=F.lit(1),
        affects_balance=False,
        evidence=sentence(
            "journal ", F.col("journal_id"), " line ", F.col("line_no"), ", account ",
            F.col("account_code"), ", is dated ", F.col("posting_date"),
            f", outside {start.isoformat()} to {end.isoformat()}: debit ",
            money_text(F.col("debit")), " credit ", money_text(F.col("credit")),
        ),
        sort_row=F.col("row_index"),
    )


# ---- C5: rollforward ------------------------------------------------------------


def account_union(summary: DataFrame, prior: DataFrame) -> DataFrame:
    """Every account of either period, with the last row of each side."""
    now = last_row_per_account(summary).select(
        "account_code", F.col("entity").alias("now_entity"), "opening_balance"
    )
    before = last_row_per_account(prior).select(
        "account_code",
        F.col("entity").alias("prior_entity"),
        F.col("closing_balance").alias("prior_closing"),
    )
    return now.join(before, "account_code", "full_outer").select(
        "account_code",
        F.coalesce("now_entity", "prior_entity").alias("entity"),
        F.coalesce(F.col("opening_balance").cast("decimal(38,2)"), zero()).alias("opening_balance"),
        F.coalesce(F.col("prior_closing").cast("decimal(38,2)"), zero()).alias("prior_closing"),
        (F.col("now_entity").isNotNull().cast("int") + F.col("prior_entity").isNotNull().cast("int"))
        .cast("bigint")
        .alias("sides"),
    )


def c5_rollforward(
    summary: DataFrame, prior: DataFrame, tolerance: Decimal, run_id: str = UNIDENTIFIED_RUN
) -> DataFrame:
    """Accounts whose opening balance is not the prior period's closing balance."""
    rows = account_union(summary, prior).where(F.col("opening_balance") != F.col("prior_closing"))
    value = F.abs(F.col("opening_balance") - F.col("prior_closing"))
    code = F.col("account_code")
    return as_findings(
        rows,
        "C5",
        tolerance,
        run_id,
        account=code,
        value=value,
        record_count=F.col("sides"),
        evidence=sentence(
            "account ", code, ": prior period closing ", money_text(F.col("prior_closing")),
            " against current period opening ", money_text(F.col("opening_balance")),
            "; a difference of ", money_text(value),
        ),
        sort_code=code,
    )


# ---- C6: the summary's own arithmetic -------------------------------------------


def tb_row_arithmetic(summary: DataFrame) -> DataFrame:
    """Summary rows where opening plus debits less credits is not closing."""
    derived = (
        F.col("opening_balance") + F.col("period_debits") - F.col("period_credits")
    ).cast("decimal(38,2)")
    return (
        summary.withColumn("derived", derived)
        .where(F.col("derived") != F.col("closing_balance"))
        .withColumn("difference", F.abs(F.col("derived") - F.col("closing_balance")).cast("decimal(38,2)"))
    )


def c6_tb_internal(summary: DataFrame, tolerance: Decimal, run_id: str = UNIDENTIFIED_RUN) -> DataFrame:
    """At most one finding: some row's arithmetic breaks, or closings do not sum to nil.

    The broken rows themselves are those of ``tb_row_arithmetic``.
    """
    whole = summary.groupBy("entity").agg(
        F.sum("closing_balance").alias("closing"),
        F.count(F.lit(1)).alias("accounts"),
        F.min("row_index").alias("first_row"),
    ).agg(
        F.sum("closing").cast("decimal(38,2)").alias("aggregate"),
        F.sum("accounts").alias("accounts"),
        F.min_by("entity", "first_row").alias("entity"),
    )
    counted = tb_row_arithmetic(summary).agg(
        F.count(F.lit(1)).alias("broken"), F.max("difference").alias("largest")
    )
    one = F.lit(1).alias("_one")
    # One row on each side of the join.
    rows = (
        whole.select("*", one)
        .join(counted.select("*", one), "_one")
        .where((F.col("accounts") > 0) & ((F.col("broken") > 0) | (F.col("aggregate") != 0)))
    )
    limb = F.when(
        F.col("broken") == 0, "every account's opening plus movement equals its closing"
    ).otherwise(
        sentence(
            "rows whose closing does not follow from opening plus debits less credits: ",
            F.col("broken"), ", by ", money_text(F.col("largest")), " at most",
        )
    )
    return as_findings(
        rows,
        "C6",
        tolerance,
        run_id,
        value=F.abs("aggregate"),
        record_count=F.col("accounts"),
        evidence=sentence(
            "Trial Balance closing balances sum to ", money_text(F.col("aggregate")),
            " rather than 0.00 across ", F.col("accounts"), " accounts; ", limb,
        ),
    )


def empty_findings(like: DataFrame) -> DataFrame:
    return like.select(*REGISTER_COLUMNS, *ORDER_COLUMNS).where(F.lit(False))
