"""A ledger derived from ``lineitem``: clean, then with planted differences.

Each order is a journal of one debit line per lineitem row and one contra credit.
The summary is derived from the clean lines; then copies, re-keyed lines, one-sided
lines and a moved closing balance are planted (amounts and moduli below are fixed
values of this fixture, the same in the comparison SQL).
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.config import Engagement
from tallybook.operators.derive import derive_summary
from tallybook.schemas import DETAIL_SCHEMA, SUMMARY_SCHEMA
from tallybook.workspace import stage, stage_with_index

ENGAGEMENT = Engagement(
    provider="LINEITEM",
    engagement="DERIVED",
    period="FY",
    year_start=dt.date(1995, 2, 1),
    year_end=dt.date(2001, 10, 1),
    tolerance=Decimal("1000.00"),
    currency="AUD",
    encodings=("utf-8", "latin-1"),
    delimiters=(",", "\t", "|"),
    date_formats=("%Y-%m-%d", "%d/%m/%Y", "%d-%b-%Y"),
    confidence_gate=0.85,
)

_tables: dict[tuple[str, str, str], DataFrame] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Build a staged table once per application and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _tables:
        _tables[key] = build()
    return _tables[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(text: str):
    return F.lit(text).cast("decimal(28,2)")


def _postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.col("l_extendedprice").cast("decimal(28,2)")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        _journal_of(F.col("l_orderkey")).alias("journal_id"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("account_code"),
        F.col("l_linenumber").cast("bigint").alias("line_no"),
        F.col("l_shipdate").cast("date").alias("posting_date"),
        F.col("l_returnflag").alias("description"),
        amount.alias("debit"),
        _money("0").alias("credit"),
        # Rows with equal fields are one another's equals; their place in a file spreads them over a sort.
        F.col("_metadata.row_index").alias("_place"),
    )


def _journal_of(order_key) -> Column:
    return F.concat(F.lit("J"), order_key.cast("string"))


def _per_order(postings: DataFrame) -> DataFrame:
    """Total and first date per order. The journal follows from the key, so only the key is grouped."""
    totals = postings.groupBy("order_key").agg(
        F.sum("debit").cast("decimal(28,2)").alias("total"),
        F.min("posting_date").alias("posting_date"),
    )
    return totals.withColumn("journal_id", _journal_of(F.col("order_key")))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders' totals, written once: the lines, the chart and the sums over both read them."""
    return _once(
        spark, sf_dir, "orders", lambda: stage(_per_order(_postings(spark, sf_dir)).drop("journal_id"), "order-totals")
    ).withColumn("journal_id", _journal_of(F.col("order_key")))


def _canonical(lines: DataFrame) -> DataFrame:
    return lines.withColumns(
        {
            "entity": F.lit("E001"),
            "account_name": F.concat(F.lit("Account "), F.col("account_code")),
            "period": F.lit("FY"),
            "currency": F.lit("AUD"),
            "source_system": F.lit("LINEITEM"),
        }
    )


def _with_extras(own, first, second):
    """The array of ``own`` and whichever of two (condition, value) extras apply."""
    (is_first, one), (is_second, two) = first, second
    return (
        F.when(is_first & is_second, F.array(own, one, two))
        .when(is_first, F.array(own, one))
        .when(is_second, F.array(own, two))
        .otherwise(F.array(own))
    )


def _ledger_lines(spark: SparkSession, sf_dir: str, planted: bool) -> DataFrame:
    """Lines of postings and of orders, before ``_canonical``. A posting gives its own line and
    perhaps a copy or a re-keyed one; an order gives its contra and perhaps a one-sided or stray
    line. ``_copy`` tells a line from its exact copy."""
    key = F.col("order_key")
    postings = _postings(spark, sf_dir)

    def posting(journal, copy: int):
        return F.struct(journal.alias("journal_id"), F.lit(copy).alias("_copy"))

    own = posting(F.col("journal_id"), 0)
    given = F.array(own)
    if planted:
        copy = posting(F.col("journal_id"), 1)
        rekeyed = posting(F.concat(F.lit("X"), "journal_id"), 1)
        given = _with_extras(own, (key % 499 == 1, copy), (key % 613 == 2, rekeyed))
    lines = postings.withColumn("_line", F.explode(given)).select(*(c for c in postings.columns if c != "journal_id"), "_line.*")

    def extra(code: str, line_no: int, text: str, debit, credit):
        return F.struct(
            F.lit(code).alias("account_code"),
            F.lit(line_no).cast("bigint").alias("line_no"),
            F.lit(text).alias("description"),
            debit.alias("debit"),
            credit.alias("credit"),
        )

    contra = extra("4000", 1000, "contra", _money("0"), F.col("total"))
    given = F.array(contra)
    if planted:
        one_sided = extra("P1", 1001, "one-sided", _money("250.00"), _money("0"))
        stray = extra("9999", 1002, "stray", _money("75.00"), _money("75.00"))
        given = _with_extras(contra, (key % 997 == 0, one_sided), (key % 1009 == 3, stray))
    of_orders = _orders(spark, sf_dir).select(
        "order_key", "journal_id", "posting_date",
        F.explode(given).alias("_line"),
    ).select(
        "order_key", "journal_id", "posting_date", "_line.*",
        F.lit(0).cast("bigint").alias("_place"), F.lit(0).alias("_copy"),
    )
    return lines.unionByName(of_orders)


def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _canonical(_ledger_lines(spark, sf_dir, planted=False))


def detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as delivered, numbered in journal order."""

    def build() -> DataFrame:
        lines = _ledger_lines(spark, sf_dir, planted=True)
        order = [
            "journal_id", "line_no", "account_code", "posting_date", "debit", "credit",
            "description", "_copy", "_place",
        ]
        # What is the same on every line, or follows from another field, is not sorted or written.
        written = ["journal_id", "line_no", "account_code", "posting_date", "debit", "credit", "description"]
        slim = lines.select(*order)
        indexed = stage_with_index(slim, [F.col(c) for c in order], "ledger-detail", columns=written)
        return _canonical(indexed).select(*DETAIL_SCHEMA.names)

    return _once(spark, sf_dir, "detail", build)


def chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every account of the clean ledger with a nil opening, and two without movement."""
    clean = clean_lines(spark, sf_dir)
    moved = clean.select("account_code", "account_name").distinct()
    still = moved.limit(0).unionByName(
        spark.createDataFrame(
            [("1500", "Account 1500"), ("3000", "Account 3000")],
            "account_code string, account_name string",
        )
    )
    opening = (
        F.when(F.col("account_code") == "1500", _money("95000.00"))
        .when(F.col("account_code") == "3000", _money("-95000.00"))
        .otherwise(_money("0"))
    )
    return moved.unionByName(still).withColumn("opening_balance", opening)


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived from the clean lines; then one closing balance is moved by 1850.00."""

    def build() -> DataFrame:
        derived = derive_summary(clean_lines(spark, sf_dir), chart(spark, sf_dir), "E001")
        moved = derived.withColumn(
            "closing_balance",
            F.when(
                F.col("account_code") == "P7", F.col("closing_balance") + _money("1850.00")
            ).otherwise(F.col("closing_balance")).cast("decimal(28,2)"),
        )
        indexed = stage_with_index(moved, [F.col("account_code")], "ledger-summary")
        return indexed.select(*SUMMARY_SCHEMA.names)

    return _once(spark, sf_dir, "summary", build)


def prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The year before: closings are this year's openings, but for each account
    ending in 0 (5.00 more), accounts ending in 13 (absent) and a closed account."""
    now = summary(spark, sf_dir)
    code = F.col("account_code")
    shifted = now.where(~code.rlike("^P[0-9]*13$")).withColumn(
        "closing_balance",
        (F.col("opening_balance") + F.when(code.rlike("^P[0-9]*0$"), _money("5.00")).otherwise(_money("0")))
        .cast("decimal(28,2)"),
    )
    closed = now.where(code == "1500").withColumns(
        {
            "account_code": F.lit("2500"),
            "account_name": F.lit("Account 2500"),
            "closing_balance": _money("-40.00"),
            "row_index": F.lit(-1).cast("bigint"),
        }
    )
    return shifted.unionByName(closed)
