"""Text views over the derived ledger, and a headers table over ``part``.

The moduli and spoilt values below are fixed values of these fixtures, the same in
the comparison SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from catalog.ledger import _once, detail, table
from tallybook.functions.text import normalise_header
from tallybook.schemas import DETAIL_RULES
from tallybook.workspace import new_path, stage

# Source columns of the text files written from the ledger.
HEADER = {
    "Co Code": "entity",
    "Nominal Code": "account_code",
    "Nominal Name": "account_name",
    "Posting Dt": "posting_date",
    "Per": "period",
    "Jnl Ref": "journal_id",
    "Ln": "line_no",
    "Narrative": "description",
    "Amount DR": "debit",
    "Amount CR": "credit",
    "Ccy": "currency",
    "Src": "source_system",
}


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger with every field rendered as text."""
    lines = detail(spark, sf_dir)
    return lines.select(*(F.col(f).cast("string").alias(f) for f in DETAIL_RULES), "row_index")


def dirty_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spoilt text, as a table that was delivered. Written once."""
    return _once(spark, sf_dir, "dirty", lambda: stage(_spoilt_text(spark, sf_dir), "dirty-text"))


def _spoilt_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text rows in three date formats, spoilt by row number, with their source."""
    lines = detail(spark, sf_dir)
    n = F.col("row_index")
    text = {f: F.col(f).cast("string") for f in DETAIL_RULES}
    missing = F.lit(None).cast("string")
    date = F.col("posting_date")
    spoilt = {
        **text,
        "entity": F.when(n % 101 == 0, "").when(n % 103 == 0, missing).otherwise(text["entity"]),
        "account_name": F.when(n % 107 == 0, missing).otherwise(text["account_name"]),
        "posting_date": F.when(n % 109 == 0, "30/02/2001")
        .when(n % 113 == 0, missing)
        .when(n % 3 == 0, text["posting_date"])
        .when(n % 3 == 1, F.date_format(date, "d/M/yyyy"))
        .otherwise(F.date_format(date, "d-MMM-yyyy")),
        "journal_id": F.when(n % 127 == 0, "   ").otherwise(text["journal_id"]),
        "line_no": F.when(n % 131 == 0, "1.5")
        .when(n % 137 == 0, "0")
        .when(n % 139 == 0, " 7 ")
        .otherwise(text["line_no"]),
        "debit": F.when(n % 149 == 0, "abc")
        .when(n % 151 == 0, "-5.00")
        .when(n % 157 == 0, "NaN")
        .when(n % 163 == 0, "1e3")
        .when(n % 167 == 0, "100000000000000000000000000.00")
        .when(n % 173 == 0, "2.345")
        .when(n % 179 == 0, "-0.004")
        .otherwise(text["debit"]),
        "credit": F.when(n % 181 == 0, missing).otherwise(text["credit"]),
    }
    return lines.select(
        F.lit("ledger").alias("source_file"),
        F.lit("0" * 64).alias("source_sha256"),
        (n + 1).alias("row_number"),
        *(column.alias(field) for field, column in spoilt.items()),
    )


def text_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder of comma-separated files holding the whole ledger. Written once."""

    def build() -> str:
        path = new_path(spark, "ledger-text")
        rows = clean_text(spark, sf_dir)
        rows.select(*(F.col(c).alias(s) for s, c in HEADER.items())).write.options(
            header=True, quote='"', escape='"', emptyValue=""
        ).csv(path)
        return path

    return _once(spark, sf_dir, "text-files", build)


# ---- headers at scale --------------------------------------------------------------

HEADERS_PER_PROVIDER = 40


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    name = F.col("p_name")
    spelling = (
        F.when(key % 7 == 0, F.upper(name))
        .when(key % 7 == 1, F.replace(name, F.lit(" "), F.lit("_")))
        .when(key % 7 == 2, F.replace(name, F.lit(" "), F.lit("-")))
        .when(key % 7 == 3, F.substring(name, 2, 100))
        .when(key % 7 == 4, F.concat(name, F.lit(" no")))
        .when(key % 7 == 5, F.concat("p_brand", F.lit(" "), "p_type"))
        .otherwise(name)
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_name",
        "p_size",
        F.concat(F.lit("S"), F.floor(key / HEADERS_PER_PROVIDER).cast("string")).alias("provider"),
        F.when(key % 2 == 0, "parts").otherwise("stock").alias("dataset"),
        spelling.alias("source_column"),
        (key % HEADERS_PER_PROVIDER).alias("position"),
    )


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir).select("provider", "dataset", "source_column", "position")


def _field(name):
    return F.concat(F.lit("f_"), F.replace(name, F.lit(" "), F.lit("_")))


def _names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_name").distinct()


def synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part name for ``parts``; those not beginning with s for ``stock``."""
    names = _names(spark, sf_dir)
    both = names.select(F.lit("parts").alias("dataset"), "p_name").unionByName(
        names.where(~F.col("p_name").startswith("s")).select(F.lit("stock").alias("dataset"), "p_name")
    )
    place = F.row_number().over(W.partitionBy("dataset").orderBy("p_name"))
    return both.select(
        "dataset", _field(F.col("p_name")).alias("field"), F.col("p_name").alias("term"),
        (place - 1).cast("bigint").alias("term_position"),
    )


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = _names(spark, sf_dir)
    place = (F.row_number().over(W.orderBy("p_name")) - 1).cast("bigint").alias("field_position")
    named = names.select(_field(F.col("p_name")).alias("field"), place)
    datasets = F.explode(F.array(F.lit("parts"), F.lit("stock"))).alias("dataset")
    return named.select(datasets, "field", "field_position")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third provider is known: its upper-case and ' no' columns were approved."""
    parts = _parts(spark, sf_dir)
    key = F.col("p_partkey")
    known = parts.where((F.floor(key / HEADERS_PER_PROVIDER) % 3 == 0) & (key % 7).isin(0, 4))
    return known.groupBy("provider", "dataset", "source_column").agg(
        _field(F.min("p_name")).alias("canonical_field"),
        F.when(F.min(key % 7) == 0, 2).otherwise(3).alias("source_tier"),
        F.lit(1.0).alias("confidence"),
        F.when(F.min(key % 7) == 0, "deterministic").otherwise("human").alias("approved_by"),
        F.lit("2026-07-28").alias("approved_at"),
        F.lit("approved before").alias("rationale"),
    )


def proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An outside proposal for every brand-and-type header of even length."""
    parts = _parts(spark, sf_dir).where(F.col("p_partkey") % 7 == 5)
    keyed = parts.withColumn("header_key", normalise_header(F.col("source_column")))
    return (
        keyed.where(F.length("header_key") % 2 == 0)
        .groupBy("dataset", "header_key")
        .agg(
            _field(F.min("p_name")).alias("canonical_field"),
            (F.lit(70) + F.min("p_size") % 30).alias("_percent"),
        )
        .select(
            "dataset", "header_key", "canonical_field",
            (F.col("_percent").cast("double") / 100.0).alias("confidence"),
            F.lit("proposed from outside").alias("rationale"),
        )
    )
