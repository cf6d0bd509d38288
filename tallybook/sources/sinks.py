"""What a run writes: register, run log, review queue and registry versions.

Large lists (findings, decisions, members, quarantine) are tables of their own;
the run log holds figures only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.operators.mapping import file_order
from tallybook.schemas import REGISTER_COLUMNS, RESOLUTION_SCHEMA

STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def register_rows(findings: DataFrame) -> DataFrame:
    """The register as text: missing is empty, money has two places, flags are words."""
    def text(name: str) -> Column:
        if name == "value":
            return F.col(name).cast("decimal(38,2)").cast("string")
        if name == "above_materiality":
            return F.when(F.col(name), "true").otherwise("false")
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    return findings.select(*(text(c).alias(c) for c in REGISTER_COLUMNS))


def write_register(findings: DataFrame, path: str) -> None:
    """CSV in register order (as many part files as the sort leaves) and Parquet beside it."""
    findings.select(*REGISTER_COLUMNS).write.parquet(f"{path}/parquet")
    register_rows(findings).write.options(
        header=True, quote='"', escape='"', emptyValue="", lineSep="\n"
    ).csv(f"{path}/csv")


def stamp(moment: Column) -> Column:
    return F.date_format(moment, STAMP)


def review_queue(resolution: DataFrame) -> DataFrame:
    """Settled and waiting proposals of every file, in file order."""
    return file_order(resolution)


def write_review_queue(resolution: DataFrame, path: str) -> None:
    """Written on every run; an empty queue says that nothing waits."""
    review_queue(resolution).write.parquet(path)


def load_queue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RESOLUTION_SCHEMA).parquet(path)


def write_registry_version(registry: DataFrame, folder: str, version: int) -> str:
    """A new version beside the ones before it; what is being read is never overwritten."""
    path = f"{folder}/version={version}"
    registry.write.parquet(path)
    return path


def run_log(
    header: DataFrame,
    counters: DataFrame,
    sources: DataFrame,
    mapping_figures: DataFrame,
    control_summary: DataFrame,
    by_control: DataFrame,
) -> DataFrame:
    """One nested row: who ran what, and every figure of the run.

    ``sources`` has one row per dataset; each file's identity is in the manifest. So
    every array here has as many entries as the run has datasets or controls.
    """
    one = F.lit(1).alias("_one")

    def listed(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.sort_array(F.collect_list(F.struct(*df.columns))).alias(name)).select(name, one)

    raised = by_control.where(F.col("findings") > 0).select("control_id", "value")
    row = header.select("*", one)
    for part in (
        counters.select(F.struct(*counters.columns).alias("counters"), one),
        listed(sources, "sources"),
        listed(mapping_figures, "mapping"),
        listed(control_summary, "controls"),
        listed(raised, "exception_value_by_control"),
    ):
        row = row.join(part, "_one")
    holds = F.col("counters.rows_received") == (
        F.col("counters.rows_accepted") + F.col("counters.rows_quarantined")
    )
    return row.drop("_one").withColumn("control_total_holds", holds)


def write_run_log(log: DataFrame, path: str) -> None:
    log.coalesce(1).write.json(path)  # one row
