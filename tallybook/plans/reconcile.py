"""A whole run over delivered files: read, map, validate, test, report.

A run ends in one of three ways: completed, waiting for a person (columns without a
field), or an error. Findings never make it fail.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.config import Engagement
from tallybook.errors import FormatDetectionError
from tallybook.operators import dedupe as D
from tallybook.operators import mapping as M
from tallybook.operators import report as R
from tallybook.operators import validate as V
from tallybook.operators.controls import tb_row_arithmetic
from tallybook.operators.projection import canonical_projection
from tallybook.plans.register import (
    all_findings,
    assert_c1_agrees,
    control_summary,
    has_rows,
    register_order,
)
from tallybook.schemas import DATASET_RULES, HEADERS_SCHEMA
from tallybook.sources import sinks
from tallybook.sources.delimited import canonical_path, format_audit, header_names, one_header, require_formats, rows_of
from tallybook.sources.manifest import source_manifest
from tallybook.sources.records import numbered_records, staged_lines
from tallybook.sources.reference_tables import canonical_fields
from tallybook.workspace import stage, stage_with_index

COMPLETED = "COMPLETED"
REVIEW_REQUIRED = "REVIEW_REQUIRED"


@dataclass
class Outcome:
    """What one run produced: its state and its tables, by name."""

    run_id: str
    status: str
    tables: dict[str, DataFrame] = field(default_factory=dict)


def new_run_id(started_at: dt.datetime) -> str:
    return f"RUN-{started_at:%Y%m%dT%H%M%SZ}-{uuid.uuid4().hex[:6]}"


def _one_format(audit: DataFrame, path: str) -> tuple[str, str]:
    """The format all files of a folder share."""
    require_formats(audit)
    formats = audit.select("encoding", "delimiter").distinct().limit(2).collect()
    if len(formats) != 1:
        raise FormatDetectionError(f"the files under {path} do not share one format")
    return formats[0].encoding, formats[0].delimiter


def _file_totals(manifest: DataFrame, scan: DataFrame, checked: DataFrame) -> DataFrame:
    """The control total of every file; one without rows counts none."""
    received = scan.select(canonical_path("source_path").alias("source_path"))
    total = V.control_total(received, checked, ("source_path",))
    files = manifest.select(F.col("path").alias("source_path"), F.col("filename").alias("source_file"), "byte_size")
    counts = ("rows_received", "rows_accepted", "rows_quarantined")
    return files.join(total, "source_path", "full_outer").select(
        "source_file",
        *(F.coalesce(c, F.lit(0)).alias(c) for c in counts),
        F.coalesce("holds", F.lit(True)).alias("holds"),
        "source_path",
        "byte_size",
    )


def _validated(
    spark: SparkSession,
    dataset: str,
    scan: DataFrame,
    manifest: DataFrame,
    resolution: DataFrame,
    engagement: Engagement,
) -> DataFrame:
    """Every row of one dataset's files with its parsed fields and failures. Written."""
    settled = resolution.where((F.col("dataset") == dataset) & (F.col("state") == "resolved"))
    # As many rows as the canonical schema has fields.
    mapping = {r.source_column: r.canonical_field for r in settled.collect()}
    digests = manifest.select(F.col("path").alias("source_path"), F.col("sha256").alias("source_sha256"))
    numbered = scan.withColumn("source_path", canonical_path("source_path")).join(digests, "source_path", "left")
    kept = ("source_path", *V.SOURCE_COLUMNS)
    projected = canonical_projection(numbered, mapping, keep=kept)
    checked = V.check_rows(projected, DATASET_RULES[dataset], engagement.date_formats, kept)
    return stage(checked, f"{dataset}-checked")


def reconcile(
    spark: SparkSession,
    engagement: Engagement,
    paths: Mapping[str, str],
    registry: DataFrame,
    synonyms: DataFrame,
    out_dir: str,
    proposals: DataFrame | None = None,
    prior: DataFrame | None = None,
) -> Outcome:
    """Run everything for one provider. ``paths`` names the gl and tb file or folder.

    The files of one folder share format and columns, in any order. Results are written under
    ``out_dir``; intermediate tables go to the workspace.
    """
    started = dt.datetime.now(dt.timezone.utc)
    outcome = Outcome(new_run_id(started), REVIEW_REQUIRED)
    keep = outcome.tables
    fields = canonical_fields(spark)
    M.check_synonyms(synonyms, fields)
    M.check_fields_known(
        registry, fields, "canonical_field", "the registry names a field the dataset does not have"
    )
    if proposals is not None:
        M.check_proposals(proposals, fields)

    scans, manifests, header_rows = {}, {}, []
    for dataset, path in paths.items():
        lines = staged_lines(spark, path, engagement.delimiters)
        audit = stage(
            format_audit(spark, path, engagement.encodings, engagement.delimiters, lines), f"{dataset}-audit"
        )
        encoding, delimiter = _one_format(audit, path)
        numbered = numbered_records(lines, delimiter)
        headers = header_names(numbered, encoding)
        header = one_header(headers, path)
        header_rows += [(engagement.provider, dataset, h, i) for i, h in enumerate(header)]
        scans[dataset] = rows_of(numbered, headers, header, encoding)
        manifests[dataset] = stage(
            source_manifest(spark, path, engagement, audit).withColumn("dataset", F.lit(dataset)),
            f"{dataset}-manifest",
        )

    columns = spark.createDataFrame(header_rows, HEADERS_SCHEMA)
    resolution = stage(
        M.resolve_columns(columns, registry, synonyms, proposals, engagement.confidence_gate),
        "resolution",
    )
    keep["resolution"] = resolution
    sinks.write_review_queue(resolution, f"{out_dir}/review_queue")
    keep["missing_fields"] = M.missing_fields(resolution, fields)
    if has_rows(keep["missing_fields"]):
        return outcome

    checked, totals, sources, population = {}, [], [], {}
    for dataset, scan in scans.items():
        rules = DATASET_RULES[dataset]
        checked[dataset] = _validated(
            spark, dataset, scan, manifests[dataset], resolution, engagement
        )
        total = stage(_file_totals(manifests[dataset], scan, checked[dataset]), f"{dataset}-total")
        V.assert_control_total(total)
        totals.append(total.drop("source_path", "byte_size"))
        sources.append(
            total.groupBy(F.lit(dataset).alias("dataset")).agg(
                F.count(F.lit(1)).alias("files"),
                F.sum("byte_size").alias("bytes"),
                *(F.sum(c).alias(c) for c in ("rows_received", "rows_accepted", "rows_quarantined")),
            )
        )
        accepted = V.accepted_rows(checked[dataset], rules)
        population[dataset] = stage_with_index(
            accepted, [F.col("source_file"), F.col("source_sha256"), F.col("row_number")], f"{dataset}-accepted"
        ).select(*rules, "row_index")

    detail, summary = population["gl"], population["tb"]
    assert_c1_agrees(detail)
    candidates = D.duplicate_candidates(detail)
    described = stage(D.described_groups(candidates), "duplicate-groups")
    duplicates = D.dedupe_findings(described, engagement.tolerance, outcome.run_id)
    prior = prior if has_rows(prior) else None
    findings = stage(
        all_findings(detail, summary, engagement, prior, outcome.run_id, duplicates), "findings"
    )

    keep["detail"], keep["summary"] = detail, summary
    keep["findings"] = register_order(findings)
    keep["control_summary"] = stage(
        control_summary(findings, detail, summary, prior, outcome.run_id), "control-summary"
    )
    keep["manifest"] = manifests["gl"].unionByName(manifests["tb"])
    keep["control_total"] = totals[0].unionByName(totals[1])
    keep["decisions"] = D.duplicate_decisions(described, F.lit(started).cast("timestamp"))
    keep["duplicate_members"] = D.duplicate_members(candidates)
    keep["duplicate_journals"] = D.duplicate_journals(candidates)
    keep["tb_row_arithmetic"] = tb_row_arithmetic(summary)
    quarantine = [
        V.quarantined_rows(rows).withColumn("dataset", F.lit(dataset)) for dataset, rows in checked.items()
    ]
    keep["quarantine"] = quarantine[0].unionByName(quarantine[1])
    keep["by_control"] = R.by_control(findings)
    keep["agreement"] = R.agreement(findings, summary)
    keep["mapping_figures"] = M.mapping_figures(resolution)
    # One question per dataset that had columns left to ask about.
    asked = resolution.where((F.col("source_tier") == 3) | F.col("source_tier").isNull())
    calls = 0 if proposals is None else asked.select("dataset").distinct().count()
    keep["counters"] = R.counters(
        findings, keep["control_summary"], keep["control_total"], resolution, detail, summary,
        keep["decisions"], calls,
    )
    about = spark.createDataFrame(
        [(outcome.run_id, started, engagement.provider, engagement.engagement, engagement.period)],
        "run_id string, started_at timestamp, provider string, engagement string, period string",
    ).withColumns({"started_at": sinks.stamp(F.col("started_at")), "finished_at": sinks.stamp(F.current_timestamp())})
    keep["run_log"] = sinks.run_log(
        about, keep["counters"], sources[0].unionByName(sources[1]), keep["mapping_figures"],
        keep["control_summary"], keep["by_control"],
    )

    sinks.write_register(keep["findings"], f"{out_dir}/register")
    for name in (
        "manifest", "control_summary", "decisions", "duplicate_members", "duplicate_journals",
        "tb_row_arithmetic", "agreement", "quarantine",
    ):
        keep[name].write.parquet(f"{out_dir}/{name}")
    sinks.write_run_log(keep["run_log"], f"{out_dir}/run_log")
    outcome.status = COMPLETED
    return outcome
