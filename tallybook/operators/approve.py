"""The human gate as table transforms: a review queue and a registry go in, a new
registry comes out. Nothing is written for a file without an approval in it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.errors import ApprovalError
from tallybook.schemas import REGISTRY_SCHEMA

FILE = ["provider", "dataset"]


def awaiting(queue: DataFrame) -> DataFrame:
    return queue.where(F.col("state") == "review")


def approve_all(queue: DataFrame) -> DataFrame:
    """Every queued column something proposed a field for."""
    return awaiting(queue).where(F.col("canonical_field").isNotNull())


def approve_named(queue: DataFrame, names: DataFrame) -> DataFrame:
    """The named columns, in every file where they wait. ``names`` holds source_column."""
    return awaiting(queue).join(names.distinct(), "source_column", "left_semi")


def unknown_names(queue: DataFrame, names: DataFrame) -> DataFrame:
    return names.distinct().join(awaiting(queue), "source_column", "left_anti")


def check_approval(queue: DataFrame, approving: DataFrame, names: DataFrame | None) -> None:
    """Refuse unknown names, columns nothing was proposed for, and empty approvals."""
    if names is not None:
        unknown = [r.source_column for r in unknown_names(queue, names).limit(20).collect()]
        if unknown:
            raise ApprovalError(f"not awaiting a decision: {', '.join(sorted(unknown))}")
        bare = approving.where(F.col("canonical_field").isNull()).limit(20).collect()
        if bare:
            raise ApprovalError(
                "nothing proposed a field for "
                + ", ".join(f"{r.provider} {r.dataset} {r.source_column!r}" for r in bare)
            )
    if approving.isEmpty():
        raise ApprovalError("nothing was approved")


def registry_entry(
    queue: DataFrame, approving: DataFrame, registry: DataFrame, approved_at: str
) -> DataFrame:
    """The complete settled mapping of every file with an approval.

    Tiers 1 and 2 stay ``deterministic`` whoever approved; a tier 3 column is
    ``human`` if approved here and ``model`` if it settled by itself. A column that
    came from the registry goes back as it was found.
    """
    files = approving.select(*FILE).distinct()
    settled = (
        queue.where(F.col("state") == "resolved")
        .withColumn("_approved", F.lit(False))
        .unionByName(approving.withColumn("_approved", F.lit(True)))
        .join(files, FILE, "left_semi")
    )
    found = registry.select(*FILE, "source_column", F.struct(*registry.columns).alias("_found"))
    fresh = F.struct(
        "provider",
        "dataset",
        "source_column",
        "canonical_field",
        "source_tier",
        "confidence",
        F.when(F.col("source_tier").isin(1, 2), "deterministic")
        .when(F.col("_approved"), "human")
        .otherwise("model")
        .alias("approved_by"),
        F.lit(approved_at).alias("approved_at"),
        "rationale",
    )
    columns = [part.split()[0] for part in REGISTRY_SCHEMA.split(", ")]
    carried = F.col("source_tier") == 1
    joined = settled.join(found, [*FILE, "source_column"], "left")
    entry = F.when(carried & F.col("_found").isNotNull(), F.struct(*(F.col(f"_found.{c}") for c in columns))).otherwise(fresh)
    return joined.select(
        entry.alias("_entry"), F.col("source_tier").alias("settled_tier"), "position"
    ).select("_entry.*", "settled_tier", "position")


def registry_upsert(registry: DataFrame, entry: DataFrame) -> DataFrame:
    """The registry with the entry's files replaced and every other file kept."""
    replaced = entry.select(*FILE).distinct()
    return registry.join(replaced, FILE, "left_anti").unionByName(entry.select(*registry.columns))


def written_summary(entry: DataFrame) -> DataFrame:
    """Per file: columns written, by the tier that settled them and by approver."""
    tier, by = F.col("settled_tier"), F.col("approved_by")
    return entry.groupBy(*FILE).agg(
        F.count(F.lit(1)).alias("columns"),
        F.count_if(tier == 1).alias("tier1"),
        F.count_if(tier == 2).alias("tier2"),
        F.count_if(tier == 3).alias("tier3"),
        F.count_if(by == "deterministic").alias("deterministic"),
        F.count_if(by == "human").alias("human"),
        F.count_if(by == "model").alias("model"),
    )


def approve(
    queue: DataFrame, registry: DataFrame, approved_at: str, columns: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Approve all queued columns, or those named: (new registry, written summary)."""
    names = None
    if columns is None:
        approving = approve_all(queue)
    else:
        names = queue.sparkSession.createDataFrame([(c,) for c in columns], "source_column string")
        approving = approve_named(queue, names)
    check_approval(queue, approving, names)
    entry = registry_entry(queue, approving, registry, approved_at)
    return registry_upsert(registry, entry), written_summary(entry)
