"""Lookup tables: canonical fields, synonyms, registry and outside proposals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.errors import MappingError
from tallybook.schemas import (
    DATASET_RULES,
    FIELDS_SCHEMA,
    PROPOSALS_SCHEMA,
    REGISTRY_SCHEMA,
    SYNONYMS_SCHEMA,
)

# The nested registry document: clients -> provider -> dataset -> columns.
_COLUMN = (
    "struct<canonical_field: string, source_tier: int, confidence: double, "
    "approved_by: string, approved_at: string, rationale: string>"
)
REGISTRY_DOCUMENT = (
    "registry_version int, description string, clients map<string, map<string, "
    f"struct<approved_at: string, columns: map<string, {_COLUMN}>>>>"
)


def canonical_fields(
    spark: SparkSession, rules: Mapping[str, Mapping[str, str]] = DATASET_RULES
) -> DataFrame:
    rows = [
        (dataset, field, position)
        for dataset, fields in rules.items()
        for position, field in enumerate(fields)
    ]
    return spark.createDataFrame(rows, FIELDS_SCHEMA)


def synonyms_table(
    spark: SparkSession, nested: Mapping[str, Mapping[str, Sequence[str]]]
) -> DataFrame:
    """dataset -> field -> terms (as loaded from its YAML file) as rows, in file order."""
    rows: list[tuple[str, str, str, int]] = []
    for dataset, fields in nested.items():
        if not isinstance(fields, Mapping):
            raise MappingError(f"the {dataset} section of the synonym list is not an object")
        position = 0
        for field, terms in fields.items():
            for term in terms or ():
                rows.append((dataset, field, str(term), position))
                position += 1
    return spark.createDataFrame(rows, SYNONYMS_SCHEMA)


def registry_table(document: DataFrame) -> DataFrame:
    """The nested registry document as rows, one per approved column."""
    providers = document.select(F.explode("clients").alias("provider", "_datasets"))
    datasets = providers.select("provider", F.explode("_datasets").alias("dataset", "_entry"))
    columns = datasets.select(
        "provider",
        "dataset",
        F.col("_entry.approved_at").alias("_entry_at"),
        F.explode("_entry.columns").alias("source_column", "_c"),
    )
    return columns.select(
        "provider",
        "dataset",
        "source_column",
        "_c.canonical_field",
        "_c.source_tier",
        "_c.confidence",
        "_c.approved_by",
        F.coalesce("_c.approved_at", "_entry_at").alias("approved_at"),
        "_c.rationale",
    )


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.schema(REGISTRY_DOCUMENT).options(multiLine=True, mode="FAILFAST")
    document = reader.json(path)
    if document.isEmpty():
        raise MappingError(f"{path} does not hold a registry object")
    return registry_table(document)


def empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REGISTRY_SCHEMA)


def proposals_table(spark: SparkSession, rows: Sequence[tuple[Any, ...]]) -> DataFrame:
    """(dataset, normalised header, field, confidence, rationale) rows."""
    return spark.createDataFrame(list(rows), PROPOSALS_SCHEMA)
