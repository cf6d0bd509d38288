"""Column profiles: what the values of each text column look like.

Values are counted per (column, value) first, with map-side combine; everything
else is read off those counts, so a value that fills a third of a column travels
as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallybook.functions.parsing import (
    DECIMAL_NUMBER,
    WHOLE_NUMBER,
    date_from_formats,
    trimmed,
)

# The date shapes a profile recognises.
DATE_SHAPES = ("%Y-%m-%d", "%d/%m/%Y", "%d-%b-%Y")

SAMPLE_ROWS = 20
EXAMPLES = 3


def sample_rows(rows: DataFrame, count: int = SAMPLE_ROWS) -> DataFrame:
    """The first rows in file order: a distributed top-k."""
    return rows.orderBy("row_index").limit(count)


def value_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, trimmed value) with its count and the first row that holds it."""
    text = rows.select("row_index", *(trimmed(F.col(f"`{c}`").cast("string")).alias(c) for c in columns))
    return (
        text.unpivot("row_index", list(columns), "column", "value")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("row_index").alias("first_row"))
    )


def _is_dated(value: Column) -> Column:
    return date_from_formats(value, DATE_SHAPES).isNotNull()


def _kind() -> Column:
    """empty / integer / decimal / date / text: the first all populated values fit."""
    value = F.col("value")
    populated = F.length(value) > 0
    return (
        F.when(F.count_if(populated) == 0, "empty")
        .when(F.count_if(populated & ~value.rlike(WHOLE_NUMBER)) == 0, "integer")
        .when(F.count_if(populated & ~value.rlike(DECIMAL_NUMBER)) == 0, "decimal")
        .when(F.count_if(populated & ~_is_dated(value)) == 0, "date")
        .otherwise("text")
    )


def kind_inference(counts: DataFrame) -> DataFrame:
    return counts.groupBy("column").agg(_kind().alias("kind"))


def examples(counts: DataFrame, count: int = EXAMPLES) -> DataFrame:
    """The first distinct values of each column, in the order they were first seen."""
    seen = W.partitionBy("column").orderBy("first_row", "value")
    return (
        counts.where(F.length("value") > 0)
        .withColumn("place", F.row_number().over(seen))
        .where(F.col("place") <= count)
        .groupBy("column")
        .agg(F.sort_array(F.collect_list(F.struct("place", "value"))).getField("value").alias("examples"))
    )


def column_profile(rows: DataFrame, columns: Sequence[str], example_count: int = EXAMPLES) -> DataFrame:
    """One row per column: rows, populated, distinct, kind and examples."""
    counts = value_counts(rows, columns)
    populated = F.length("value") > 0
    figures = counts.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.coalesce(F.sum(F.when(populated, F.col("rows"))), F.lit(0)).alias("populated"),
        F.count_if(populated).alias("distinct"),
        _kind().alias("kind"),
    )
    return (
        figures.join(examples(counts, example_count), "column", "left").withColumn("examples", F.coalesce("examples", F.array().cast("array<string>")))
    )
