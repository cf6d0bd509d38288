"""Written intermediate tables: lineage is cut, sizes are known, columns still prune.

Tables go to the shared folder the cluster names in ``spark.checkpoint.dir``. Only
where that is unset (tests, one machine) is a temporary folder taken.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"

_fallback: dict[str, str] = {}


def base_dir(spark: SparkSession) -> str:
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _fallback:
        _fallback[app] = tempfile.mkdtemp(prefix="tallybook-")
    return _fallback[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{base_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` once and read it back, so that reuse costs a pruned scan.

    Files hold at most ``rows_per_file`` rows (0: any number). A scan's task takes no more files than
    fit spark.sql.files.maxPartitionBytes at openCostInBytes each, 32 by default, however small they are.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_with_index(
    df: DataFrame, order: list[Column], name: str, index: str = "row_index", columns: Sequence[str] | None = None
) -> DataFrame:
    """Write ``df`` in ``order`` and number its rows from 0 without a global window.

    The range sort splits hot leading keys on the later ones; ``order`` should
    therefore end in something that tells equal rows apart. A row's number is its
    place in its file plus the rows of the files before it. Those sums are one short
    list, as long as the sort has partitions, held as a constant of the plan. ``columns``
    are those written; the others serve the order only.
    """
    columns = list(columns or df.columns)
    spark = df.sparkSession
    path = new_path(spark, name)
    # One file per part, whatever the session's limit: a row's place counts from its part's start.
    df.orderBy(*order).select(*columns).write.option("maxRecordsPerFile", 0).parquet(path)
    written = spark.read.schema(df.select(*columns).schema).parquet(path)
    # Files are called part-<number>-<rest>; the number is five digits or more.
    part = F.substring(F.substring_index("_metadata.file_name", "-", 2), 6, 10).cast("int")
    sizes = {
        row.part: row.rows
        for row in written.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows")).collect()
    }
    before, offsets = 0, []
    for number in range(max(sizes, default=-1) + 1):
        offsets.append(str(before))
        before += sizes.get(number, 0)
    starts = F.split(F.lit(",".join(offsets or ["0"])), ",").cast("array<bigint>")
    position = F.get(starts, part) + F.col("_metadata.row_index")
    return written.select(*columns, position.cast("bigint").alias(index))
