"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   input folder (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
    BENCH_WARM_DIR folder each query runs over once before it is timed (default
                   /root/testdata/sf0.001), so that JVM warm-up is not measured; empty: none

The derived ledger is built first and timed on its own: it stands for the delivered
files. Every query then runs from scratch into a sink that discards rows.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalog import ledger  # noqa: E402
from catalog.queries import QUERIES  # noqa: E402

HEADLINES = (
    "c1_journal_balance",
    "c1_ledger_crosscheck",
    "account_totals",
    "c2_detail_vs_summary",
    "c3_detail_only",
    "c4_cutoff",
    "c5_rollforward",
    "c6_tb_internal",
    "quarantine_split",
    "quarantine_detail",
    "control_total",
    "column_profile",
    "gate_routing",
    "derive_summary",
    "all_text_scan",
    "row_position",
    "format_audit",
    "run_controls",
)


def run(spark: SparkSession, name: str, folder: str) -> None:
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tallybook-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")

    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if warm:
        for name in HEADLINES:
            run(spark, name, warm)

    started = time.perf_counter()
    rows = ledger.detail(spark, folder).count() + ledger.summary(spark, folder).count()
    timings = {"ledger_build": time.perf_counter() - started}
    for name in HEADLINES:
        started = time.perf_counter()
        run(spark, name, folder)
        timings[name] = time.perf_counter() - started
    timings = {name: round(seconds, 3) for name, seconds in timings.items()}
    print(
        json.dumps(
            {
                "metric": "run_controls over the derived ledger",
                "value": timings["run_controls"],
                "unit": "sec",
                "queries": timings,
                "rows": rows,
                "rows_per_second": round(rows / timings["run_controls"]),
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
