"""Run every query beside its SQL and compare the bags of rows.

    python tests/compare.py [folder] [query ...]
"""

import decimal
import sys
import time
import traceback
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("n", str(value.normalize() + 0))
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, int):
        return ("n", str(decimal.Decimal(value).normalize()))
    if isinstance(value, float):
        return ("f", f"{value:.9g}")
    return ("s", None if value is None else str(value))


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, query, sql):
    start = time.time()
    df = query(spark, folder)
    got_names, got = bag(df.columns, df.collect())
    took = time.time() - start
    if sql is None:
        return took, f"rows only ({sum(got.values())})"
    result = con.execute(sql)
    want_names, want = bag([d[0] for d in result.description], result.fetchall())
    if got_names != want_names:
        return took, f"COLUMNS {got_names} / {want_names}"
    if got != want:
        extra, lacking = got - want, want - got
        return took, f"VALUES {sum(got.values())}/{sum(want.values())} extra {list(extra)[:2]} lacking {list(lacking)[:2]}"
    return took, f"ok {sum(got.values())}"


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    sql = entry.oracle_sql()
    wanted = sys.argv[2:] or list(entry.queries())
    bad = 0
    for name in wanted:
        try:
            took, verdict = compare(spark, con, folder, name, entry.queries()[name], sql.get(name))
        except Exception as error:  # noqa: BLE001
            took, verdict = 0.0, "ERROR " + str(error).split("\n")[0][:400]
            if len(sys.argv) > 2:
                traceback.print_exc()
        bad += not verdict.startswith(("ok", "rows only"))
        print(f"{name:24s} {took:6.2f}s {verdict}", flush=True)
    print("failures:", bad)
