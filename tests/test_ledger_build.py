"""The derived ledger carries through its sort no more than it must."""

import datetime as dt

from catalog import ledger as L
from catalog.queries import QUERIES

SCHEMA = (
    "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_shipdate date, l_returnflag string, l_extendedprice double"
)


def folder(spark, path):
    rows = [(k, (k or 0) % 3, n, dt.date(1996, 1, 1 + (k or 0) % 9), "N", 10.0 * n) for k in (3, 20, 100, 500, None) for n in (1, 2)]
    rows += rows[:1]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def test_only_what_differs_between_lines_is_sorted_and_written(spark, tmp_path):
    lines = L.detail(spark, folder(spark, tmp_path))
    assert spark.read.parquet(*lines.inputFiles()).columns == [
        "journal_id", "line_no", "account_code", "posting_date", "debit", "credit", "description",
    ]
    rows = lines.orderBy("row_index").collect()
    assert [r.row_index for r in rows] == list(range(len(rows)))
    given = [(r.journal_id is not None, r.journal_id or "", r.line_no) for r in rows]
    assert given == sorted(given)
    assert sum(r.journal_id == "J500" for r in rows) == 5  # two lines, their copies, the contra
    assert {(r.entity, r.period, r.currency, r.source_system) for r in rows} == {("E001", "FY", "AUD", "LINEITEM")}
    assert all(r.account_name == f"Account {r.account_code}" for r in rows)


def test_orders_are_totalled_once_for_all_that_read_them(spark, tmp_path):
    path = folder(spark, tmp_path)
    lines, clean = L._ledger_lines(spark, path, planted=True), L.clean_lines(spark, path)
    assert all("Aggregate" not in df._jdf.queryExecution().optimizedPlan().toString() for df in (lines, clean))
    totals = {r.journal_id: (r.total, r.posting_date) for r in L._orders(spark, path).collect()}
    assert {k: int(v[0]) for k, v in totals.items()} == {"J3": 40, "J20": 30, "J100": 30, "J500": 30, None: 30}


def test_row_position_groups_numbers_without_listing_them(spark, tmp_path):
    answer = QUERIES["row_position"](spark, folder(spark, tmp_path))
    assert "distinct" not in answer._jdf.queryExecution().analyzed().toString()
    lines = L.detail(spark, str(tmp_path)).count()
    assert answer.first().asDict() == {"rows": lines, "well_numbered": lines}
