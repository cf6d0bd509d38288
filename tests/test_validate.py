"""Every rule, the values either side of it, and the control total."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybook.errors import ControlTotalError
from tallybook.functions.parsing import date_from_formats, datetime_pattern, money, whole_number
from tallybook.operators import validate as V
from tallybook.schemas import DETAIL_RULES, SUMMARY_RULES

FORMATS = ("%Y-%m-%d", "%d/%m/%Y", "%d-%b-%Y")
GOOD = dict(
    entity="AU01", account_code="1000", account_name="", posting_date="2025-08-01", period="FY",
    journal_id="J", line_no="1", description="", debit="5.00", credit="0", currency="AUD", source_system="",
)


def raw(spark, *changes, drop=(), add=()):
    rows = [{**GOOD, **c} for c in changes]
    columns = [c for c in GOOD if c not in drop] + list(add)
    schema = "source_file string, source_sha256 string, row_number bigint, " + ", ".join(f"{c} string" for c in columns)
    return spark.createDataFrame(
        [("f", "0", i + 1, *(r.get(c) for c in columns)) for i, r in enumerate(rows)], schema
    )


CASES = [
    ({}, None),
    ({"entity": ""}, ("V-EMPTY", "entity", "String should have at least 1 character")),
    ({"entity": "  "}, None),
    ({"entity": None}, ("V-TYPE", "entity", "Input should be a valid string")),
    ({"description": ""}, None),
    ({"description": None}, ("V-TYPE", "description", "Input should be a valid string")),
    ({"debit": "abc"}, ("V-DECIMAL", "debit", "'abc' cannot be read as a monetary amount")),
    ({"debit": "it's"}, ("V-DECIMAL", "debit", "\"it's\" cannot be read as a monetary amount")),
    ({"debit": None}, ("V-DECIMAL", "debit", "None cannot be read as a monetary amount")),
    ({"debit": ""}, ("V-DECIMAL", "debit", "'' cannot be read as a monetary amount")),
    ({"debit": "-inf"}, ("V-DECIMAL", "debit", "-Infinity is not a finite amount")),
    ({"debit": "-0.01"}, ("V-SIGN", "debit", "Input should be greater than or equal to 0")),
    ({"debit": "-0.004"}, None),
    ({"debit": "99999999999999999999999999.99"}, None),
    (
        {"debit": "100000000000000000000000000.00"},
        ("V-DECIMAL", "debit", "100000000000000000000000000.00 carries more digits than a monetary amount can hold"),
    ),
    ({"posting_date": "1/8/2025"}, None),
    ({"posting_date": "1-AUG-2025"}, None),
    (
        {"posting_date": "30/02/2025"},
        ("V-DATE", "posting_date", "30/02/2025 matches none of the configured formats: %Y-%m-%d, %d/%m/%Y, %d-%b-%Y"),
    ),
    ({"posting_date": None}, ("V-DATE", "posting_date", "a date must arrive as text; this arrived as NoneType")),
    ({"line_no": "1.5"}, ("V-INTEGER", "line_no", "'1.5' is not a whole number")),
    ({"line_no": "0"}, ("V-INTEGER", "line_no", "line numbers start at 1; this row carries 0")),
    ({"line_no": " 7 "}, None),
    ({"line_no": None}, ("V-INTEGER", "line_no", "None is not a whole number")),
]


def test_rules(spark):
    checked = V.check_rows(raw(spark, *(change for change, _ in CASES)), DETAIL_RULES, FORMATS)
    found = {
        r.row_number: [(f.rule_id, f.field, f.detail) for f in r.failures]
        for r in V.quarantined_rows(checked).collect()
    }
    for number, (change, expected) in enumerate(CASES, start=1):
        assert found.get(number, []) == ([expected] if expected else []), change


def test_all_failures_are_listed_in_field_order_and_raw_is_kept(spark):
    checked = V.check_rows(raw(spark, {"credit": "x", "entity": "", "line_no": "1.5"}), DETAIL_RULES, FORMATS)
    row = V.quarantined_rows(checked).first()
    assert [f.field for f in row.failures] == ["entity", "line_no", "credit"]
    assert (row.rule_id, row.field, row.row_number, row.source_file) == ("V-EMPTY", "entity", 1, "f")
    assert row.raw["credit"] == "x" and len(row.raw) == 12
    assert V.accepted_rows(checked, DETAIL_RULES).count() == 0


def test_absent_and_unexpected_columns(spark):
    checked = V.check_rows(raw(spark, {}, drop=("currency",), add=("other",)), DETAIL_RULES, FORMATS)
    failures = V.quarantined_rows(checked).first().failures
    assert [(f.rule_id, f.field) for f in failures] == [("V-REQUIRED", "currency"), ("V-UNEXPECTED-FIELD", "other")]


def test_summary_money_may_be_negative(spark):
    schema = ", ".join(f"{c} string" for c in SUMMARY_RULES)
    rows = spark.createDataFrame([("E", "1", "n", "-5", "0", "-1", "-5")], schema)
    (failure,) = V.quarantined_rows(V.check_rows(rows, SUMMARY_RULES, FORMATS)).first().failures
    assert (failure.rule_id, failure.field) == ("V-SIGN", "period_credits")


def test_typed_values(spark):
    accepted = V.accepted_rows(V.check_rows(raw(spark, {"debit": "2.345"}), DETAIL_RULES, FORMATS), DETAIL_RULES).first()
    assert accepted.debit == Decimal("2.35") and accepted.posting_date == dt.date(2025, 8, 1) and accepted.line_no == 1


def test_no_formats_reads_no_dates(spark):
    (failure,) = V.quarantined_rows(V.check_rows(raw(spark, {}), DETAIL_RULES, ())).first().failures
    assert failure.detail == "no date formats are configured, so 2025-08-01 cannot be read"


DATES = [
    "1/2/2025", "01/02/2025", "31/4/2025", "1/2/25", " 1/2/2025", "1/2/02025", "29/2/2024", "29/2/2023",
    "1-feb-2025", "1-FEB-2025", "1-Febr-2025", "2025-2-1", "12025-02-01", "2025-02- 1", "1/ 2/2025", "",
    "00/1/2025", "1/0/2025", "2025-02-01 ", "31-Dec-0001",
]


def read(spark, texts, column):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return {r.t: r.v for r in df.select("t", column(F.col("t")).alias("v")).collect()}


def test_dates_agree_with_strptime(spark):
    def strptime(text):
        for f in FORMATS:
            try:
                return dt.datetime.strptime(text, f).date()
            except ValueError:
                pass

    assert read(spark, DATES, lambda c: date_from_formats(c, FORMATS)) == {t: strptime(t) for t in DATES}


def test_translator_refuses_what_it_does_not_know():
    assert datetime_pattern("%d de %b %Y") == "d 'de' MMM yyyy"
    with pytest.raises(ValueError):
        datetime_pattern("%Q")


def test_money(spark):
    want = {"0.005": "0.01", "-0.005": "-0.01", " 7 ": "7.00", "1e3": "1000.00", "1_000": None, "+5": "5.00", "": None}
    assert read(spark, want, money) == {t: w and Decimal(w) for t, w in want.items()}


def test_whole_number(spark):
    want = {"+5": 5, "5.0": None, "": None, "99999999999999999999": None, "-3": -3}
    assert read(spark, want, whole_number) == want


def test_control_total(spark):
    rows = raw(spark, {}, {"debit": "x"}, {})
    checked = V.check_rows(rows, DETAIL_RULES, FORMATS)
    total = V.control_total(rows, checked).first()
    assert (total.rows_received, total.rows_accepted, total.rows_quarantined, total.holds) == (3, 2, 1, True)
    V.assert_control_total(V.control_total(rows, checked))
    with pytest.raises(ControlTotalError):
        V.assert_control_total(V.control_total(rows, checked.limit(2)))


def test_failures_of_chosen_rules_are_planned_within_bounds(spark):
    """A filter above the exploded failures took the planner minutes and a gigabyte."""
    rows = raw(spark, {"debit": "-1", "entity": ""}, {"debit": "-2"}, {}, {"entity": None})
    quarantined = V.quarantined_rows(V.check_rows(rows, DETAIL_RULES, FORMATS))
    chosen = V.broken_rules(quarantined, ("V-SIGN", "V-TYPE"), ("row_number",))
    found = [(r.row_number, r.rule_id, r.field) for r in chosen.orderBy("row_number").collect()]
    assert found == [(1, "V-SIGN", "debit"), (2, "V-SIGN", "debit"), (4, "V-TYPE", "entity")]
    assert "Filter" not in chosen._jdf.queryExecution().analyzed().toString().split("Generate")[0]
