"""Each control alone, over a population made to defeat it."""

import datetime as dt
from decimal import Decimal

import pytest
from ledgers import balance, detail, line, summary

from tallybook.errors import ControlArithmeticError
from tallybook.operators import controls as C
from tallybook.operators.totals import account_totals
from tallybook.plans import register as R

D = Decimal
T = D("1000.00")
START, END = dt.date(2025, 7, 1), dt.date(2026, 6, 30)


def rows(df):
    return df.orderBy("control_pos", "block", "sort_code", "sort_row").collect()


def test_c1_balanced_is_silent_and_unbalanced_is_high(spark):
    balanced = [line("J-001", "1000", "500"), line("J-001", "4000", "0", "500", 2)]
    assert rows(C.c1_journal_balance(detail(spark, balanced), T)) == []
    broken = [*balanced, line("J-002", "1000", "600"), line("J-002", "4000", "0", "500", 2)]
    (found,) = rows(C.c1_journal_balance(detail(spark, broken), T))
    assert (found.journal_id, found.value, found.severity) == ("J-002", D("100.00"), "HIGH")
    assert not found.above_materiality and found.record_count == 2 and found.account_code is None
    assert found.evidence == (
        "journal J-002 does not self-balance across 2 lines: debits 600.00 against credits "
        "500.00, a difference of 100.00"
    )


def test_first_line_names_the_entity(spark):
    lines = [line("J", "1", "5", entity="ZZ"), line("J", "1", "5", entity="AA")]
    assert rows(C.c1_journal_balance(detail(spark, lines), T))[0].entity == "ZZ"
    assert account_totals(detail(spark, lines)).first().entity == "ZZ"
    assert rows(C.c3_detail_only(account_totals(detail(spark, lines)), summary(spark, []), T))[0].entity == "ZZ"


def test_c2_difference_dormant_and_repeated_rows(spark):
    gl = detail(spark, [line("J", "1000", "500")])
    tb = summary(spark, [balance("1000", closing="400"), balance("1500", "95000", closing="95000")])
    (found,) = rows(C.c2_detail_vs_summary(account_totals(gl), tb, T))
    assert (found.account_code, found.value, found.severity, found.record_count) == ("1000", D("100.00"), "MEDIUM", 2)
    twice = summary(spark, [balance("1000", closing="400"), balance("1000", closing="450")])
    assert [r.value for r in rows(C.c2_detail_vs_summary(account_totals(gl), twice, T))] == [D("100.00"), D("50.00")]


def test_c2_ignores_posting_dates(spark):
    gl = detail(spark, [line("J", "1000", "500", date=dt.date(1999, 1, 1))])
    assert rows(C.c2_detail_vs_summary(account_totals(gl), summary(spark, [balance("1000", closing="500")]), T)) == []


def test_c3_both_sides(spark):
    gl = detail(spark, [line("J", "8888", "70", "20"), line("J", "1000", "1")])
    tb = summary(spark, [balance("9999", closing="-750"), balance("1000", closing="1")])
    (only_tb,) = rows(C.c3_summary_only(account_totals(gl), tb, T))
    assert (only_tb.account_code, only_tb.value, only_tb.record_count) == ("9999", D("750.00"), 1)
    assert only_tb.evidence.endswith("with a closing balance of -750.00 and has no General Ledger lines")
    (only_gl,) = rows(C.c3_detail_only(account_totals(gl), tb, T))
    assert (only_gl.account_code, only_gl.value) == ("8888", D("50.00"))
    assert only_gl.evidence == (
        "account 8888 carries 1 General Ledger lines moving 50.00 and does not appear in the Trial Balance"
    )


@pytest.mark.parametrize("day, found", [("2025-06-30", 1), ("2025-07-01", 0), ("2026-06-30", 0), ("2026-07-01", 1)])
def test_c4_boundaries_are_inclusive(spark, day, found):
    gl = detail(spark, [line("J", "1000", "500", date=dt.date.fromisoformat(day))])
    got = rows(C.c4_cutoff(gl, START, END, T))
    assert len(got) == found
    if got:
        assert (got[0].severity, got[0].value) == ("LOW", D("500.00"))


def test_c5_last_row_stands_and_missing_side_is_nil(spark):
    now = summary(spark, [balance("1", opening="1"), balance("1", opening="900"), balance("2", opening="10")])
    before = summary(spark, [balance("1", closing="1000"), balance("3", closing="-5")])
    got = {r.account_code: (r.value, r.record_count) for r in rows(C.c5_rollforward(now, before, T))}
    assert got == {"1": (D("100.00"), 2), "2": (D("10.00"), 1), "3": (D("5.00"), 1)}


def test_c6_is_one_finding(spark):
    off = summary(spark, [balance("1000", "500", closing="500"), balance("4000", "-500", closing="-400")])
    (found,) = rows(C.c6_tb_internal(off, T))
    assert found.value == D("100.00") and found.severity == "MEDIUM" and found.evidence.endswith("debits less credits: 1, by 100.00 at most")
    offsetting = summary(spark, [balance("1", closing="5000"), balance("2", closing="-5000")])
    (found,) = rows(C.c6_tb_internal(offsetting, T))
    assert found.value == D("0.00") and found.severity == "MEDIUM"
    assert found.evidence.endswith("less credits: 2, by 5000.00 at most")
    agreed = summary(spark, [balance("1", "5", closing="5"), balance("2", "-5", closing="-5")])
    assert rows(C.c6_tb_internal(agreed, T)) == []
    unsummed = summary(spark, [balance("1", "5", closing="5")])
    assert rows(C.c6_tb_internal(unsummed, T))[0].evidence.endswith("every account's opening plus movement equals its closing")
    assert rows(C.c6_tb_internal(summary(spark, []), T)) == []


def test_tolerance_is_strict(spark):
    gl = detail(spark, [line("J", "1", "1000")])
    tb = summary(spark, [balance("1")])
    (found,) = rows(C.c2_detail_vs_summary(account_totals(gl), tb, T))
    assert not found.above_materiality and found.severity == "MEDIUM"
    (found,) = rows(C.c2_detail_vs_summary(account_totals(gl), tb, D("999.99")))
    assert found.above_materiality and found.severity == "HIGH"


def test_register_order_skip_and_empty(spark, engagement):
    gl = [line("J-2", "6000", "5"), line("J-1", "6000", "5"), line("J-1", "7000", "5")]
    found, did = R.run_controls(detail(spark, gl), summary(spark, [balance("9", closing="1")]), engagement)
    order = [(r.control_id, r.account_code or r.journal_id) for r in found.collect()]
    assert order == [
        ("C1", "J-1"), ("C1", "J-2"), ("C2", "9"), ("C3", "9"), ("C3", "6000"), ("C3", "7000"),
        ("C6", None), ("DEDUPE", "6000"),
    ]
    did = {r.control_id: r for r in did.collect()}
    assert list(did) == ["C1", "C2", "C3", "C4", "C5", "C6", "DEDUPE"]
    assert did["C5"].status == "SKIPPED" and did["C5"].rows_tested == 0
    assert did["C3"].rows_tested == 4 and did["DEDUPE"].exceptions_raised == 1
    assert did["C1"].detail.startswith("whole ledger: debits 15.00 against credits 0.00")
    nothing, did = R.run_controls(
        detail(spark, []), summary(spark, []), engagement, prior=summary(spark, [])
    )
    assert nothing.collect() == []
    assert [r.rows_tested for r in did.collect()] == [0] * 7


def test_crosscheck_mismatch_stops_the_run(spark, monkeypatch):
    honest = C.c1_ledger_crosscheck
    monkeypatch.setattr(
        C, "c1_ledger_crosscheck", lambda d: honest(d).selectExpr("* EXCEPT (agrees)", "false AS agrees")
    )
    with pytest.raises(ControlArithmeticError):
        R.assert_c1_agrees(detail(spark, [line("J", "1", "5")]))
    with pytest.raises(Exception, match="C1 does not agree with itself"):
        C.c1_ledger_crosscheck(detail(spark, [line("J", "1", "5")])).select(C.c1_detail_text()).collect()


def test_c3_detail_only_totals_lines_before_they_meet_the_summary(spark):
    gl = detail(spark, [line("J", "8888", "70", "20"), line("J", None, "3"), line("J", "1000", "1"), line("K", "1000", "1")])
    tb = summary(spark, [balance("1000"), balance("1000"), balance(None)])
    found = C.c3_detail_only(account_totals(gl), tb, T)
    assert sorted((r.account_code or "", r.value) for r in found.collect()) == [("", D("3.00")), ("8888", D("50.00"))]
    # A join below the totals would have all lines of a hot account sorted in one task.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")
