"""The delivered files end to end: cold run, approval, warm run, nine findings."""

import json

import pytest
from ledgers import PROPOSALS, SYNONYMS, balances, delivered_lines, expected_findings, gl_csv, tb_csv

from tallybook import reconcile
from tallybook.errors import ApprovalError
from tallybook.operators.approve import approve
from tallybook.operators.mapping import mapping_figures
from tallybook.sources import reference_tables as RT
from tallybook.sources import sinks
from tallybook.workspace import stage

LINES = delivered_lines()
GOLDEN = expected_findings(LINES, balances(), 1000, "2025-07-01", "2026-06-30")


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("delivered")
    (folder / "gl.csv").write_text(gl_csv())
    (folder / "tb.csv").write_text(tb_csv())
    return {
        "paths": {"gl": str(folder / "gl.csv"), "tb": str(folder / "tb.csv")},
        "synonyms": RT.synonyms_table(spark, SYNONYMS),
        "proposals": RT.proposals_table(spark, PROPOSALS),
    }


def run(spark, engagement, inputs, registry, out):
    return reconcile(
        spark, engagement, inputs["paths"], registry, inputs["synonyms"], str(out), inputs["proposals"]
    )


def figures(resolution):
    rows = mapping_figures(resolution).collect()
    return {r.dataset: (r.tier1, r.tier2, r.tier3, r.review) for r in rows}


def register(outcome):
    return [
        (r.control_id, r.severity, r.account_code, r.journal_id, str(r.value), r.above_materiality)
        for r in outcome.tables["findings"].collect()
    ]


def test_cold_approve_warm(spark, engagement, inputs, tmp_path):
    cold = run(spark, engagement, inputs, RT.empty_registry(spark), tmp_path / "cold")
    assert cold.status == "REVIEW_REQUIRED"
    assert figures(cold.tables["resolution"]) == {"gl": (0, 7, 5, 5), "tb": (0, 6, 1, 1)}

    queue = sinks.load_queue(spark, str(tmp_path / "cold/review_queue"))
    updated, written = approve(queue, RT.empty_registry(spark), "2026-07-28T00:00:00Z")
    assert {r.dataset: (r.columns, r.deterministic, r.human) for r in written.collect()} == {
        "gl": (12, 7, 5),
        "tb": (7, 6, 1),
    }
    warm = run(spark, engagement, inputs, stage(updated, "registry"), tmp_path / "warm")
    assert warm.status == "COMPLETED"
    assert figures(warm.tables["resolution"]) == {"gl": (12, 0, 0, 0), "tb": (7, 0, 0, 0)}
    assert register(warm) == GOLDEN and len(GOLDEN) == 9

    duplicate = [r.evidence for r in warm.tables["findings"].collect() if r.control_id == "DEDUPE"]
    journal, on, n, account, amount = LINES[-1]
    assert duplicate[0].startswith(
        f"2 lines identical across all eight key fields: first at population row {LINES.index(LINES[-1])}, "
        f"last at {len(LINES) - 1}, journal {journal} line {n}, account {account}, dated {on}, debit {amount}.00 credit 0.00; hash "
    )
    counters = warm.tables["counters"].first().asDict()
    assert counters == {
        "source_files": 2, "columns_mapped": 19, "columns_in_review": 0, "model_calls": 0,
        "rows_received": len(LINES) + 8, "rows_accepted": len(LINES) + 8, "rows_quarantined": 0, "gl_lines": len(LINES),
        "tb_rows": 8, "controls_registered": 7, "controls_run": 6, "controls_skipped": 1,
        "duplicate_decisions": 1, "exceptions": 9, "exceptions_above_materiality": 7,
        "exceptions_below_materiality": 2,
    }
    summary = {r.control_id: r for r in warm.tables["control_summary"].collect()}
    assert summary["C5"].status == "SKIPPED" and summary["C5"].reason == "no prior period loaded"
    assert summary["C2"].rows_tested == len(LINES) + 8
    log = json.loads(next((tmp_path / "warm/run_log").glob("*.json")).read_text())
    assert log["control_total_holds"] and log["counters"]["exceptions"] == 9
    csv = sorted((tmp_path / "warm/register/csv").glob("part-*"))
    lines = [l for f in csv for l in f.read_text().splitlines()]
    assert len([l for l in lines if not l.startswith("run_id,")]) == 9


def test_one_approval_makes_the_provider_known(spark, engagement, inputs, tmp_path):
    cold = run(spark, engagement, inputs, RT.empty_registry(spark), tmp_path / "cold")
    queue = cold.tables["resolution"]
    updated, written = approve(queue, RT.empty_registry(spark), "2026-07-28T00:00:00Z", ["Firm"])
    assert {r.dataset: r.columns for r in written.collect()} == {"gl": 8, "tb": 7}
    warm = run(spark, engagement, inputs, stage(updated, "registry"), tmp_path / "warm")
    assert figures(warm.tables["resolution"]) == {"gl": (8, 0, 4, 0), "tb": (7, 0, 0, 0)}
    assert warm.tables["counters"].first().model_calls == 1
    assert register(warm) == GOLDEN
    with pytest.raises(ApprovalError):
        approve(queue, RT.empty_registry(spark), "now", ["No Such Column"])


def test_files_of_one_folder_in_their_own_column_order(spark, engagement, inputs, tmp_path):
    header, *rows = gl_csv().splitlines()
    names = header.split(",")
    turned = [names.index(n) for n in ("Cr Value", "Dr Value", *(n for n in names if n not in ("Cr Value", "Dr Value")))]
    folder = tmp_path / "gl"
    for part in ("p=1", "p=2"):
        (folder / part).mkdir(parents=True)
    other = [",".join(line.split(",")[i] for i in turned) for line in (header, *rows[40:])]
    (folder / "p=1/a.csv").write_text("\n".join([header, *rows[:40]]) + "\n")
    (folder / "p=2/a.csv").write_text("\n".join(other) + "\n")
    (folder / "p=2/none.csv").write_text(header + "\n")
    paths = {"gl": str(folder), "tb": inputs["paths"]["tb"]}
    cold = run(spark, engagement, inputs | {"paths": paths}, RT.empty_registry(spark), tmp_path / "cold")
    updated, _ = approve(cold.tables["resolution"], RT.empty_registry(spark), "now")
    warm = run(spark, engagement, inputs | {"paths": paths}, stage(updated, "registry"), tmp_path / "warm")
    assert sorted(map(str, register(warm))) == sorted(map(str, GOLDEN))
    assert warm.tables["counters"].first().source_files == 4
    totals = sorted((r.source_file, r.rows_received, r.holds) for r in warm.tables["control_total"].collect())
    assert totals[:3] == [("a.csv", len(rows) - 40, True), ("a.csv", 40, True), ("none.csv", 0, True)]
