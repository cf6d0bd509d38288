"""Duplicates: groups, members, journals, hot keys and what the evidence says."""

import datetime as dt
import hashlib
from collections import defaultdict
from decimal import Decimal

import pytest
from ledgers import detail, line
from pyspark.sql import functions as F

from catalog.queries import QUERIES
from tallybook.operators import dedupe as D
from tallybook.schemas import DETAIL_RULES

T = Decimal("1000.00")


def findings(spark, lines):
    candidates = D.duplicate_candidates(detail(spark, lines))
    described = D.described_groups(candidates)
    rows = D.dedupe_findings(described, T).orderBy("block", "sort_row").collect()
    return rows, candidates, described


def test_exact_pair(spark):
    lines = [line("J-001", "6000", "1200"), line("J-001", "6000", "1200"), line("J-001", "1000", "0", "2400", 2)]
    (found,), _, described = findings(spark, lines)
    assert (found.journal_id, found.account_code, found.value, found.record_count) == ("J-001", "6000", Decimal("1200.00"), 2)
    key = "\x1f".join(["AU01", "6000", "2025-08-01", "J-001", "1", "1200.00", "0.00", ""])
    digest = hashlib.sha256(key.encode()).hexdigest()
    assert found.evidence.endswith(f"hash {digest[:12]}") and ": first at population row 0, last at 1, journal" in found.evidence
    decision = D.duplicate_decisions(described, F.current_timestamp()).first()
    assert decision.decision_id == f"DUP-EXACT-{digest[:12]}"
    assert (decision.first_row, decision.last_row, decision.journals, decision.reversible) == (0, 1, 1, True)


def test_exact_and_suspected_overlap_and_one_journal_is_not_suspect(spark):
    lines = [
        line("J-B", "6000", "10"), line("J-B", "6000", "10"), line("J-A", "6000", "10"),
        line("J-C", "7000", "3"), line("J-C", "7000", "3", line_no=2),
    ]
    rows, _, _ = findings(spark, lines)
    assert [(r.sort_code, r.record_count, r.journal_id) for r in rows] == [("EXACT", 2, "J-B"), ("SUSPECTED", 3, None)]
    assert "under 2 journal identifiers: first at population row 0, last at 2" in rows[1].evidence
    assert rows[1].value == Decimal("20.00")


def brute_force(lines):
    exact, suspected = defaultdict(list), defaultdict(list)
    for i, l in enumerate(lines):
        exact[tuple(l[c] for c in D.EXACT_KEY)].append(i)
        suspected[tuple(l[c] for c in D.SUSPECTED_KEY)].append(i)
    found = [("EXACT", tuple(v)) for v in exact.values() if len(v) > 1]
    found += [
        ("SUSPECTED", tuple(v)) for v in suspected.values()
        if len({lines[i]["journal_id"] for i in v}) > 1
    ]
    return sorted(found)


@pytest.mark.parametrize("hot_rows", [10, 1_000_000])
def test_a_third_of_all_rows_under_one_key(spark, hot_rows):
    hot = [line(f"J-{i % 7}", "9", "1", line_no=1 + i % 3) for i in range(300)]
    rest = [line(f"K-{i}", str(i % 40), str(i % 11)) for i in range(600)]
    lines = [row for trio in zip(hot, rest[:300], rest[300:]) for row in trio]
    candidates = D.duplicate_candidates(detail(spark, lines), hot_rows=hot_rows)
    members = D.duplicate_members(candidates, index_range=50, hot_rows=hot_rows).collect()
    got = defaultdict(list)
    for m in members:
        got[m.decision_id].append(m)
    for group in got.values():
        group.sort(key=lambda m: m.occurrence)
        assert [m.occurrence for m in group] == list(range(1, len(group) + 1))
        assert len(group) == group[0].group_rows
    assert sorted((g[0].kind, tuple(m.row_index for m in g)) for g in got.values()) == brute_force(lines)


@pytest.mark.parametrize("size", [100, 101, 250])
def test_a_group_of_any_size_has_one_shape_of_evidence_and_all_its_rows(spark, size):
    lines = [line(f"J-{i // 2}", "9", "1", line_no=i) for i in range(size)]
    (found,), candidates, described = findings(spark, lines)
    journals = -(-size // 2)
    assert f"under {journals} journal identifiers: first at population row 0, last at {size - 1};" in found.evidence
    assert found.value == Decimal(size - 1)
    assert D.duplicate_decisions(described, F.current_timestamp()).first().journals == journals
    assert sorted(r.row_index for r in D.duplicate_members(candidates).collect()) == list(range(size))
    held = {r.journal_id: r.lines for r in D.duplicate_journals(candidates).collect()}
    assert len(held) == journals and sum(held.values()) == size


def test_population_is_left_alone(spark):
    rows = detail(spark, [line("J", "1", "5"), line("J", "1", "5")])
    D.duplicate_candidates(rows)
    assert D.population_unchanged(rows, rows).collect() == []
    changed = {r.change: r.rows for r in D.population_unchanged(rows, rows.limit(1)).collect()}
    assert changed == {"lost": 1}
    assert set(DETAIL_RULES) < set(rows.columns)


def test_changes_both_ways_come_of_one_grouping_over_the_rows(spark):
    two, one = line("J", "1", "5"), {**line("K", "2"), "credit": None}
    before = detail(spark, [two, two, one, two]).drop("row_index")
    after = detail(spark, [two, one, one, one]).drop("row_index")
    changes = D.population_unchanged(before, after)
    assert {r.change: r.rows for r in changes.collect()} == {"lost": 2, "added": 2}
    plan = changes._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("Aggregate") == 2


def test_keys_are_counted_by_a_hash_and_a_missing_field_equals_none(spark):
    missing = {**line("J", "1", "5"), "account_code": None}
    rows = detail(spark, [missing, missing, line("J", "1", "5"), line("K", "1", "5"), line("K", "2", "5")])
    assert [d for _, d in D.repeated_keys(rows).dtypes] == ["bigint", "bigint"]
    assert sorted(r.row_index for r in D.duplicate_candidates(rows).collect()) == [2, 3]


def test_digests_are_derived_and_not_written(spark):
    lines = [line("J-001", "6000", "1200"), line("J-001", "6000", "1200"), line("J-002", "6000", "1200")]
    candidates = D.duplicate_candidates(detail(spark, lines))
    written = spark.read.parquet(*candidates.inputFiles()).columns
    assert not {"exact_key", "suspected_key"} & set(written) and {"exact_key", "suspected_key"} < set(candidates.columns)
    key = "\x1f".join(["AU01", "6000", "2025-08-01", "1200.00", "0.00"])
    (found,) = D.suspected_groups(candidates).collect()
    assert (found.digest, found.group_rows, found.journals) == (hashlib.sha256(key.encode()).hexdigest(), 3, 2)


def test_a_scan_of_candidates_has_few_of_them_a_task(spark, monkeypatch):
    monkeypatch.setattr(D, "CANDIDATES_PER_FILE", 10)
    twice = [line(f"J-{k}", "6000", str(k % 50 + 1)) for k in range(100)]
    candidates = D.duplicate_candidates(detail(spark, twice))
    assert candidates.count() == 100 and len(candidates.inputFiles()) >= 10
    per_file = candidates.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert per_file <= 10


@pytest.mark.parametrize("hot_rows", [3, 1_000_000])
def test_the_evidence_of_an_exact_group_with_rows_lists_all_its_lines(spark, hot_rows):
    twin, other = line("J-1", "9", "1"), line("J-2", "8", "2")
    lines = [twin if i % 3 else (other if i % 2 else line(f"K-{i}", "9", "1")) for i in range(300)]
    candidates = D.duplicate_candidates(detail(spark, lines))
    exact = D.described_groups(candidates).where("kind = 'EXACT'")
    listed = D.with_rows(exact, candidates, index_range=7, hot_rows=hot_rows)
    found = {r.journal_id: r.evidence for r in D.dedupe_findings(listed, T).collect()}
    assert set(found) == {"J-1", "J-2"}
    for journal, same in (("J-1", twin), ("J-2", other)):
        places = ", ".join(str(i) for i, row in enumerate(lines) if row == same)
        assert f"credit 0.00; population rows {places}; hash " in found[journal]


def test_the_query_of_exact_duplicates_lists_all_their_lines(spark, tmp_path):
    def posted(order, part, price, copies=1):
        return [(order, part, 1, price, "N", dt.datetime(1997, 3, 1))] * copies

    rows = posted(10, 3, 50.0, 4) + posted(500, 4, 60.0) + posted(20, 5, 70.0)
    columns = "l_orderkey long, l_partkey long, l_linenumber int, l_extendedprice double, l_returnflag string, l_shipdate timestamp"
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    # Sorted by journal as text: the four lines of J10 and its contra, two of J20, then J500 and its planted copy.
    found = {r.journal_id: r.evidence for r in QUERIES["dedupe_exact"](spark, str(tmp_path)).collect()}
    assert set(found) == {"J10", "J500"}
    assert "; population rows 0, 1, 2, 3; hash " in found["J10"]
    assert "; population rows 7, 8; hash " in found["J500"]
