import pytest

from tallybook.errors import ExpectationError
from tallybook.operators import derive as G
from tallybook.operators import profile as P


def test_profiles(spark):
    rows = spark.createDataFrame(
        [
            (0, "1", " 1.5", "2025-01-31", "", "x", None),
            (1, "+2", "1e3", "31/1/2025", "  ", "y", "b"),
            (2, " 2 ", "-4", "1-Feb-2025", None, "x", "a"),
            (3, "", "7", "2025-02-28", "", "z", "b"),
        ],
        "row_index bigint, whole string, dec string, day string, blank string, word string, gap string",
    )
    columns = [c for c in rows.columns if c != "row_index"]
    got = {r.column: r for r in P.column_profile(rows, columns, 2).collect()}
    assert {c: got[c].kind for c in columns} == dict(
        whole="integer", dec="decimal", day="date", blank="empty", word="text", gap="text"
    )
    assert (got["whole"].rows, got["whole"].populated, got["whole"].distinct) == (4, 3, 3)
    assert got["whole"].examples == ["1", "+2"]
    assert got["word"].examples == ["x", "y"] and got["gap"].examples == ["b", "a"] and got["blank"].examples == []
    assert [r.row_index for r in P.sample_rows(rows, 2).collect()] == [0, 1]


def test_expectations_gate(spark):
    def measured(value):
        return spark.range(1).selectExpr(f"{value} AS actual")

    suite = G.expectation_suite(
        [G.Expectation("A", "a", "1", measured(1)), G.Expectation("B", "b", "1", measured(2)), G.Expectation("C", "c", "1", measured("NULL"))]
    )
    assert {r.check_id: r.ok for r in suite.collect()} == {"A": True, "B": False, "C": False}
    with pytest.raises(ExpectationError, match="B: expected 1, found 2"):
        G.require(suite)
    G.require(suite.where("ok"))
