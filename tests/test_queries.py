"""Every registered query against its SQL, over the smallest folder."""

from pathlib import Path

import pytest
from compare import compare, connect

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    _, verdict = compare(spark, con, FOLDER, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert verdict.startswith(("ok", "rows only")), verdict


def test_planted_figures(spark):
    found = entry.entry(spark)
    counts = {r.control_id: r["count"] for r in found.groupBy("control_id").count().collect()}
    assert counts == {"C1": 9, "C2": 29, "C3": 3, "C4": 213, "C5": 21, "C6": 1, "DEDUPE": 29}
