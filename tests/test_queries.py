"""Every registered query against its SQL answer."""

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

import __spark_entry__ as entry  # noqa: E402
from check_queries import compare  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
# the queries of the llm subpackage have tests of their own
OWN_TESTS = {*(entry.llm.queries() if entry.llm else ()), "pipeline"}
NAMES = sorted(set(entry.queries()) - OWN_TESTS)


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    assert compare(spark, FOLDER, name, []) == ""


def test_every_query_has_sql():
    assert set(NAMES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
def test_entry(spark):
    top = entry.entry(spark).collect()
    assert len(top) == 10 and all(row["name"].startswith("s") for row in top)
