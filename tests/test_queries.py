"""Every registered query against its SQL, and the list of operators they cover."""

import re
from importlib import import_module
from pathlib import Path

import pytest

from tests.oracle_check import compare, connect
from tidemill.plans import all_queries

FOLDER = "/root/testdata/sf0.001"
QUERIES = all_queries()
# Operators to be covered, by inventory section.
INVENTORY = [("S", 14), ("K", 16), ("P", 22), ("J", 14), ("A", 28), ("W", 4), ("O", 4), ("Q", 3), ("F", 18),
             ("R", 6), ("U", 3), ("V", 12), ("E", 7)]


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_agrees_with_sql(spark, con, name):
    assert compare(QUERIES[name].run(spark, FOLDER), con, QUERIES[name].sql) is None


def test_every_operator_has_a_query():
    covered = {c for q in QUERIES.values() for c in q.covers}
    assert [f"{s}{i}" for s, n in INVENTORY for i in range(1, n + 1) if f"{s}{i}" not in covered] == []


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_coverage_list_is_up_to_date():
    text = (Path(__file__).parents[1] / "COVERAGE.md").read_text()
    assert [n for n in QUERIES if f"`{n}`" not in text] == []
    for function in re.findall(r"`((?:sources|operators|streaming|functions|jobs)\.\w+\.\w+)`", text):
        module, _, name = function.rpartition(".")
        assert hasattr(import_module(f"tidemill.{module}"), name), function
