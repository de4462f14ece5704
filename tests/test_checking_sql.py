"""Every registered query against its SQL, on whole tables at the smallest scale."""

import pytest

from millrace.registry import all_queries
from tests.conftest import SMALL
from tools.check import compare, connect

QUERIES = all_queries()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_matches_sql(spark, con, name):
    problem, n = compare(QUERIES[name].run(spark, SMALL), con, QUERIES[name].sql)
    assert problem is None, problem
    assert n > 0 or name in {"flt11_on_day", "job10_daily_summary_one_day", "agg06_having"}


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if not q.sql])
def test_runs_without_sql(spark, name):
    assert QUERIES[name].run(spark, SMALL).count() > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 6
    assert set(entry.oracle_sql()) <= set(entry.queries())
