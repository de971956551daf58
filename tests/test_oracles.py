"""Every registered query gives what its plain SQL gives, and is registered with SQL."""

import __spark_entry__ as entry
import oracle
import pytest

from eventmart.plans.oracles import oracle_statements
from eventmart.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return oracle.connect(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle_statements()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, folder, name):
    plans = []
    problems, _, _, _ = oracle.compare(spark, con, name, folder, plans.append)
    assert not problems
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in plans[0]


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
