"""Every named query against its SQL, and the shape of its plan."""

import re

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_result_and_plan(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("PythonUDF", "EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoop"):
        assert node not in plan, node
    assert not re.search(r"Window.*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        problem = difference(df, con, sql)
        assert problem is None, problem


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
