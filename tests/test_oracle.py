"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest
from compare import compare, duck
from helpers import TINY

from martwright.registry import CASES


@pytest.fixture(scope="module")
def con():
    return duck(TINY)


@pytest.mark.parametrize("name", list(CASES))
def test_query_matches_sql(spark, con, name):
    assert CASES[name].sql, "every query states its result in SQL"
    df = CASES[name].run(spark, TINY)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
    assert compare(spark, con, TINY, name, df) == ""
