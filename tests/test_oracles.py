"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest
from checks.compare import difference, duck
from checks.oracles import ORACLES
from checks.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_same_rows_without_python_and_cross_joins(spark, con, name):
    df = REGISTRY[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("PythonUDF", "ArrowEval", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
    assert difference(df, con, ORACLES[name]) is None
