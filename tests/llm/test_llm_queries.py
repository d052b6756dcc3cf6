import pytest

import __spark_entry__
from climora.llm.queries import QUERIES
from compare import connect, difference

SF = "/root/testdata/sf0.001"
WITH_SQL = sorted(n for n, (_, sql) in QUERIES.items() if sql)


def test_all_are_registered():
    names = set(__spark_entry__.queries())
    assert set(QUERIES) <= names and "pipeline" in QUERIES
    assert {n.split("_")[0] for n in QUERIES} == {"pipeline", *(f"op{k}" for k in range(1, 14))}


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_equals_its_sql(spark, name):
    rows, off = difference(QUERIES[name][0](spark, SF), connect(SF), QUERIES[name][1])
    assert rows and not off


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join(spark, name):
    plan = QUERIES[name][0](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
