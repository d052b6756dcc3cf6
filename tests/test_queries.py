import pytest

import __spark_entry__
from climora.catalogue import ingestion, landings, modelling, published
from compare import connect, difference

SF = "/root/testdata/sf0.001"
QUERIES = {**ingestion.QUERIES, **modelling.QUERIES, **published.QUERIES, **landings.QUERIES}
ORACLE = __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, oracle, name):
    assert name in ORACLE
    frame = __spark_entry__.queries()[name](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "strategy=broadcast" not in frame._jdf.queryExecution().optimizedPlan().toString()
    rows, off = difference(frame, oracle, ORACLE[name])
    assert not off
    assert rows > 0


def test_flagship(spark):
    assert __spark_entry__.entry(spark).columns == ["period", "avg_temp", "admission_count"]
