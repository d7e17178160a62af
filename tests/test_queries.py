"""Every query against its SQL, and the shape of its plan."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from fernway.plans.catalog import QUERIES
from oracle import compare, duck

SF = "/root/testdata/sf0.001"
WITHOUT_SQL = {"ann_top_k", "score_rouge_l"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


# The training-data queries have tests of their own beside them.
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    sql = oracle_sql().get(name)
    if sql is None:
        assert name in WITHOUT_SQL
        assert df.count() > 0
    else:
        assert compare(df, sql, con) is None


def test_entry(spark):
    assert entry(spark).count() > 0
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) & set(QUERIES) | WITHOUT_SQL == set(QUERIES)
