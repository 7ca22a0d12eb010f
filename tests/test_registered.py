"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as registered
from tests.oracle_check import connect, differences

SF_DIR = "/root/testdata/sf0.001"
NAMES = sorted(registered.QUERIES)


@pytest.fixture(scope="module")
def sql():
    return registered.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, sql, name):
    assert differences(registered.queries()[name](spark, SF_DIR), con, sql[name]) is None


def test_every_query_has_sql(sql):
    assert set(NAMES) <= set(sql)


def test_entry(spark):
    assert registered.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["classify_rows", "regulatory_report", "vendor_risk", "sla_breach", "record_hash", "event_decode"])
def test_plans_stay_in_the_jvm(spark, name):
    plan = registered.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
