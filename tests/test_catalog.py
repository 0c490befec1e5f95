"""Every registered query against its SQL counterpart, on the smallest data."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from compare import DATA, compare, duck
from wattloom.catalog import ORACLE, QUERIES

SF_DIR = f"{DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["k8_indicators", "w9_interpolate_linear", "q7_summary", "m14_compare_scenarios", "i4_series_features"])
def test_plans_never_gather_rows_in_one_task(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["k8_indicators"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for schema in (s.split(">")[0] for s in plan.split("ReadSchema: struct<")[1:]):
        assert "o_orderpriority" not in schema and "l_tax" not in schema and "c_acctbal" not in schema
