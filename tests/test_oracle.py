"""Every query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from fleetspark.workload.oracle import ORACLE
from fleetspark.workload.queries import QUERIES
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    frame = QUERIES[name](spark, SF)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert difference(frame, sql.execute(ORACLE[name])) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
