"""Every registered query against its oracle, and what its plan must not contain."""

import pytest

from __spark_entry__ import entry, queries
from catalog.oracles import ORACLES
from catalog.queries import QUERIES
from check import compare, connect

SF = "/root/testdata/sf0.001"
NAMES = list(ORACLES)


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    assert entry(spark).columns == ["arl", "pel"] and entry(spark).count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, oracle, name):
    assert compare(spark, oracle, SF, name) == ""


@pytest.mark.parametrize("name", NAMES)
def test_plan(spark, setting, name):
    """No cross join, no nested loop, no Python, nothing gathered into one window.

    Block numbers are summed in windows, of 4096 blocks each and of those sums.
    """
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    plan = plan if name != "decrypt_blocks_lines" else plan.replace("Window [sum(ends", "")
    for operator in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "Window", "ExistingRDD", "BroadcastExchange"):
        assert operator not in plan, operator
