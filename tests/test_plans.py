"""Plan-shape guarantees for every registered query."""

import re

import pytest

from meterflow.queries import REGISTRY

from paths import SF_SMALL


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = REGISTRY[name].build(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)


# partitions bounded by time, after a distinct; or by the cells and crossings of one polygon in one row of cells;
# or by the distinct values in one range of a group, or by the sample of each task
WINDOWED = {"gaps", "new_missing_by_day", "new_missing_by_month", "within_distance", "license_area_locations", "insert_lag", "missing_first_months", "sample_feeders_by_network"}


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_windows_only_where_partitions_are_bounded(spark, name):
    plan = REGISTRY[name].build(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    if name not in WINDOWED:
        assert not re.search(r"\bWindow\b", plan)
