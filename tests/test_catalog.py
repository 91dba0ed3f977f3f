"""Every registered query against its SQL, plain and with sliced plans, and what plans must not hold."""

import re

import pytest

from tidemark import catalog
from tools.check import compare, connect

catalog.load()
SLICED = [
    "rolling_mean_lagged", "feature_row", "supervised_windows", "expanding_mean", "monotonic_check", "asof_join_ttl",
    "asof_multi_view", "asof_forward", "temporal_split", "stratified_split", "classification_report", "roc_points",
    "ks_drift", "wasserstein", "describe", "median_prune", "pareto_front", "best_so_far", "feature_label_split",
]


@pytest.fixture(scope="module")
def duck(request):
    from conftest import SMALL

    return connect(SMALL)


def check_plan(df):
    """No pairing of rows, no row-at-a-time Python, nothing large ordered in one task."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert word not in plan
    for line in plan.splitlines():
        if "Window [" in line and re.search(r"windowspecdefinition\((specified|__slice#\d+L? ASC)", line):
            # only the sums per slice, at most MAX_SLICES rows, are ordered in one task
            assert "__from_" in line or "__all_" in line


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_matches_sql(spark, duck, small, name):
    got = catalog.QUERIES[name](spark, small)
    check_plan(got)
    assert compare(spark, duck, name, small, got) is None


@pytest.mark.parametrize("name", SLICED)
def test_sliced_plan_matches_sql(spark, duck, small, sliced, name):
    assert compare(spark, duck, name, small) is None


def test_names_and_sql_agree():
    assert set(catalog.SQL) <= set(catalog.QUERIES)
    assert not [n for n in catalog.QUERIES if "pipeline" in n or re.match(r"op\d", n)]
