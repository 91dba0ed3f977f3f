"""The package's queries against their SQL, the registry, and what native queries must not use."""

import re

import pytest

import __spark_entry__ as entry
from tidemark import catalog
from tidemark.llm import queries as q
from tools.check import compare, connect


@pytest.fixture(scope="module")
def registered():
    catalog.load()
    added = set(q.QUERIES) - set(catalog.QUERIES)
    catalog.QUERIES.update(q.QUERIES)
    catalog.SQL.update(q.SQL)
    yield
    for name in added:
        catalog.QUERIES.pop(name)
        catalog.SQL.pop(name, None)


@pytest.mark.parametrize("name", sorted(q.SQL))
def test_query_matches_sql(spark, small, registered, name):
    assert compare(spark, connect(small), name, small) is None


def test_every_operator_is_registered_once():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in q.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(q.QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["op3_systematic_mix", "op7_histogram_shards"])
def test_native_plans_run_no_python(spark, small, name):
    plan = q.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
