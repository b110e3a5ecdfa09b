"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check import compare
from engage.plans import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    ok, detail, _ = compare(spark, FOLDER, name, registry.oracle_sql()[name])
    assert ok, detail


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.queries()) == set(registry.oracle_sql())


def test_entry_has_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["cycle", "churned_users", "total_users", "churn_rate"]
    assert df.count() == 6
