"""Every registered query against its SQL twin on the smoke tables."""

import pytest

import __spark_entry__ as entry
from siltlake.plans.queries import REGISTRY
from oracle_check import compare, sql_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return sql_session(SF)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "user_id" and df.count() > 0


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_merged_state_of_the_late_split(spark):
    """Rows and inactive rows at the smallest scale."""
    merged = entry.queries()["silver_merge_late"](spark, SF)
    assert merged.count() == 250 and merged.filter("NOT is_active").count() == 64
