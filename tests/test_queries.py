"""Every registered reporting query against its SQL, and plan shapes at the scan."""

import __spark_entry__ as driver
import pytest
from helpers import plan
from oracle import compare, connect

from muster import gallery

SF = "/root/testdata/sf0.001"
QUERIES, SQL = gallery.callables(), gallery.sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    count, difference = compare(QUERIES[name](spark, SF), duck, SQL[name])
    assert difference is None
    assert count >= 0


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.keys() <= driver.queries().keys() and SQL.items() <= driver.oracle_sql().items()


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["month_to_date", "previous_month", "last_30_days", "planned_next_60d"])
def test_date_filters_reach_the_scan(spark, name):
    assert "GreaterThanOrEqual(o_orderdate" in plan(QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", [
    "range_lookup", "asof_latest_before", "contiguous_predecessor", "next_group_event", "exclude_matching", "date_dimension_join",
    "any_link_match", "group_switches", "mobilisation_documents", "mobilisation_declared", "mobilisation_appraisals",
])
def test_no_nested_loops(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "NestedLoop" not in text and "Cartesian" not in text
