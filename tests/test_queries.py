"""Every registered query against its SQL twin, on the small tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as contract
import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_twin():
    assert set(catalogue.ORACLES) == set(catalogue.QUERIES)
    assert set(catalogue.QUERIES) <= set(contract.queries())
    assert set(catalogue.ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    query, oracle = contract.queries()[name], contract.oracle_sql()[name]
    assert differences(spark, con, SF, query, oracle) == []


@pytest.mark.parametrize("name", ["browser_counts_1d", "browser_counts_1h"])
def test_ordered_results_are_in_order(spark, name):
    rows = contract.queries()[name](spark, SF).collect()
    keys = [(r.window_time, -r.cnt_browser) for r in rows]
    assert keys == sorted(keys)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
