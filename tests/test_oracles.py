"""Every checked query against its SQL counterpart, on the smallest data."""

import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.registry import QUERIES


@pytest.fixture(scope="module")
def connection(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, connection, name):
    assert difference(spark, connection, sf, name) is None


def test_contract(spark):
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())
    flagship = contract.entry(spark)
    assert flagship.columns == ["block_latid", "block_lonid", "time_slot", "rn", "longitude", "latitude", "passengers"]
    assert not flagship.isEmpty()


@pytest.mark.parametrize("name", ["hotspots", "suggest", "arrivals", "playback", "amplify_lines", "resolve_ids", "clean_positions"])
def test_no_python_in_the_plans(spark, sf, plan, name):
    text = plan(QUERIES[name](spark, sf))
    assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text and "NestedLoop" not in text
