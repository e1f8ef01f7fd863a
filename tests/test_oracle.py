"""Every registered query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as contract
from check_oracle import compare, connect
from touchline.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, con, name):
    outcome, _rows = compare(spark, con, name, SF)
    assert outcome == "ok"


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(contract.queries())
