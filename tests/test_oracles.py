"""Every registered query against its SQL counterpart."""

import pytest
from compare import connect, differences

import __spark_entry__ as contract
from roadpulse.plans.oracles import ORACLES
from roadpulse.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    df = contract.queries()[name](spark, sf_dir)
    assert differences(df, con, contract.oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert not contract.entry(spark).isEmpty()
