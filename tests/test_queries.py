"""Every registered query against its SQL twin."""

import pytest

import __spark_entry__ as contract
from suite import check, oracles, queries


@pytest.fixture(scope="module")
def con(sf_dir):
    return check.connect(sf_dir)


@pytest.mark.parametrize("name", list(queries.ALL))
def test_query_equals_its_sql(spark, con, sf_dir, name):
    _, _, problem = check.compare(spark, con, sf_dir, name)
    assert problem is None or (name == "validation_report" and problem == "rows only")


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(queries.ALL) - set(oracles.ALL) == {"validation_report"}
    assert contract.entry(spark).count() == 12
