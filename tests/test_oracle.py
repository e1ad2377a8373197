"""Every registered query against its SQL twin on the small tables."""

import pytest
from small import SMALL

import compare
from caselabel.catalog import REGISTRY


@pytest.fixture(scope="module")
def con():
    return compare.oracle(SMALL)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    found = compare.run(spark, con, name, REGISTRY[name], SMALL)
    assert not found, found
