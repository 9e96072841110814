"""Every registered query against its SQL on the smallest tables."""

import pytest

from docloom.plans import catalog
from tests import oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.duck(FOLDER)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, con, name):
    diff, _ = oracle.differences(catalog.QUERIES[name](spark, FOLDER), con, catalog.ORACLES[name])
    assert diff is None


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, FOLDER).count() > 0
