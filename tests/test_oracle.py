"""Every registered climate query against its SQL."""

import os

import oracle
import pytest

from isohyet.plans import catalogue, catalogue_runs  # noqa: F401  both register queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query_matches_sql(spark, con, name):
    assert oracle.differences(catalogue.QUERIES[name](spark, SF), con, catalogue.ORACLE_SQL[name]) == []
