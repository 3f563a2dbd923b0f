"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from sunledger.plans.queries import REGISTERED
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(REGISTERED) <= set(oracle_sql()) and set(REGISTERED) <= set(queries())


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query(spark, con, name):
    problem = compare(spark, con, queries()[name], oracle_sql()[name], SF_DIR)
    assert problem is None, problem


def test_entry(spark):
    assert entry(spark).columns == ["site_id", "timestamp", "source_dataset_id", "schema_version", "power_w"]
