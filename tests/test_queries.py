"""Every registered query against its SQL twin."""

import os

import pytest

from __spark_entry__ import entry
from fixtures.oracle import ORACLE
from fixtures.queries import REGISTRY
from tests.compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(REGISTRY) == set(ORACLE)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["ano", "cargo", "total", "pct"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    assert differences(REGISTRY[name](spark, SF_DIR), con, ORACLE[name]) == []
