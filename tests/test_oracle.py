"""Every registered query against its SQL on the smallest sample."""

import os

import pytest

from checks.compare import compare, duck
from checks.oracle import ORACLE
from checks.registry import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="sample tables not there")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    verdict, _ = compare(spark, con, SF, name)
    assert verdict.startswith("equal"), verdict
