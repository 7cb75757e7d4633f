"""Every registered query against its SQL on the smallest driver tables."""

import os

import pytest

from checks.compare import compare, duck
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF_DIR, QUERIES[name], ORACLE[name]) is None


def test_entry(spark):
    import __spark_entry__ as driver

    df = driver.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["order_line_sk", "order_id", "line_id"]
    # What the training-data part adds is tested with it.
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())
