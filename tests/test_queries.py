"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as driver
from oracle import compare
from workloads.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert QUERIES.keys() <= driver.queries().keys()
    assert QUERIES.keys() <= driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, name):
    assert compare(driver.queries()[name](spark, SF_DIR), driver.oracle_sql()[name], SF_DIR) > 0


def test_entry(spark):
    assert driver.entry(spark).columns == ["work_id", "referenced_work_id"]
