"""Registered queries against their SQL twins on the smallest tables."""

import pytest
from pyspark.sql import DataFrame

import __spark_entry__ as entry_module
from checks.compare import compare, connect
from checks.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.fixture(scope="module")
def sf():
    return "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, sf, name):
    assert compare(spark, con, name, sf).startswith("ok")


def test_entry(spark):
    df = entry_module.entry(spark)
    assert isinstance(df, DataFrame) and df.count() > 0
    assert set(ORACLES) == set(QUERIES)  # every query outside of the optional part has its twin
    assert set(ORACLES) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())
