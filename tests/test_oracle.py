"""Every registered query against its SQL, on the whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from rollcall.catalog import ORACLES, QUERIES
from tests.oracle import connect, differences

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, duck, key):
    df = QUERIES[key](spark, DATA)
    assert differences(duck, ORACLES[key], df) == []


def test_every_query_of_the_library_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_returns_rows_per_region_and_year(spark):
    df = driver.entry(spark)
    assert df.columns == ["region_name", "time_period", "avg_attendance", "avg_absence"]
    assert df.count() > 0
