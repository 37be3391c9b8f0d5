"""Every registered query that SQL can express against its SQL, on the whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from rollcall.llm.catalog import ORACLES, QUERIES
from tests.oracle import connect, differences

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_equals_sql(spark, duck, key):
    assert differences(duck, ORACLES[key], QUERIES[key](spark, DATA)) == []


def test_thirteen_operators_and_the_pipeline_are_registered():
    numbers = sorted(int(key[2:].split("_")[0]) for key in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
