from __future__ import annotations

import pytest

from rollcall.operators import cleaning
from tests.rows import dicts

pytestmark = pytest.mark.usefixtures("both_ansi")
SCHEMA = "id int, gaps int, big bigint, rate double, marked string, full string"
ROWS = [
    (1, 5, 7, 0.5, "12", ":"),
    (2, None, None, None, None, "x"),
    (3, 6, 8, 1.5, ":", "null"),
]


@pytest.fixture
def dirty(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_numbers_fill_only_32_bit_integers(dirty):
    filled = cleaning.fill_null_numbers(dirty)
    assert filled.dtypes == dirty.dtypes
    assert _rows(filled)[1] == (2, -1, None, None, None, "x")


def test_texts(dirty):
    filled = cleaning.fill_null_texts(dirty)
    assert _rows(filled)[1] == (2, None, None, None, "MISSING", "x")


def test_suppressed_only_where_the_column_has_nulls(dirty):
    replaced = cleaning.replace_suppressed(dirty)
    assert replaced.dtypes == dirty.dtypes
    # ``full`` has no NULL, so its ":" stays; integer columns are left alone.
    assert _rows(replaced) == [ROWS[0], ROWS[1], (3, 6, 8, 1.5, "-1", "null")]


def test_suppressed_in_named_columns(dirty):
    replaced = cleaning.replace_suppressed(dirty, columns=["full", "gaps"])
    assert _rows(replaced) == [(1, 5, 7, 0.5, "12", "-1"), ROWS[1], ROWS[2]]


def test_clean_is_the_three_steps_together(dirty):
    cleaned = cleaning.clean_nulls(dirty)
    assert cleaned.dtypes == dirty.dtypes
    assert _rows(cleaned) == [
        (1, 5, 7, 0.5, "12", ":"),
        (2, -1, None, None, "MISSING", "x"),
        (3, 6, 8, 1.5, "-1", "null"),
    ]
    named = cleaning.clean_nulls(dirty, suppressed=["gaps", "big", "rate", "marked"])
    assert _rows(named) == _rows(cleaned)


def test_remaining_nulls_are_those_of_other_types(dirty):
    left = {r["column_name"]: r["remaining_nulls"] for r in dicts(cleaning.remaining_nulls(dirty))}
    assert left == {"gaps": 0, "big": 1, "rate": 1, "marked": 0}


def test_cleaning_an_empty_or_textless_table(spark, dirty):
    assert cleaning.clean_nulls(dirty.limit(0)).collect() == []
    assert _rows(cleaning.clean_nulls(spark.createDataFrame([(None,)], "n int"))) == [(-1,)]


def test_sum_over_suppressed_numbers(spark):
    df = spark.createDataFrame([("5",), (":",), (None,), ("7",), ("MISSING",)], "n string")
    assert dicts(cleaning.suppressed_sum(df, "n")) == [{"n_sum": 12}]


def _jobs(spark, run):
    tracker, group = spark.sparkContext.statusTracker(), f"counted-{id(run)}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = run()
        return result, len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_saving_and_counting_is_one_job(spark, dirty, tmp_path):
    path = str(tmp_path / "cleaned")
    found, jobs = _jobs(
        spark, lambda: cleaning.save_cleaned(dirty.repartition(1), path, "parquet", ["marked"])
    )
    assert jobs == 1 + 1  # the shuffle of this test's repartition, and the write
    assert {tuple(r) for r in found.collect()} == {
        ("id", 0, 0), ("gaps", 1, 0), ("big", 1, 1), ("rate", 1, 1), ("marked", 1, 0), ("full", 0, 0),
    }
    assert _rows(spark.read.parquet(path)) == _rows(cleaning.clean_nulls(dirty, ["marked"]))


def test_saving_an_empty_table_counts_nothing(dirty, tmp_path):
    found = cleaning.save_cleaned(dirty.limit(0), str(tmp_path / "none"))
    assert {tuple(r)[1:] for r in found.collect()} == {(0, 0)}
