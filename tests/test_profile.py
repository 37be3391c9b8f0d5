from __future__ import annotations

import pytest

from rollcall.operators import profile
from tests.rows import dicts


@pytest.fixture
def gaps(spark):
    return spark.createDataFrame(
        [(1, "a", 1.5, 10), (2, None, None, 20), (3, "a", 2.5, None), (4, "null", None, None)],
        "`id` int, `la.name` string, rate double, big bigint",
    )


def test_null_counts_keep_zeros_and_dotted_names(gaps):
    counts = {r["column_name"]: r["null_count"] for r in dicts(profile.null_counts(gaps))}
    assert counts == {"id": 0, "la.name": 1, "rate": 2, "big": 2}


def test_null_profile_lists_only_columns_with_nulls(gaps):
    found = {r["column_name"]: (r["null_count"], r["null_percent"])
             for r in dicts(profile.null_profile(gaps))}
    assert found == {"la.name": (1, 25.0), "rate": (2, 50.0), "big": (2, 50.0)}


def test_profiles_of_an_empty_table(gaps):
    empty = gaps.limit(0)
    assert {r["null_count"] for r in dicts(profile.null_counts(empty))} == {0}
    assert dicts(profile.null_profile(empty)) == []
    assert dicts(profile.table_status(empty)) == [{"row_count": 0, "column_count": 4}]


def test_table_status(gaps):
    assert dicts(profile.table_status(gaps)) == [{"row_count": 4, "column_count": 4}]


def test_preview_shows_the_first_rows_and_columns(gaps):
    rows = dicts(profile.preview(gaps, order_by=["id"], rows=3, columns=2))
    counts = {"shown_rows": 3, "total_rows": 4, "shown_columns": 2, "total_columns": 4}
    assert rows == [
        {"id": 1, "la.name": "a", **counts},
        {"id": 2, "la.name": None, **counts},
        {"id": 3, "la.name": "a", **counts},
    ]


def test_preview_of_a_small_table_shows_all(gaps):
    rows = dicts(profile.preview(gaps, order_by=["id"], rows=10))
    assert len(rows) == 4 and rows[0]["shown_rows"] == 4 and rows[0]["shown_columns"] == 4


def test_numeric_columns_include_every_numeric_type(spark):
    df = spark.sql(
        "SELECT 1 AS i, 1L AS l, 1.5D AS d, CAST(1 AS FLOAT) AS f, 1S AS s, 1Y AS b,"
        " 1.5BD AS dec, 'x' AS t, true AS flag, current_date() AS day"
    )
    assert profile.numeric_columns(df) == ["i", "l", "d", "f", "s", "b", "dec"]


def test_numeric_summary(gaps):
    rows = {r.pop("column_name"): r for r in dicts(profile.numeric_summary(gaps))}
    def row(count, mean, least, most):
        return {
            "non_null_count": count, "mean": mean, "minimum": float(least),
            "maximum": float(most), "minimum_exact": str(least), "maximum_exact": str(most),
        }

    assert rows["id"] == row(4, 2.5, 1, 4)
    assert rows["rate"] == row(2, 2.0, 1.5, 2.5)
    assert rows["big"] == row(2, 15.0, 10, 20)
    assert list(rows) == ["id", "rate", "big"]


def test_extremes_beyond_doubles_are_exact(spark):
    found = profile.numeric_summary(spark.sql("SELECT 9007199254740993L AS n")).first()
    assert found["minimum_exact"] == found["maximum_exact"] == "9007199254740993"


def test_status_counts_the_columns_of_the_files(spark, tmp_path):
    wide = spark.range(3).selectExpr("id", *[f"id AS c{k}" for k in range(11)])
    wide.write.parquet(str(tmp_path / "wide"))
    found = profile.table_status(spark.read.parquet(str(tmp_path / "wide")))
    assert tuple(found.first()) == (3, 12)


def test_numeric_summary_without_numbers(gaps):
    with pytest.raises(ValueError):
        profile.numeric_summary(gaps.select("`la.name`"))


def test_distinct_values_and_counts_are_sorted_without_null(gaps):
    assert [tuple(r) for r in profile.distinct_values(gaps, "la.name").collect()] == [
        ("a",),
        ("null",),
    ]
    assert [tuple(r) for r in profile.value_counts(gaps, "la.name").collect()] == [
        ("a", 2),
        ("null", 1),
    ]


def test_periods_are_text_in_order(spark):
    df = spark.createDataFrame([(200001,), (199900,), (200001,)], "time_period int")
    assert [tuple(r) for r in profile.available_periods(df).collect()] == [("199900",), ("200001",)]
