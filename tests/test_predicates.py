from __future__ import annotations

import pytest

from rollcall.operators import predicates as p
from tests.rows import authority, mart, regional, school

pytestmark = pytest.mark.usefixtures("both_ansi")


@pytest.fixture
def df(spark):
    rows = [
        (1, 10, "7", "North", 1.5),
        (2, 200, ":", "null", 2.5),
        (3, 1200, None, None, None),
        (4, None, "x", "Northern", 12.0),
    ]
    return spark.createDataFrame(rows, "id int, n bigint, mixed string, region string, rate double")


def _ids(df, condition):
    return sorted(row["id"] for row in df.filter(condition).collect())


def test_equal_values_come_as_text_or_number(df):
    assert _ids(df, p.equals(df, "n", "200")) == [2]
    assert _ids(df, p.equals(df, "n", 200)) == [2]
    assert _ids(df, p.equals(df, "rate", "1.5")) == [1]
    assert _ids(df, p.equals(df, "region", "North")) == [1]
    assert _ids(df, p.equals(df, "mixed", 7)) == [1]


def test_a_value_of_another_kind_matches_nothing(df):
    assert _ids(df, p.equals(df, "n", "many")) == []
    assert _ids(df, p.differs(df, "n", "many")) == []
    assert _ids(df, p.equals(df, "rate", "North")) == []


def test_null_rows_drop_out_of_not_equal(df):
    assert _ids(df, p.differs(df, "n", "200")) == [1, 3]
    assert _ids(df, p.differs(df, "region", "North")) == [2, 4]


def test_greater_and_less_on_numbers_and_texts(df):
    assert _ids(df, p.greater(df, "n", "10")) == [2, 3]
    assert _ids(df, p.greater(df, "n", 9.5)) == [1, 2, 3]
    assert _ids(df, p.less(df, "rate", "2.5")) == [1]
    assert _ids(df, p.greater(df, "mixed", "6")) == [1]
    assert _ids(df, p.less(df, "mixed", "100")) == [1]
    for value in ("many", "", "nan"):
        assert _ids(df, p.greater(df, "n", value)) == _ids(df, p.less(df, "n", value)) == []


def test_greater_and_less_are_exact_beyond_doubles(spark):
    big = 2**53
    df = spark.createDataFrame(
        [(1, big), (2, big + 1), (3, -5), (4, None)], "id int, n bigint"
    ).selectExpr("id", "n", "CAST(n AS DECIMAL(20, 1)) + 0.5BD AS d")
    assert _ids(df, p.greater(df, "n", str(big))) == [2]
    assert _ids(df, p.less(df, "n", big + 1)) == [1, 3]
    assert _ids(df, p.greater(df, "n", "-5.5")) == [1, 2, 3]
    assert _ids(df, p.less(df, "n", "-4.5")) == [3]
    assert _ids(df, p.greater(df, "n", "1e30")) == _ids(df, p.less(df, "n", "-1e30")) == []
    assert _ids(df, p.less(df, "n", "1e30")) == _ids(df, p.greater(df, "n", "-inf")) == [1, 2, 3]
    assert _ids(df, p.greater(df, "d", f"{big}.5")) == [2]
    assert _ids(df, p.less(df, "d", f"{big}.55")) == [1, 3]
    assert _ids(df, p.less(df, "d", "1e40")) == [1, 2, 3]


def test_text_tests_also_on_numbers(df):
    assert _ids(df, p.contains("n", "20")) == [2, 3]
    assert _ids(df, p.starts_with("n", "12")) == [3]
    assert _ids(df, p.contains("region", "ort")) == [1, 4]
    assert _ids(df, p.starts_with("region", "North")) == [1, 4]


def test_membership_presence_and_combination(df):
    assert _ids(df, p.one_of(df, "region", ["North", "South"])) == [1]
    assert _ids(df, p.one_of(df, "n", ["200", 10, "many"])) == [1, 2]
    assert _ids(df, p.present("region")) == [1, 4]
    assert _ids(df, p.present("n")) == [1, 2, 3]
    assert _ids(df, p.present("region") & p.greater(df, "rate", 5)) == [4]


def test_periods(spark):
    df = mart(spark, *[regional("North", y) for y in (199899, 199900, 200001)])
    assert df.filter(p.period_is("199900")).count() == 1
    assert df.filter(p.period_between(199899, 199900)).count() == 2
    assert df.filter(p.period_between(199900, 199900)).count() == 1
    assert df.filter(p.period_is(201011)).count() == 0
    with pytest.raises(ValueError):
        p.period_between(200001, 199900)


def test_slices(spark):
    df = mart(
        spark,
        regional("North", 201819),
        regional("North", 201819, school_type="Special"),
        regional("null", 201819, school_type="Special"),
        regional(None, 201819, school_type="Special"),
        authority("A"),
        school("S1", "Special"),
        school("S2", "Primary"),
        school("S3", "Total"),
    )
    assert p.level_total(df, "Regional").count() == 1
    assert p.level_total(df, "Local authority").count() == 1
    assert [r["school_type"] for r in p.level_by_type(df, "Regional").collect()] == ["Special"]
    assert [r["school_name"] for r in p.school_rows(df, "Special").collect()] == ["S1"]
    # All types: rows marked Total are kept.
    assert sorted(r["school_name"] for r in p.school_rows(df).collect()) == ["S1", "S2", "S3"]
