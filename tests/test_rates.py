from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rollcall.functions import academic_year_label
from rollcall.operators import patterns, regional
from tests.rows import authority, dicts, mart
from tests.rows import regional as row

pytestmark = pytest.mark.usefixtures("both_ansi")


def test_academic_year_label(spark):
    codes = [(200607,), (199900,), (200910,), (2018,), (None,)]
    labels = spark.createDataFrame(codes, "code int").select(academic_year_label(F.col("code")))
    assert [r[0] for r in labels.collect()] == ["2006/07", "1999/00", "2009/10", "2018/19", None]


@pytest.fixture
def years(spark):
    return mart(
        spark,
        row("North", 201617, 10), row("North", 201718, 8), row("North", 201819, 4),
        row("South", 201819, 20), row("South", 201617, 5), row("South", 201718, 5),
        row("East", 201819, 7),
        row("West", 201617, 6), row("West", 201819, 6),
        row("North", 201819, 90, school_type="Special"), row("null", 201819, 50),
        row(None, 201819, 50), authority("A", sess_overall=9, sess_possible=10),
    )


def test_rates_pick_one_level_and_total(years):
    rows = {(r["region_name"], r["time_period"]): r["avg_absence"]
            for r in dicts(regional.regional_rates(years))}
    assert len(rows) == 9 and rows["North", 201819] == 4.0


def test_rate_is_a_ratio_of_sums_and_null_without_sessions(spark):
    df = mart(spark, row("North", 201819, 1, 10), row("North", 201819, 9, 90),
              row("South", 201819, 0, 0), row("East", 201819, None, None))
    rows = {r.pop("region_name"): r for r in dicts(regional.regional_attendance(df))}
    assert rows["North"]["avg_absence"] == 10.0 and rows["North"]["avg_attendance"] == 90.0
    assert rows["South"]["avg_absence"] is None and rows["South"]["avg_attendance"] is None
    assert rows["East"]["avg_absence"] is None


def test_attendance_and_series_are_ordered(years):
    rows = regional.regional_attendance(years).collect()
    keys = [(r["region_name"], r["time_period"]) for r in rows]
    assert keys == sorted(keys)
    series = regional.trend_series(regional.regional_rates(years)).collect()
    assert [(r["region_name"], r["time_period"]) for r in series] == keys
    assert series[0]["academic_year"] == "2018/19"


def test_spread_counts_each_year_once_and_is_zero_for_one_year(years):
    spread = regional.absence_spread(regional.regional_rates(years))
    rows = {r.pop("region_name"): r for r in dicts(spread)}
    assert rows["East"] == {"mean_absence": pytest.approx(7.0), "std_absence": 0.0}
    assert rows["South"]["mean_absence"] == pytest.approx(10.0)
    assert rows["South"]["std_absence"] == pytest.approx(8.660254037844387)
    assert list(rows) == ["West", "East", "North", "South"]


def test_improvement_is_last_minus_first_year_in_order(years):
    rows = [tuple(r) for r in regional.improvement(regional.regional_rates(years)).collect()]
    assert [r[0] for r in rows] == ["South", "East", "West", "North"]
    assert [r[1] for r in rows] == pytest.approx([-15.0, 0.0, 0.0, 6.0])


def test_performance_status(years):
    performance = regional.performance(regional.regional_rates(years))
    rows = {r["region_name"]: r for r in dicts(performance)}
    assert {name: r["status"] for name, r in rows.items()} == {
        "East": "No Change", "North": "Improved", "South": "Worsened", "West": "No Change",
    }
    assert rows["North"]["average"] == pytest.approx((90 + 92 + 96) / 3)


def test_extremes_and_ties_by_name(spark, years):
    extremes = regional.extremes(regional.regional_rates(years))
    rows = {r["measure"]: r["region_name"] for r in dicts(extremes)}
    assert rows == {
        "best_change": "North", "worst_change": "South",
        "best_average": "West", "worst_average": "South",
    }
    tied = mart(spark, row("B", 201819, 5), row("A", 201819, 5), row("0", 201819, 0, 0))
    rows = dicts(regional.extremes(regional.regional_rates(tied)))
    assert {r["region_name"] for r in rows} == {"A"}


@pytest.fixture
def cells(spark):
    df = mart(
        spark,
        row("North", 201718, 10, 100, "Primary"), row("North", 201819, 30, 100, "Primary"),
        row("South", 201819, 5, 50, "Primary"),
        row("North", 201819, 40, 100, "Special"),
        row("East", 201819, 0, 0, "Special"),
        row("North", 201819, 99, 100, "Total"), row("null", 201819, 99, 100, "Primary"),
        row(None, 201819, 99, 100, "Primary"),
    )
    return patterns.pattern_cells(df)


def test_cells_keep_sums(cells):
    rows = {(r["school_type"], r["region_name"], r["time_period"]): r for r in dicts(cells)}
    assert len(rows) == 5
    assert rows["Primary", "North", 201819]["avg_absence_rate"] == 30.0
    assert rows["Special", "East", 201819]["avg_absence_rate"] is None


def test_ordered_cells(spark):
    df = mart(spark, row("B", 201819, 1, 10, "Y"), row("A", 201819, 1, 10, "Y"),
              row("B", 201718, 1, 10, "Z"), row("B", 201819, 1, 10, "X"))
    rows = patterns.absence_pattern_cells(df).collect()
    assert [(r["time_period"], r["school_type"], r["region_name"]) for r in rows] == [
        (201718, "Z", "B"), (201819, "X", "B"), (201819, "Y", "A"), (201819, "Y", "B"),
    ]


def test_ranking_puts_missing_rates_last(cells):
    rows = patterns.absence_ranked(cells).collect()
    assert [(r["school_type"], r["region_name"]) for r in rows] == [
        ("Special", "North"), ("Primary", "North"), ("Primary", "South"), ("Special", "East"),
    ]
    assert rows[1]["avg_absence_rate"] == 20.0
    assert patterns.top_combinations(cells, 2).count() == 2


def test_ties_go_by_name(spark):
    df = mart(spark, *[row(r, 201819, 5, 50, t) for t in ("Y", "X") for r in ("B", "A")])
    found = patterns.pattern_cells(df)
    top = [(r["school_type"], r["region_name"]) for r in patterns.top_combinations(found).collect()]
    assert top == [("X", "A"), ("X", "B"), ("Y", "A")]
    conclusion = dicts(patterns.absence_conclusion(found))[0]
    assert conclusion["top_school_type"] == "X"
    assert conclusion["top_region"] == conclusion["top_combination_region"] == "A"


def test_pooled_rates(cells):
    assert [tuple(r) for r in patterns.absence_by_school_type(cells).collect()] == [
        ("Special", 40, 100, 40.0), ("Primary", 45, 250, 18.0),
    ]
    assert [r["region_name"] for r in patterns.absence_by_region(cells).collect()] == [
        "North", "South", "East",
    ]


def test_conclusion_equals_the_first_of_each_ranking(cells):
    assert dicts(patterns.absence_conclusion(cells)) == [{
        "top_school_type": "Special", "top_school_type_rate": 40.0,
        "top_combination_region": "North", "top_combination_rate": 40.0,
        "top_region": "North", "top_region_rate": pytest.approx(80 / 3),
    }]


def test_heatmap_fills_gaps_with_zero(cells):
    expected = [
        {"school_type": "Primary", "East": 0.0, "North": 20.0, "South": 10.0},
        {"school_type": "Special", "East": 0.0, "North": 40.0, "South": 0.0},
    ]
    assert dicts(patterns.absence_heatmap(cells)) == expected
    assert dicts(patterns.absence_heatmap(cells, ["East", "North", "South"])) == expected
    named = patterns.absence_heatmap(cells, ["West", "North"])
    assert dicts(named) == [{**row, "West": 0.0} for row in expected]


def test_trend_has_no_row_for_a_missing_year(cells):
    rows = [tuple(r)[:2] for r in patterns.absence_trend_by_type(cells).collect()]
    assert rows == [("Primary", 201718), ("Primary", 201819), ("Special", 201819)]


def test_scope(spark):
    df = mart(spark, row("North", 201718, school_type="X"), row("South", 201819, school_type="Y"),
              row("null", 199596, school_type="Z"), row("North", 199596))
    assert dicts(patterns.pattern_scope(df)) == [{
        "school_type_count": 2, "region_count": 2, "first_period": 201718, "last_period": 201819,
    }]
