from __future__ import annotations

import pytest

from rollcall.operators import absence, comparison, enrolment
from tests.rows import authority, dicts, mart, school


def test_enrolment_pivot_fills_gaps_and_keeps_chosen_authorities(spark):
    df = mart(
        spark,
        authority("B", 201718, enrolments=4),
        authority("A", 201718, enrolments=10),
        authority("A", 201819, enrolments=5),
        authority("C", 201819, enrolments=99),
    )
    expected = [
        {"la_name": "A", "y201718": 10, "y201819": 5, "total": 15},
        {"la_name": "B", "y201718": 4, "y201819": 0, "total": 4},
    ]
    found = enrolment.enrolment_by_authority_and_year
    assert dicts(found(df, ["A", "B", "X"])) == expected
    more = df.unionByName(mart(spark, authority("A", 187071, enrolments=7)))
    assert dicts(found(more, ["A"])) == [
        {"la_name": "A", "y187071": 7, "y201718": 10, "y201819": 5, "total": 22}
    ]
    assert dicts(found(df, ["X"])) == []


def test_enrolment_average_divides_by_the_number_asked_for(spark):
    df = mart(
        spark, authority("A", enrolments=10), authority("B", enrolments=20),
        authority("A", 201718, enrolments=None), authority("C", enrolments=7),
    )
    assert dicts(enrolment.enrolment_year_summary(df, ["A", "B", "X", "Y"])) == [
        {"time_period": 201718, "total_enrolments": 0, "average_per_la": 0.0},
        {"time_period": 201819, "total_enrolments": 30, "average_per_la": 7.5},
    ]


def test_authorised_absence_by_year(spark):
    df = mart(
        spark,
        school("S1", "Special", 201718, sess_authorised=6, enrolments=4),
        school("S2", "Special", 201718, sess_authorised=4, enrolments=0),
        school("S1", "Special", 201819, sess_authorised=5, enrolments=0),
        school("S1", "Special", 201920, sess_authorised=None, enrolments=None),
    )
    rows = [tuple(r) for r in absence.authorised_absence_by_year(df).collect()]
    assert rows == [(201718, 10, 4, 2.5), (201819, 5, 0, 0.0), (201920, 0, 0, 0.0)]


def test_reason_breakdown(spark):
    df = mart(
        spark,
        school("S1", "Special", sess_authorised=8, enrolments=4, sess_auth_illness=6),
        school("S2", "Special", sess_authorised=2, enrolments=1, sess_auth_study=2),
        school("S2", "Special", 201718, sess_authorised=50, sess_auth_study=50),
    )
    breakdown = absence.authorised_reason_breakdown(df, 201819)
    rows = {r.pop("absence_type"): r for r in dicts(breakdown)}
    assert list(rows) == list(absence.REASON_LABELS.values())
    assert rows["Illness"] == {
        "total_sessions": 6, "percent_of_authorised": 60.0, "sessions_per_student": 1.2,
    }
    assert rows["Study leave"]["total_sessions"] == 2
    assert rows["Traveller"] == {
        "total_sessions": 0, "percent_of_authorised": 0.0, "sessions_per_student": 0.0,
    }
    assert dicts(absence.authorised_reason_totals(df, 201819)) == [
        {"total_students": 5, "total_authorised": 10}
    ]


def test_reasons_of_a_year_without_rows_are_zero(spark):
    df = mart(spark, school("S1", "Special", sess_authorised=8))
    rows = dicts(absence.authorised_reason_breakdown(df, 199596))
    assert len(rows) == 7
    assert {(r["total_sessions"], r["percent_of_authorised"]) for r in rows} == {(0, 0.0)}
    assert dicts(absence.authorised_reason_totals(df, 199596)) == [
        {"total_students": 0, "total_authorised": 0}
    ]


@pytest.fixture
def areas(spark):
    return mart(
        spark,
        authority("B", sess_unauthorised=30, enrolments=10),
        authority("A", sess_unauthorised=10, enrolments=0),
        authority("N", sess_unauthorised=None, enrolments=5),
        authority("null", sess_unauthorised=100, enrolments=100),
        authority(None, sess_unauthorised=100, enrolments=100),
        authority("A", 201718, sess_unauthorised=77, enrolments=7),
    )


def test_unauthorised_shares(areas):
    assert [tuple(r) for r in absence.unauthorised_by_area(areas, "la_name", 201819).collect()] == [
        ("A", 10, 0, 25.0, 0.0),
        ("B", 30, 10, 75.0, 3.0),
        ("N", 0, 5, 0.0, 0.0),
    ]


def test_unauthorised_overall(areas):
    rows = absence.unauthorised_overall(areas, "la_name", 201819).collect()
    assert [tuple(r) for r in rows] == [(40, 15, 40 / 15)]
    rows = absence.unauthorised_overall(areas, "la_name", 199596).collect()
    assert [tuple(r) for r in rows] == [(0, 0, 0.0)]
    assert absence.unauthorised_by_area(areas, "la_name", 199596).collect() == []


def test_shares_without_any_absence_are_zero(spark):
    df = mart(spark, authority("A", enrolments=3))
    rows = absence.unauthorised_by_area(df, "la_name", 201819).collect()
    assert [tuple(r) for r in rows] == [("A", 0, 3, 0.0, 0.0)]


@pytest.fixture
def pair(spark):
    return mart(
        spark,
        authority("A", enrolments=10, sess_possible=100, sess_authorised=5, sess_unauthorised=2),
        authority("B", enrolments=10, sess_possible=200, sess_authorised=20, sess_unauthorised=2),
        authority("Z", enrolments=1, sess_possible=0, sess_authorised=None),
        authority("A", 201718, enrolments=1000),
    )


def test_presence_lists_a_missing_authority(pair):
    rows = [tuple(r) for r in comparison.authority_presence(pair, "A", "X", 201819).collect()]
    assert rows == [("A", 1, True), ("X", 0, False)]


def test_totals_of_a_pair(pair):
    rows = [tuple(r) for r in comparison.compare_totals(pair, "A", "B", 201819).collect()]
    assert rows == [
        ("Total Enrolments", 10, 10, 0, "lower"),
        ("Total Authorised Absences", 5, 20, 15, "lower"),
        ("Total Unauthorised Absences", 2, 2, 0, "lower"),
        ("Total Possible Sessions", 100, 200, 100, "lower"),
    ]
    flipped = comparison.compare_totals(pair, "B", "A", 201819).collect()
    assert [r["direction"] for r in flipped] == ["lower", "higher", "lower", "higher"]


def test_rates_of_a_pair(pair):
    rows = [tuple(r) for r in comparison.compare_rates(pair, "A", "B", 201819).collect()]
    assert [r[0] for r in rows] == [
        "Authorised Absence Rate", "Unauthorised Absence Rate", "Total Absence Rate",
    ]
    assert [r[1:4] for r in rows] == [(5.0, 10.0, 5.0), (2.0, 1.0, 1.0), (7.0, 11.0, 4.0)]
    assert [r[4] for r in rows] == ["lower", "higher", "lower"]


def test_pair_without_sessions_or_rows_is_zero(pair):
    for other in ("Z", "X"):
        rows = comparison.compare_rates(pair, other, "A", 201819).collect()
        assert [r["value_1"] for r in rows] == [0.0, 0.0, 0.0]
        totals = comparison.compare_totals(pair, other, "A", 201819).collect()
        assert [r["value_1"] for r in totals][1:] == [0, 0, 0]
