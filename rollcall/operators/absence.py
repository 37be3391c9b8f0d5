"""Authorised absence by year and reason, unauthorised absence by area."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import column, guarded_ratio, to_rows, total
from rollcall.operators.predicates import period_is, present

# Reasons of authorised absence and how they are called.
REASON_LABELS = {
    "sess_auth_appointments": "Medical appointments",
    "sess_auth_holiday": "Authorised holiday",
    "sess_auth_illness": "Illness",
    "sess_auth_other": "Other authorised",
    "sess_auth_religious": "Religious observance",
    "sess_auth_study": "Study leave",
    "sess_auth_traveller": "Traveller",
}


def authorised_absence_by_year(df: DataFrame) -> DataFrame:
    """Absences, pupils and absences per pupil of every year, over the rows given."""
    return (
        df.groupBy("time_period")
        .agg(
            total("sess_authorised").alias("total_absences"),
            total("enrolments").alias("total_enrolments"),
        )
        .withColumn(
            "absences_per_student",
            guarded_ratio(F.col("total_absences"), F.col("total_enrolments")),
        )
        .orderBy("time_period")
    )


def authorised_reason_totals(df: DataFrame, period: int) -> DataFrame:
    """Pupils and authorised absences of one year, 0 without rows."""
    return df.filter(period_is(period)).agg(
        total("enrolments").alias("total_students"),
        total("sess_authorised").alias("total_authorised"),
    )


def authorised_reason_breakdown(df: DataFrame, period: int) -> DataFrame:
    """Per reason: sessions, share of all authorised absence and sessions per pupil, one year."""
    sums = df.filter(period_is(period)).agg(
        total("sess_authorised").alias("authorised"),
        total("enrolments").alias("pupils"),
        *[total(reason).alias(reason) for reason in REASON_LABELS],
    )
    return to_rows(
        sums,
        [
            F.struct(
                F.lit(label).alias("absence_type"),
                F.col(reason).alias("total_sessions"),
                guarded_ratio(F.col(reason), F.col("authorised"), 100.0).alias(
                    "percent_of_authorised"
                ),
                guarded_ratio(F.col(reason), F.col("pupils")).alias("sessions_per_student"),
            )
            for reason, label in REASON_LABELS.items()
        ],
    )


def _area_sums(df: DataFrame, area: str, period: int) -> DataFrame:
    return (
        df.filter(period_is(period) & present(area))
        .groupBy(column(area))
        .agg(
            total("sess_unauthorised").alias("total_unauthorised"),
            total("enrolments").alias("total_students"),
        )
    )


def unauthorised_by_area(df: DataFrame, area: str, period: int) -> DataFrame:
    """Per area: unauthorised absences, pupils, share of all areas and sessions per pupil.

    The overall sum is a scalar subquery over the same grouped rows, so no task sees all areas.
    """
    areas = _area_sums(df, area, period)
    overall = _overall(areas)["total_unauthorised"]
    return areas.select(
        column(area),
        "total_unauthorised",
        "total_students",
        guarded_ratio(F.col("total_unauthorised"), overall, 100.0).alias("percent_of_all"),
        guarded_ratio(F.col("total_unauthorised"), F.col("total_students")).alias(
            "sessions_per_student"
        ),
    ).orderBy(column(area))


def _overall(areas: DataFrame):
    # Both sums, although one is used: the subquery then shares the exchange of its parent.
    return areas.agg(
        F.struct(
            F.sum("total_unauthorised").alias("total_unauthorised"),
            F.sum("total_students").alias("total_students"),
        )
    ).scalar()


def unauthorised_overall(df: DataFrame, area: str, period: int) -> DataFrame:
    """Unauthorised absences, pupils and sessions per pupil over all areas of one year."""
    return (
        _area_sums(df, area, period)
        .agg(
            total("total_unauthorised").alias("overall_unauthorised"),
            total("total_students").alias("overall_students"),
        )
        .withColumn(
            "overall_sessions_per_student",
            guarded_ratio(F.col("overall_unauthorised"), F.col("overall_students")),
        )
    )
