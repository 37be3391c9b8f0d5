"""Two local authorities side by side in one year: always one aggregate row, then metric rows."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import guarded_ratio, to_rows, total
from rollcall.operators.predicates import period_is

# Compared measures and how they are called.
COMPARED_TOTALS = {
    "Total Enrolments": "enrolments",
    "Total Authorised Absences": "sess_authorised",
    "Total Unauthorised Absences": "sess_unauthorised",
    "Total Possible Sessions": "sess_possible",
}

# Compared rates, and the measures whose rates add up to each.
COMPARED_RATES = {
    "Authorised Absence Rate": ("sess_authorised",),
    "Unauthorised Absence Rate": ("sess_unauthorised",),
    "Total Absence Rate": ("sess_authorised", "sess_unauthorised"),
}


def _pair(df: DataFrame, first: str, second: str, period: int) -> DataFrame:
    return df.filter(period_is(period) & F.col("la_name").isin(first, second))


def _pair_sums(df: DataFrame, first: str, second: str, period: int) -> DataFrame:
    return _pair(df, first, second, period).agg(
        *[
            total(F.when(F.col("la_name") == name, F.col(measure))).alias(f"{measure}_{side}")
            for measure in COMPARED_TOTALS.values()
            for side, name in ((1, first), (2, second))
        ]
    )


def _metric(name: str, left: Column, right: Column) -> Column:
    difference = left - right
    return F.struct(
        F.lit(name).alias("metric"),
        left.alias("value_1"),
        right.alias("value_2"),
        F.abs(difference).alias("difference"),
        F.when(difference > 0, "higher").otherwise("lower").alias("direction"),
    )


def authority_presence(df: DataFrame, first: str, second: str, period: int) -> DataFrame:
    """Row count of either authority in the year; one without rows is listed with 0."""
    counts = _pair(df, first, second, period).agg(
        F.count_if(F.col("la_name") == first).alias("rows_1"),
        F.count_if(F.col("la_name") == second).alias("rows_2"),
    )
    return to_rows(
        counts,
        [
            F.struct(
                F.lit(name).alias("la_name"),
                F.col(rows).alias("row_count"),
                (F.col(rows) > 0).alias("has_data"),
            )
            for name, rows in ((first, "rows_1"), (second, "rows_2"))
        ],
    )


def compare_totals(df: DataFrame, first: str, second: str, period: int) -> DataFrame:
    """Four totals of both, their distance, and whether the first is ``higher`` (else ``lower``)."""
    return to_rows(
        _pair_sums(df, first, second, period),
        [
            _metric(label, F.col(f"{measure}_1"), F.col(f"{measure}_2"))
            for label, measure in COMPARED_TOTALS.items()
        ],
    )


def compare_rates(df: DataFrame, first: str, second: str, period: int) -> DataFrame:
    """Authorised, unauthorised and total absence rate of both, in percent of possible sessions."""

    def rate(measures: tuple[str, ...], side: int) -> Column:
        possible = F.col(f"sess_possible_{side}")
        rates = [guarded_ratio(F.col(f"{name}_{side}"), possible, 100.0) for name in measures]
        return reduce(add, rates)

    return to_rows(
        _pair_sums(df, first, second, period),
        [
            _metric(label, rate(measures, 1), rate(measures, 2))
            for label, measures in COMPARED_RATES.items()
        ],
    )
