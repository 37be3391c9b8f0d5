"""Regional attendance over the years and what follows from it.

``regional_rates`` and its ordered form ``regional_attendance`` take the stacked table, all
other functions take the rows of either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import absence_percent, academic_year_label, to_rows
from rollcall.operators.predicates import level_total, present


def regional_rates(df: DataFrame) -> DataFrame:
    """Attendance and absence per region and year, in percent of the possible sessions."""
    missed, possible = F.sum("sess_overall"), F.sum("sess_possible")
    return (
        level_total(df, "Regional")
        .filter(present("region_name"))
        .groupBy("region_name", "time_period")
        .agg(
            (100 * (1 - F.try_divide(missed, possible))).alias("avg_attendance"),
            absence_percent(missed, possible).alias("avg_absence"),
        )
    )


def regional_attendance(df: DataFrame) -> DataFrame:
    return regional_rates(df).orderBy("region_name", "time_period")


def trend_series(rates: DataFrame) -> DataFrame:
    """The points of a trend line per region, labelled with the academic year."""
    return rates.select(
        "region_name",
        "time_period",
        academic_year_label(F.col("time_period")).alias("academic_year"),
        "avg_attendance",
    ).orderBy("region_name", "time_period")


def absence_spread(rates: DataFrame) -> DataFrame:
    """Mean and sample deviation of the yearly rates, each year counting the same."""
    return (
        rates.groupBy("region_name")
        .agg(
            F.avg("avg_absence").alias("mean_absence"),
            F.coalesce(F.stddev_samp("avg_absence"), F.lit(0.0)).alias("std_absence"),
        )
        .orderBy("mean_absence", "region_name")
    )


def _change() -> Column:
    attendance = F.col("avg_attendance")
    return F.max_by(attendance, "time_period") - F.min_by(attendance, "time_period")


def improvement(rates: DataFrame) -> DataFrame:
    """Attendance of the last year minus that of the first, smallest change first."""
    return (
        rates.groupBy("region_name").agg(_change().alias("change")).orderBy("change", "region_name")
    )


def _performance(rates: DataFrame) -> DataFrame:
    return (
        rates.groupBy("region_name")
        .agg(_change().alias("change"), F.avg("avg_attendance").alias("average"))
        .withColumn(
            "status",
            F.when(F.col("change") > 0, "Improved")
            .when(F.col("change") < 0, "Worsened")
            .when(F.col("change") == 0, "No Change"),
        )
    )


def performance(rates: DataFrame) -> DataFrame:
    """Change, mean of the yearly attendance and a verdict per region."""
    return _performance(rates).orderBy("region_name")


def extremes(rates: DataFrame) -> DataFrame:
    """Best and worst region by change and by mean; of equal regions the first by name."""

    def pick(metric: str, sign: int) -> Column:
        order = F.struct(F.col(metric) * sign, F.col("region_name"))
        picked = F.struct(F.col("region_name"), F.col(metric).alias("value"))
        return F.min_by(picked, F.when(F.col(metric).isNotNull(), order))

    picks = {
        "best_change": pick("change", -1),
        "worst_change": pick("change", 1),
        "best_average": pick("average", -1),
        "worst_average": pick("average", 1),
    }
    found = _performance(rates).agg(*[value.alias(name) for name, value in picks.items()])
    return to_rows(
        found,
        [
            F.struct(
                F.lit(name).alias("measure"),
                F.col(name)["region_name"].alias("region_name"),
                F.col(name)["value"].alias("value"),
            )
            for name in picks
        ],
    )
