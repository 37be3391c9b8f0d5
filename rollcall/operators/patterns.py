"""Absence rates by school type, region and year. Rates are ratios of sums.

``pattern_cells``, and its ordered form ``absence_pattern_cells``, keep the sums beside each
rate; the functions below them take those cells and add the sums up again, so no session is
aggregated from the source twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.functions import absence_percent, column, or_zero
from rollcall.operators.predicates import level_by_type
from rollcall.sources import store

SUMS = ("total_sessions", "total_possible_sessions")


def pattern_scope(df: DataFrame) -> DataFrame:
    """How many school types and regions, and which years, the pattern analysis covers."""
    return level_by_type(df, "Regional").agg(
        F.countDistinct("school_type").alias("school_type_count"),
        F.countDistinct("region_name").alias("region_count"),
        F.min("time_period").alias("first_period"),
        F.max("time_period").alias("last_period"),
    )


def pattern_cells(df: DataFrame) -> DataFrame:
    """Absence rate and its two sums per school type, region and year."""
    return (
        level_by_type(df, "Regional")
        .groupBy("school_type", "region_name", "time_period")
        .agg(
            F.sum("sess_overall").alias("total_sessions"),
            F.sum("sess_possible").alias("total_possible_sessions"),
        )
        .withColumn("avg_absence_rate", _rate())
    )


def absence_pattern_cells(df: DataFrame) -> DataFrame:
    return pattern_cells(df).orderBy("time_period", "school_type", "region_name")


def _rate() -> Column:
    return absence_percent(*[F.col(name) for name in SUMS])


def _pooled(cells: DataFrame, *keys: str) -> DataFrame:
    summed = cells.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in SUMS])
    return summed.withColumn("avg_absence_rate", _rate())


def _highest_first(rates: DataFrame, *names: str) -> DataFrame:
    return rates.orderBy(F.col("avg_absence_rate").desc_nulls_last(), *names)


def absence_ranked(cells: DataFrame) -> DataFrame:
    """School types in regions over all years, highest rate first; ties go by name."""
    return _highest_first(
        _pooled(cells, "school_type", "region_name"), "school_type", "region_name"
    )


def top_combinations(cells: DataFrame, n: int = 3) -> DataFrame:
    return absence_ranked(cells).limit(n)


def absence_by_school_type(cells: DataFrame, n: int = 3) -> DataFrame:
    return _highest_first(_pooled(cells, "school_type"), "school_type").limit(n)


def absence_by_region(cells: DataFrame, n: int = 3) -> DataFrame:
    return _highest_first(_pooled(cells, "region_name"), "region_name").limit(n)


def absence_conclusion(cells: DataFrame) -> DataFrame:
    """One row: the type, the combination and the region with the highest rate.

    The three rankings come out of one aggregation over three grouping sets.
    """
    keys = ("school_type", "region_name")
    sums = [F.sum(name).alias(name) for name in SUMS]
    rates = (
        cells.groupingSets([list(keys), ["school_type"], ["region_name"]], *keys)
        .agg(*sums, F.grouping_id().alias("set_id"))
        .withColumn("avg_absence_rate", _rate())
    )

    def best(set_id: int, value: str) -> Column:
        ranked = (F.col("set_id") == set_id) & F.col("avg_absence_rate").isNotNull()
        order = F.struct(-F.col("avg_absence_rate"), *[F.col(name) for name in keys])
        return F.min_by(value, F.when(ranked, order))

    # grouping_id has one bit per key, set where the key is left out of the set.
    combination, by_type, by_region = 0b00, 0b01, 0b10
    return rates.agg(
        best(by_type, "school_type").alias("top_school_type"),
        best(by_type, "avg_absence_rate").alias("top_school_type_rate"),
        best(combination, "region_name").alias("top_combination_region"),
        best(combination, "avg_absence_rate").alias("top_combination_rate"),
        best(by_region, "region_name").alias("top_region"),
        best(by_region, "avg_absence_rate").alias("top_region_rate"),
    )


def absence_heatmap(cells: DataFrame, regions: Sequence[str] | None = None) -> DataFrame:
    """One row per school type, one column per region of ``cells`` and per further one named in
    ``regions``, in order of name; 0 for a pair without sessions.

    The cells, few whatever the size of the data, are stored first, so that finding the regions
    does not compute them a second time.
    """
    stored = store(cells, "heatmap_cells")
    pivoted = (
        stored.groupBy("school_type")
        .pivot("region_name")
        .agg(absence_percent(*[F.sum(name) for name in SUMS]))
    )
    found = {name for name in pivoted.columns if name != "school_type"}

    def rate(name: str) -> Column:
        return or_zero(column(name)) if name in found else F.lit(0.0)

    return pivoted.select(
        "school_type", *[rate(name).alias(name) for name in sorted(found | set(regions or ()))]
    ).orderBy("school_type")


def absence_trend_by_type(cells: DataFrame) -> DataFrame:
    """Per school type and year; a type without rows in a year has no row."""
    return _pooled(cells, "school_type", "time_period").orderBy("school_type", "time_period")
