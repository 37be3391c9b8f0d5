"""Enrolments of chosen local authorities over the years."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions import column, or_zero, total
from rollcall.sources import store


def enrolment_by_authority_and_year(
    df: DataFrame, authorities: Sequence[str], prefix: str = "y"
) -> DataFrame:
    """One row per authority, one column per period of these rows (``y199596``) and the ``total``
    over all of them.

    The sums per authority and period, few whatever the size of ``df``, are stored first, so that
    finding the periods does not compute ``df`` a second time.
    """
    chosen = df.filter(F.col("la_name").isin(list(authorities)))
    sums = chosen.groupBy("la_name", "time_period").agg(F.sum("enrolments").alias("enrolments"))
    sums = store(sums, "enrolment_sums")
    pivoted = sums.groupBy("la_name").pivot("time_period").agg(F.sum("enrolments"))
    found = sorted(name for name in pivoted.columns if name != "la_name")
    counts = [or_zero(column(name)) for name in found]
    return pivoted.select(
        "la_name",
        *[count.alias(f"{prefix}{name}") for count, name in zip(counts, found)],
        reduce(add, counts, F.lit(0).cast("bigint")).alias("total"),
    ).orderBy("la_name")


def enrolment_year_summary(df: DataFrame, authorities: Sequence[str]) -> DataFrame:
    """Per year the total, and its average over all chosen authorities, with data or without."""
    return (
        df.filter(F.col("la_name").isin(list(authorities)))
        .groupBy("time_period")
        .agg(total("enrolments").alias("total_enrolments"))
        .withColumn("average_per_la", F.col("total_enrolments") / F.lit(float(len(authorities))))
        .orderBy("time_period")
    )
