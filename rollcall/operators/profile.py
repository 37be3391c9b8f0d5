"""Profiling: each function makes one pass over the rows, whatever the number of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from rollcall.functions import column, guarded_ratio, to_rows


def null_counts(df: DataFrame) -> DataFrame:
    """``(column_name, null_count)`` for every column, zeros included."""
    counted = df.agg(*[_nulls(name, str(i)) for i, name in enumerate(df.columns)])
    return to_rows(
        counted,
        [
            F.struct(F.lit(name).alias("column_name"), column(str(i)).alias("null_count"))
            for i, name in enumerate(df.columns)
        ],
    )


def null_profile(df: DataFrame) -> DataFrame:
    """``(column_name, null_count, null_percent)`` for the columns that have NULLs."""
    counted = df.agg(
        F.count("*").alias("row_count"),
        *[_nulls(name, str(i)) for i, name in enumerate(df.columns)],
    )
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            column(str(i)).alias("null_count"),
            guarded_ratio(column(str(i)), F.col("row_count"), 100.0).alias("null_percent"),
        )
        for i, name in enumerate(df.columns)
    ]
    return to_rows(counted, rows).filter(F.col("null_count") > 0)


def _nulls(name: str, alias: str) -> Column:
    return F.count_if(column(name).isNull()).alias(alias)


def table_status(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("row_count"), F.lit(len(df.columns)).cast("bigint").alias("column_count")
    )


def preview(
    df: DataFrame, order_by: Sequence[str | Column], rows: int = 5, columns: int = 6
) -> DataFrame:
    """The first rows and columns, with how many of how many rows and columns are shown.

    The total is an uncorrelated scalar subquery: a count that reads no column.
    """
    shown = df.columns[:columns]
    count = df.agg(F.count("*")).scalar()
    head = df.orderBy(*order_by).limit(rows).select(*[column(name) for name in shown])
    return head.withColumns(
        {
            "shown_rows": F.least(F.lit(rows).cast("bigint"), count),
            "total_rows": count,
            "shown_columns": F.lit(len(shown)).cast("bigint"),
            "total_columns": F.lit(len(df.columns)).cast("bigint"),
        }
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def numeric_summary(df: DataFrame) -> DataFrame:
    """``(column_name, non_null_count, mean, minimum, maximum, minimum_exact, maximum_exact)`` per
    numeric column: numbers, and as text the extremes that a double cannot hold exactly.
    """
    names = numeric_columns(df)
    statistics = {"non_null_count": F.count, "mean": F.avg, "minimum": F.min, "maximum": F.max}
    if not names:
        raise ValueError("the table has no numeric column")
    summary = df.agg(
        *[
            function(column(name)).alias(f"{statistic}_{i}")
            for i, name in enumerate(names)
            for statistic, function in statistics.items()
        ]
    )

    def exact(statistic: str, i: int) -> Column:
        return F.col(f"{statistic}_{i}").cast("string").alias(f"{statistic}_exact")

    def value(statistic: str, i: int) -> Column:
        kind = "bigint" if statistic == "non_null_count" else "double"
        return F.col(f"{statistic}_{i}").cast(kind).alias(statistic)

    return to_rows(
        summary,
        [
            F.struct(
                F.lit(name).alias("column_name"),
                *[value(s, i) for s in statistics],
                exact("minimum", i),
                exact("maximum", i),
            )
            for i, name in enumerate(names)
        ],
    )


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.filter(column(name).isNotNull()).select(column(name)).distinct().orderBy(column(name))


def value_counts(df: DataFrame, name: str) -> DataFrame:
    return (
        df.filter(column(name).isNotNull())
        .groupBy(column(name))
        .agg(F.count("*").alias("row_count"))
        .orderBy(column(name))
    )


def available_periods(df: DataFrame, period: str = "time_period") -> DataFrame:
    """The periods as text, each once, in order."""
    return df.select(column(period).cast("string").alias(period)).distinct().orderBy(period)
