"""Cleaning of missing and suppressed values. Column types never change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from rollcall.functions import column, to_rows
from rollcall.sources import save

# What stands in for a missing number, a missing text and a suppressed number,
# and the mark of a suppressed number.
MISSING_NUMBER = -1
MISSING_TEXT = "MISSING"
SUPPRESSED = ":"
SUPPRESSED_NUMBER = "-1"


def _of_type(df: DataFrame, kind: type) -> list[str]:
    return [field.name for field in df.schema.fields if isinstance(field.dataType, kind)]


def _change(df: DataFrame, changes: dict[str, Column]) -> DataFrame:
    return df.select(*[changes.get(n, column(n)).alias(n) for n in df.columns])


def _has_nulls(df: DataFrame, names: Sequence[str]) -> Column:
    """Array of flags, as an uncorrelated scalar subquery that reads only these columns."""
    flags = [F.coalesce(F.bool_or(column(name).isNull()), F.lit(False)) for name in names]
    return df.agg(F.array(*flags)).scalar()


def _filled_number(name: str) -> Column:
    return F.coalesce(column(name), F.lit(MISSING_NUMBER))


def _filled_text(value: Column) -> Column:
    return F.coalesce(value, F.lit(MISSING_TEXT))


def _unsuppressed(df: DataFrame, columns: Sequence[str] | None) -> dict[str, Column]:
    texts = _of_type(df, StringType)
    chosen = texts if columns is None else [name for name in texts if name in columns]
    if not chosen:
        return {}
    flags = _has_nulls(df, chosen) if columns is None else None
    changes = {}
    for i, name in enumerate(chosen):
        marked = column(name) == SUPPRESSED
        if flags is not None:
            marked = marked & flags[i]
        changes[name] = F.when(marked, SUPPRESSED_NUMBER).otherwise(column(name))
    return changes


def fill_null_numbers(df: DataFrame) -> DataFrame:
    """NULL -> -1 in the 32-bit integer columns. Bigint and double columns keep their NULLs."""
    return _change(df, {name: _filled_number(name) for name in _of_type(df, IntegerType)})


def fill_null_texts(df: DataFrame) -> DataFrame:
    """NULL -> ``MISSING`` in the text columns."""
    return _change(df, {name: _filled_text(column(name)) for name in _of_type(df, StringType)})


def replace_suppressed(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``:`` -> ``-1`` in the text columns that have NULLs, or in those named by ``columns``.

    Which columns have NULLs is found inside the same job, by a pass of its own: name the
    columns to save it, or ``store`` a table that is costly to derive.
    """
    return _change(df, _unsuppressed(df, columns))


def clean_nulls(df: DataFrame, suppressed: Sequence[str] | None = None) -> DataFrame:
    """The three steps above in one projection. NULLs are filled in every column; ``suppressed``
    names the columns of the third step only, as in ``replace_suppressed``.
    """
    texts = {name: column(name) for name in _of_type(df, StringType)}
    changes = {n: _filled_text(v) for n, v in {**texts, **_unsuppressed(df, suppressed)}.items()}
    changes.update({name: _filled_number(name) for name in _of_type(df, IntegerType)})
    return _change(df, changes)


def remaining_nulls(df: DataFrame) -> DataFrame:
    """``(column_name, remaining_nulls)`` after ``clean_nulls``, for the columns that had NULLs.

    Replacing suppressed values neither makes nor removes NULLs, so one pass counts both sides.
    """
    cleaned = {name: _filled_number(name) for name in _of_type(df, IntegerType)}
    cleaned.update({name: _filled_text(column(name)) for name in _of_type(df, StringType)})
    counted = df.agg(
        *[F.count_if(column(n).isNull()).alias(f"before_{i}") for i, n in enumerate(df.columns)],
        *[
            F.count_if(cleaned.get(n, column(n)).isNull()).alias(f"after_{i}")
            for i, n in enumerate(df.columns)
        ],
    )
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"before_{i}").alias("before"),
            F.col(f"after_{i}").alias("remaining_nulls"),
        )
        for i, name in enumerate(df.columns)
    ]
    return to_rows(counted, rows).filter(F.col("before") > 0).drop("before")


def save_cleaned(
    df: DataFrame,
    path: str,
    file_format: str = "csv",
    suppressed: Sequence[str] | None = None,
    mode: str = "errorifexists",
) -> DataFrame:
    """Write the cleaned table and return ``(column_name, null_count, remaining_nulls)`` of every
    column, from one pass: the counts are observed while the rows are written. Only if
    ``suppressed`` is not given does finding its columns need a pass of its own.

    Writing is the last stage, whose tasks count once however often they are tried.
    """
    before, after = Observation(), Observation()
    nulls = [F.count_if(column(name).isNull()).alias(f"c{i}") for i, name in enumerate(df.columns)]
    cleaned = clean_nulls(df.observe(before, *nulls), suppressed).observe(after, *nulls)
    save(cleaned, path, file_format, mode)
    found = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(before.get[f"c{i}"]).cast("long").alias("null_count"),
            F.lit(after.get[f"c{i}"]).cast("long").alias("remaining_nulls"),
        )
        for i, name in enumerate(df.columns)
    ]
    return to_rows(df.sparkSession.range(1), found)


def suppressed_sum(df: DataFrame, name: str) -> DataFrame:
    """Sum of a numeric text column, suppressed and other non-numeric values left out."""
    return df.agg(F.sum(column(name).try_cast("bigint")).alias(f"{name}_sum"))
