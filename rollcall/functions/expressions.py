"""Column expressions shared by the operators. All of them stay inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column(name: str) -> Column:
    """The column called exactly ``name``, also when the name contains dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def total(value: Column | str) -> Column:
    """Sum that is 0, not NULL, when there is nothing to add."""
    return or_zero(F.sum(value))


def guarded_ratio(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """``scale * part / whole``, or 0 where ``whole`` is not positive."""
    return F.when(whole > 0, F.try_divide(part * F.lit(scale), whole)).otherwise(F.lit(0.0))


def absence_percent(missed: Column, possible: Column) -> Column:
    """Missed sessions as a percentage of the possible ones, NULL without possible sessions."""
    return F.try_divide(F.lit(100.0) * missed, possible)


def academic_year_label(code: Column) -> Column:
    """``200607`` -> ``2006/07``; only the first four digits of the code count."""
    start = F.substring(code.cast("string"), 1, 4)
    following = (start.try_cast("int") + 1).cast("string")
    return F.concat(start, F.lit("/"), F.substring(following, 3, 2))


def to_rows(one_row: DataFrame, rows: Sequence[Column]) -> DataFrame:
    """Turn a one-row aggregate into one row per struct in ``rows``."""
    return one_row.select(F.inline(F.array(*rows)))
