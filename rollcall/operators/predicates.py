"""Filter conditions as columns, to be combined with ``&`` and passed to ``DataFrame.filter``,
and the slices of the stacked attendance table.

A value is typed to its column while the plan is built, so the comparison reaches the parquet
scan as a pushed filter. A value that does not fit the column matches nothing; none is an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import ROUND_CEILING, ROUND_FLOOR, Context, Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.functions import column
from rollcall.plans.mart import TOTAL_TYPE

# The text that stands for NULL, and the bits of each integral type.
NULL_TEXT = "null"
_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def _typed(df: DataFrame, name: str, value: object) -> Column:
    return F.lit(value).try_cast(df.schema[name].dataType)


def _compared(df: DataFrame, name: str, value: float | str, above: bool) -> Column:
    """``column > value`` or ``column < value`` with a literal of the column's own type.

    A whole number is above a value if it is above the value rounded down, so nothing is lost to
    doubles and the scan gets the condition; the same holds for the places of a decimal. A bound
    outside the type decides for all rows that are not NULL.
    """
    kind, own = df.schema[name].dataType, column(name)
    try:
        number = Decimal(str(value).strip())
    except InvalidOperation:
        return F.lit(False)
    if number.is_nan():
        return F.lit(False)
    if type(kind) in _BITS or isinstance(kind, T.DecimalType):
        if isinstance(kind, T.DecimalType):
            scale, largest = kind.scale, 10**kind.precision - 1
            smallest = -largest
        else:
            scale, largest = 0, 2 ** (_BITS[type(kind)] - 1) - 1
            smallest = -largest - 1
        if number.is_infinite():
            return own.isNotNull() if (number < 0) == above else F.lit(False)
        exact = Context(prec=2000)
        rounded = number.scaleb(scale, exact).to_integral_value(
            ROUND_FLOOR if above else ROUND_CEILING
        )
        if rounded > largest if above else rounded < smallest:
            return F.lit(False)
        if rounded < smallest if above else rounded > largest:
            return own.isNotNull()
        bound = F.lit(str(rounded.scaleb(-scale, exact))).cast(kind)
    else:
        if not isinstance(kind, T.NumericType):
            own = own.cast("string").try_cast("double")
        bound = F.lit(float(number))
    return own > bound if above else own < bound


def equals(df: DataFrame, name: str, value: object) -> Column:
    return column(name) == _typed(df, name, value)


def differs(df: DataFrame, name: str, value: object) -> Column:
    """True where the value is known and another one; NULL rows drop out."""
    return column(name) != _typed(df, name, value)


def greater(df: DataFrame, name: str, value: float | str) -> Column:
    return _compared(df, name, value, above=True)


def less(df: DataFrame, name: str, value: float | str) -> Column:
    return _compared(df, name, value, above=False)


def contains(name: str, part: str) -> Column:
    return column(name).cast("string").contains(part)


def starts_with(name: str, prefix: str) -> Column:
    return column(name).cast("string").startswith(prefix)


def one_of(df: DataFrame, name: str, values: Sequence[object]) -> Column:
    return column(name).isin([_typed(df, name, value) for value in values])


def present(name: str) -> Column:
    """Neither NULL nor the text ``null``."""
    return column(name).isNotNull() & (column(name).cast("string") != NULL_TEXT)


def period_is(period: int, name: str = "time_period") -> Column:
    return column(name) == int(period)


def period_between(start: int, end: int, name: str = "time_period") -> Column:
    if int(end) < int(start):
        raise ValueError(f"the end period {end} lies before the start period {start}")
    return column(name).between(int(start), int(end))


def level_total(df: DataFrame, level: str) -> DataFrame:
    """Rows of one geographic level over all school types together."""
    return df.filter((F.col("geographic_level") == level) & (F.col("school_type") == TOTAL_TYPE))


def level_by_type(df: DataFrame, level: str) -> DataFrame:
    """Rows of one geographic level, one per school type, in named regions."""
    return df.filter(
        (F.col("geographic_level") == level)
        & (F.col("school_type") != TOTAL_TYPE)
        & present("region_name")
    )


def school_rows(df: DataFrame, school_type: str | None = None) -> DataFrame:
    """Rows of single schools, of one type or (``None``) of all."""
    schools = df.filter(F.col("geographic_level") == "School")
    return schools if school_type is None else schools.filter(F.col("school_type") == school_type)
