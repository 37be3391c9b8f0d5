from rollcall.functions.expressions import (
    absence_percent,
    academic_year_label,
    column,
    guarded_ratio,
    or_zero,
    to_rows,
    total,
)

__all__ = [
    "absence_percent",
    "academic_year_label",
    "column",
    "guarded_ratio",
    "or_zero",
    "to_rows",
    "total",
]
