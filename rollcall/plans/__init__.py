from rollcall.plans.mart import (
    LEVELS,
    MART_SCHEMA,
    MEASURES,
    REASONS,
    build_attendance_mart,
    fold_lines,
    load_attendance_mart,
    save_mart_inputs,
)
from rollcall.plans.settings import RECOMMENDED, apply_settings
from rollcall.plans.tables import read_table
from rollcall.plans.unclean import build_unclean_lines

__all__ = [
    "LEVELS",
    "MART_SCHEMA",
    "MEASURES",
    "REASONS",
    "RECOMMENDED",
    "apply_settings",
    "build_attendance_mart",
    "build_unclean_lines",
    "fold_lines",
    "load_attendance_mart",
    "read_table",
    "save_mart_inputs",
]
