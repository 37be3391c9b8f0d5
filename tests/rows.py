"""Small hand-made frames."""

from __future__ import annotations

from rollcall.plans import MART_SCHEMA


def mart(spark, *rows: dict):
    """Rows of the stacked table; dimensions left out are NULL, measures left out are 0."""
    dimensions = ("time_period", "geographic_level", "region_name", "la_name", "school_name")
    empty = {f.name: None if f.name in dimensions else 0 for f in MART_SCHEMA}
    empty.update(time_period=201819, school_type="Total")
    unknown = {name for row in rows for name in row} - set(empty)
    assert not unknown, unknown
    return spark.createDataFrame([tuple({**empty, **row}.values()) for row in rows], MART_SCHEMA)


def regional(region, period, overall=0, possible=100, school_type="Total", **more):
    return {
        "geographic_level": "Regional",
        "region_name": region,
        "time_period": period,
        "school_type": school_type,
        "sess_overall": overall,
        "sess_possible": possible,
        **more,
    }


def authority(name, period=201819, **more):
    return {
        "geographic_level": "Local authority",
        "region_name": "North",
        "la_name": name,
        "time_period": period,
        **more,
    }


def school(name, school_type, period=201819, **more):
    return {
        "geographic_level": "School",
        "region_name": "North",
        "la_name": "A",
        "school_name": name,
        "school_type": school_type,
        "time_period": period,
        **more,
    }


def dicts(df) -> list[dict]:
    return [row.asDict() for row in df.collect()]
