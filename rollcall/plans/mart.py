"""The stacked attendance table, derived from the order tables.

One row is one pre-aggregated cell: a period, a geographic level with its names, a school
type (``Total`` = all types together) and additive measures. Orders play the enrolments,
line quantities the sessions, customers the schools.

How the plan is laid out for large inputs:

* every shuffle carries partial aggregates, so an order, customer or school that owns a
  large part of all rows shrinks to a few rows before it leaves its map task;
* lines meet orders once, on the order key, and orders are folded to one row per customer
  and year before they meet the customers;
* no join is hinted. Spark broadcasts a dimension only if its files are below
  ``spark.sql.autoBroadcastJoinThreshold``; any larger one is joined by shuffling;
* levels above the school are rolled up from cells of (year, region, authority, type),
  whose number depends on the geography and not on the data size, so the rows that the
  grouping sets multiply are few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollcall.plans.tables import read_table
from rollcall.sources import save_bucketed

# Geographic levels, coarse to fine, and the marker for "all school types".
NATIONAL = "National"
REGIONAL = "Regional"
LOCAL_AUTHORITY = "Local authority"
SCHOOL = "School"
LEVELS = (NATIONAL, REGIONAL, LOCAL_AUTHORITY, SCHOOL)
TOTAL_TYPE = "Total"

# Reasons of authorised absence, in the order of line numbers 1 to 7.
REASONS = (
    "sess_auth_appointments",
    "sess_auth_holiday",
    "sess_auth_illness",
    "sess_auth_other",
    "sess_auth_religious",
    "sess_auth_study",
    "sess_auth_traveller",
)

SESSIONS = ("sess_possible", "sess_authorised", "sess_unauthorised", "sess_overall", *REASONS)
MEASURES = ("enrolments", *SESSIONS)

_GEOGRAPHY = {
    NATIONAL: (),
    REGIONAL: ("region_name",),
    LOCAL_AUTHORITY: ("region_name", "la_name"),
}

MART_SCHEMA = T.StructType(
    [T.StructField("time_period", T.IntegerType())]
    + [
        T.StructField(name, T.StringType())
        for name in ("geographic_level", "region_name", "la_name", "school_name", "school_type")
    ]
    + [
        T.StructField(name, T.LongType())
        for name in ("enrolments", "num_schools", *SESSIONS)
    ]
)


def load_attendance_mart(
    spark: SparkSession,
    data_dir: str,
    levels: Sequence[str] = LEVELS,
    school_counts: bool = False,
    periods: tuple[int, int] | None = None,
) -> DataFrame:
    """The mart over the parquet tables in ``data_dir``; see ``build_attendance_mart``."""
    names = ("lineitem", "orders", "customer", "nation", "region")
    tables = [read_table(spark, data_dir, name) for name in names]
    return build_attendance_mart(
        *tables, levels=levels, school_counts=school_counts, periods=periods
    )


def fold_lines(lineitem: DataFrame) -> DataFrame:
    """The lines with whole quantities summed per order, flag and line number: the mart over them
    is that over the lines, and an order with very many lines is a few rows.
    """
    return lineitem.groupBy("l_orderkey", "l_returnflag", "l_linenumber").agg(
        F.expr("sum(cast(l_quantity AS bigint)) AS l_quantity")
    )


def save_mart_inputs(
    lineitem: DataFrame, orders: DataFrame, name: str, path: str, buckets: int
) -> tuple[DataFrame, DataFrame]:
    """Lines (folded) and orders as the tables ``name``_lines and ``name``_orders with files under
    ``path``, both in ``buckets`` by the order key. A mart built from what is returned sums and
    joins them without a shuffle of either; write them once, use them for every later mart.
    """
    lines = save_bucketed(
        fold_lines(lineitem), f"{name}_lines", f"{path}/lines", ["l_orderkey"], buckets
    )
    kept = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return lines, save_bucketed(
        kept, f"{name}_orders", f"{path}/orders", ["o_orderkey"], buckets
    )


def build_attendance_mart(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    nation: DataFrame,
    region: DataFrame,
    levels: Sequence[str] = LEVELS,
    school_counts: bool = True,
    periods: tuple[int, int] | None = None,
) -> DataFrame:
    """Rows of the requested ``levels``. ``num_schools`` is present only with ``school_counts``:
    a distinct count needs rows per school, which the other measures of coarse levels avoid.

    ``periods`` (first and last, as 199697) keeps only these: as a range of the order date, which
    the scan can use to skip row groups, unlike a condition on the computed period.
    """
    if periods is not None:
        first, last = (int(period) // 100 for period in periods)
        orders = orders.filter(
            F.expr(
                f"o_orderdate >= timestamp_ntz'{first:04d}-01-01 00:00:00'"
                f" AND o_orderdate < timestamp_ntz'{last + 1:04d}-01-01 00:00:00'"
            )
        )
    unknown = set(levels) - set(LEVELS)
    if unknown or not levels:
        raise ValueError(f"levels must be a non-empty choice of {LEVELS}, got {tuple(levels)}")
    facts = _placed(_customer_years(lineitem, orders), customer, nation, region)
    coarse = [level for level in LEVELS if level in levels and level != SCHOOL]
    parts = []
    if SCHOOL in levels or school_counts:
        schools = _cells(facts, ("region_name", "la_name", "school_name", "school_type"))
    if coarse:
        cells = _counted(schools) if school_counts else facts
        parts.append(_coarse(cells, coarse))
    if SCHOOL in levels:
        parts.append(_school_rows(schools, school_counts))
    stacked = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return stacked.select(*[n for n in MART_SCHEMA.names if school_counts or n != "num_schools"])


def _sums(names: Sequence[str]) -> list[Column]:
    # SQL text, because the plan holds dozens of these and each Column call costs milliseconds.
    return [F.expr(f"sum({name}) AS {name}") for name in names]


def _customer_years(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per customer and academic year, for orders that have lines."""

    def sessions(condition: str, name: str) -> Column:
        return F.expr(f"sum(if({condition}, cast(l_quantity AS bigint), 0)) AS {name}")

    per_order = lineitem.groupBy("l_orderkey").agg(
        F.expr("sum(cast(l_quantity AS bigint)) AS sess_possible"),
        sessions("l_returnflag = 'R'", "sess_authorised"),
        sessions("l_returnflag = 'A'", "sess_unauthorised"),
        sessions("l_returnflag IN ('R', 'A')", "sess_overall"),
        *[
            sessions(f"l_returnflag = 'R' AND l_linenumber = {number}", reason)
            for number, reason in enumerate(REASONS, start=1)
        ],
    )
    period = "year(o_orderdate) * 100 + (year(o_orderdate) + 1) % 100 AS time_period"
    return (
        orders.selectExpr("o_orderkey", "o_custkey", period)
        .join(per_order, F.expr("o_orderkey = l_orderkey"))
        .groupBy("o_custkey", "time_period")
        .agg(F.expr("count(*) AS enrolments"), *_sums(SESSIONS))
    )


def _placed(
    customer_years: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    # Geography first: a filter on areas then shrinks the customers before they meet the years.
    places = customer.join(nation, F.expr("c_nationkey = n_nationkey")).join(
        region, F.expr("n_regionkey = r_regionkey")
    )
    return (
        customer_years.join(places, F.expr("o_custkey = c_custkey"))
        .selectExpr(
            "time_period",
            "r_name AS region_name",
            "n_name AS la_name",
            "c_name AS school_name",
            "c_mktsegment AS school_type",
            *MEASURES,
        )
    )


def _cells(facts: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    return facts.groupBy("time_period", *dimensions).agg(*_sums(MEASURES))


def _grouping_sets(levels: Sequence[str]) -> list[tuple[str, tuple[str, ...]]]:
    """The level and the dimensions beside the period, with and without the school type."""
    return [
        (level, _GEOGRAPHY[level] + extra) for level in levels for extra in ((), ("school_type",))
    ]


def _count_column(dimensions: Sequence[str]) -> str:
    return "_".join(("schools_per", *dimensions))


def _counted(schools: DataFrame) -> DataFrame:
    """Mark, per grouping set, the first cell of each school, so that the distinct count of
    schools becomes a sum. One school in one period has at most one cell per authority and
    type, so no window is large; all windows share one partitioning by period and school, and
    the sets without a school type come first so that two sort orders serve them all.
    """
    marked = schools
    sets = [dimensions for _, dimensions in _grouping_sets(list(_GEOGRAPHY))]
    for dimensions in sorted(sets, key=lambda names: "school_type" in names):
        first = F.col("school_name").isNotNull()
        rest = [n for n in ("region_name", "la_name", "school_type") if n not in dimensions]
        if rest:
            keys = sorted(dimensions, key=lambda name: name != "school_type")
            window = Window.partitionBy("time_period", "school_name", *keys).orderBy(*rest)
            first = first & (F.row_number().over(window) == 1)
        marked = marked.withColumn(_count_column(dimensions), first.cast("bigint"))
    return marked


def _coarse(cells: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Roll the levels above the school up from cells.

    The grouping sets are spelled out as one generated row per set instead of
    ``DataFrame.groupingSets``: a filter on the period, or on geography that all sets share,
    then reaches the scans, which the expansion behind ``groupingSets`` would hold back.
    """
    shared = _GEOGRAPHY[levels[0]]
    sets = _grouping_sets(levels)
    counts = [_count_column(s) for _, s in sets if _count_column(s) in cells.columns]
    grain = cells.groupBy("time_period", *_GEOGRAPHY[levels[-1]], "school_type").agg(
        *_sums(MEASURES), *_sums(counts)
    )

    def member(level: str, dimensions: Sequence[str]) -> str:
        values = {
            "geographic_level": f"'{level}'",
            "region_name": "CAST(NULL AS string)",
            "la_name": "CAST(NULL AS string)",
            "school_type": f"'{TOTAL_TYPE}'",
            **{name: name for name in dimensions},
        }
        if counts:
            values["num_schools"] = _count_column(dimensions)
        fields = [f"{value} AS {name}" for name, value in values.items() if name not in shared]
        return f"struct({', '.join(fields)})"

    added = (*MEASURES, "num_schools") if counts else MEASURES
    names = ("time_period", "geographic_level", "region_name", "la_name", "school_type")
    return (
        grain.selectExpr(
            "time_period",
            *shared,
            *MEASURES,
            f"inline(array({', '.join(member(*s) for s in sets)}))",
        )
        .groupBy(*names)
        .agg(*_sums(added))
        .withColumn("school_name", F.expr("CAST(NULL AS string)"))
    )


def _school_rows(schools: DataFrame, school_counts: bool) -> DataFrame:
    return schools.selectExpr(
        "time_period",
        f"'{SCHOOL}' AS geographic_level",
        "region_name",
        "la_name",
        "school_name",
        "school_type",
        *MEASURES,
        *(["cast(school_name IS NOT NULL AS bigint) AS num_schools"] if school_counts else []),
    )
