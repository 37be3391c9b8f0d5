"""What the executed plans must look like, so that they hold on large tables."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from rollcall.catalog import QUERIES
from rollcall.operators import predicates
from rollcall.plans import (
    RECOMMENDED,
    apply_settings,
    build_attendance_mart,
    fold_lines,
    load_attendance_mart,
    read_table,
    save_mart_inputs,
)
from rollcall.sources import attach_bucketed, scratch_path

DATA = "/root/testdata/sf0.001"


def _executed(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _planned(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_cross_join_and_no_python_in_tasks(spark, key):
    plan = _planned(QUERIES[key](spark, DATA))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "RDD"):
        assert forbidden not in plan


@pytest.mark.parametrize(
    ("key", "pushed"),
    [
        ("filter_eq", "EqualTo(o_custkey,42)"),
        ("filter_gt", "GreaterThan(l_quantity,45.0)"),
        ("filter_startswith", "StringStartsWith(c_name,Customer#0000001)"),
        ("filter_in", "In(n_name, [NATION_0,NATION_1,NATION_2,NATION_3])"),
        ("slice_school_type", "EqualTo(c_mktsegment,BUILDING)"),
    ],
)
def test_filters_reach_the_scan(spark, key, pushed):
    assert pushed in _formatted(QUERIES[key](spark, DATA))


def _formatted(df) -> str:
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_projection_reads_two_columns(spark):
    text = _formatted(QUERIES["project_columns"](spark, DATA))
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text


def test_row_count_reads_no_column(spark):
    assert "ReadSchema: struct<>" in _formatted(QUERIES["table_status"](spark, DATA))


def test_regional_rates_read_only_what_they_need(spark):
    text = _formatted(QUERIES["regional_attendance"](spark, DATA))
    assert "struct<l_orderkey:bigint,l_quantity:double,l_returnflag:string>" in text
    assert "c_name" not in text


@pytest.mark.parametrize(
    ("key", "last"),
    [("period_range", 1999)]
    + [
        (key, 1997)
        for key in (
            "period_single", "authorised_reason_breakdown",
            "authorised_reason_totals", "unauthorised_by_region", "unauthorised_by_la",
            "unauthorised_overall", "la_presence", "la_compare_totals", "la_compare_rates",
        )
    ],
)
def test_period_filter_prunes_the_scan_of_the_orders(spark, key, last):
    text = _formatted(QUERIES[key](spark, DATA))
    pushed = next(x for x in re.findall(r"PushedFilters: \[(.*)\]", text) if "o_orderdate" in x)
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in pushed
    assert f"LessThan(o_orderdate,{last}-01-01" in pushed


def test_period_range_gives_the_same_rows_as_the_filter(spark):
    levels = ("Local authority",)
    whole = load_attendance_mart(spark, DATA, levels=levels)
    pruned = load_attendance_mart(spark, DATA, levels=levels, periods=(199697, 199798))
    wanted = whole.filter(F.col("time_period").between(199697, 199798))
    assert pruned.exceptAll(wanted).count() == wanted.exceptAll(pruned).count() == 0


@pytest.mark.parametrize("key", ["sort_asc", "sort_desc"])
def test_sorts_are_distributed(spark, key):
    plan = _planned(QUERIES[key](spark, DATA))
    assert "rangepartitioning" in plan and "SinglePartition" not in plan


@pytest.mark.parametrize(
    "key",
    [
        "null_counts", "null_profile", "fill_null_numeric", "fill_null_text", "replace_suppressed",
        "clean_nulls", "remaining_nulls", "suppressed_to_number", "filter_ne", "filter_lt",
        "filter_present",
    ],
)
def test_unclean_lines_are_treated_where_they_are_read(spark, key):
    plan = _planned(QUERIES[key](spark, DATA))
    assert "Window" not in plan
    for exchange in re.findall(r"Exchange SinglePartition.*\n(.*)", plan):
        assert "partial_" in exchange  # one row of counts per task


def test_rows_come_in_order(spark):
    def rows(key, *names):
        return [tuple(r) for r in QUERIES[key](spark, DATA).select(*names).collect()]

    ascending = rows("sort_asc", "o_orderpriority", "o_orderkey")
    assert ascending == sorted(ascending) and len(ascending) == 1500
    found = rows("sort_desc", "l_extendedprice", "l_orderkey", "l_linenumber")
    assert found == sorted(found, key=lambda r: (-r[0], *r[1:])) and len(found) == 6000
    first = rows("limit_n", "o_orderkey")
    assert first == sorted((key,) for _, key in ascending)[:10]


def test_whole_mart_aggregates_the_lines_once(spark):
    plan = _executed(QUERIES["attendance_mart"](spark, DATA)).split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 1


def test_share_of_total_reuses_the_grouped_rows(spark):
    plan = _executed(QUERIES["unauthorised_by_la"](spark, DATA))
    assert "ReusedExchange" in plan
    assert "Window" not in plan


@pytest.mark.parametrize(
    "key",
    ["limit_n", "preview", "absence_top_combinations", "absence_by_school_type"],
)
def test_top_rows_need_no_full_sort(spark, key):
    assert "TakeOrderedAndProject" in _planned(QUERIES[key](spark, DATA))


def test_comparison_of_bigints_reaches_the_scan(spark):
    lineitem = spark.read.parquet(f"{DATA}/lineitem.parquet")
    chosen = lineitem.filter(predicates.greater(lineitem, "l_orderkey", "900"))
    assert "GreaterThan(l_orderkey,900)" in _formatted(chosen)


PERIOD_KEYS = (
    "period_single", "period_range", "enrolment_one_year", "enrolment_year_range",
    "authorised_reason_breakdown", "authorised_reason_totals", "unauthorised_by_region",
    "unauthorised_by_la", "unauthorised_overall", "la_presence", "la_compare_totals",
    "la_compare_rates",
)


@pytest.fixture
def large_tables(spark):
    """The recommended settings, and lines of any size treated as lines of 10 GB are."""
    size = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = {name: spark.conf.get(name, None) for name in (*RECOMMENDED, size)}
    apply_settings(spark).conf.set(size, "0")
    yield spark
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("key", PERIOD_KEYS)
def test_lines_meet_a_filter_of_the_order_keys_where_they_are_read(large_tables, key):
    if key.startswith("enrolment"):  # the pivot reads a stored table, made from this one
        mart = load_attendance_mart(large_tables, DATA, ("Local authority",), periods=(199697,) * 2)
    else:
        mart = QUERIES[key](large_tables, DATA)
    plan = _optimized(mart)
    found = re.search(r"Filter .*might_contain\(scalar-subquery.*xxhash64\(l_orderkey", plan)
    summed = re.search(r"Aggregate \[l_orderkey", plan)
    assert found and summed.start() < found.start()  # below the sums, so before the shuffle


def test_the_filter_changes_no_row(spark, large_tables):
    def rows():
        mart = load_attendance_mart(spark, DATA, periods=(199697, 199798), school_counts=True)
        return sorted(map(repr, mart.collect()))

    found = rows()
    large_tables.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "false")
    assert rows() == found and found


def test_operators_leave_the_settings_alone_and_queries_set_the_recommended(spark):
    name = "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold"
    spark.conf.unset(name)
    load_attendance_mart(spark, DATA, periods=(199697, 199697)).collect()
    assert spark.conf.get(name, None) != RECOMMENDED[name]
    QUERIES["period_single"](spark, DATA)
    assert {key: spark.conf.get(key) for key in RECOMMENDED} == RECOMMENDED


def _tables(spark):
    names = ("lineitem", "orders", "customer", "nation", "region")
    return [read_table(spark, DATA, name) for name in names]


def _no_broadcast(spark, run):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        return run()
    finally:
        spark.conf.set(name, before)


def test_bucketed_inputs_are_summed_and_joined_without_a_shuffle(spark):
    lineitem, orders, *dimensions = _tables(spark)
    path = scratch_path(spark, "bucketed")
    saved = save_mart_inputs(lineitem, orders, "bucketed_inputs", path, 6)
    mart = build_attendance_mart(*saved, *dimensions)
    plan = _no_broadcast(spark, lambda: _planned(mart))
    for table in ("bucketed_inputs_lines", "bucketed_inputs_orders"):
        above = plan.split(f"FileScan parquet spark_catalog.default.{table}")[0]
        # Going up from the scan, the join of both tables comes before any exchange.
        assert above.rindex("SortMergeJoin [o_orderkey") > above.rindex("Exchange")
    expected = sorted(map(repr, load_attendance_mart(spark, DATA, school_counts=True).collect()))
    assert sorted(map(repr, mart.collect())) == expected
    for name in ("lines", "orders"):
        spark.sql(f"DROP TABLE bucketed_inputs_{name}")
    again = [
        attach_bucketed(spark, f"attached_{n}", f"{path}/{n}", s.schema, [s.columns[0]], 6)
        for n, s in zip(("lines", "orders"), saved, strict=True)
    ]
    mart = build_attendance_mart(*again, *dimensions)
    plan = _no_broadcast(spark, lambda: _planned(mart))
    above = plan.split("FileScan parquet spark_catalog.default.attached_lines")[0]
    assert above.rindex("SortMergeJoin [o_orderkey") > above.rindex("Exchange")
    assert sorted(map(repr, mart.collect())) == expected
    for name in ("lines", "orders"):
        spark.sql(f"DROP TABLE attached_{name}")


def test_a_hot_order_is_a_few_rows_of_its_bucket(spark):
    lineitem, orders, *dimensions = _tables(spark)
    hot = F.when(F.rand(1) < 0.4, F.lit(5)).otherwise(F.col("l_orderkey")).cast("bigint")
    lineitem = spark.createDataFrame(
        lineitem.withColumn("l_orderkey", hot).collect(), lineitem.schema
    ).unionByName(lineitem.limit(3).withColumns(
        {"l_orderkey": F.lit(None).cast("bigint"), "l_quantity": F.lit(0.7)}))
    folded = fold_lines(lineitem)
    assert folded.filter("l_orderkey = 5").count() <= 21
    path = scratch_path(spark, "hot")
    saved = save_mart_inputs(lineitem, orders, "hot_inputs", path, 3)
    found = build_attendance_mart(*saved, *dimensions).collect()
    expected = build_attendance_mart(lineitem, orders, *dimensions).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, expected))
    for name in ("lines", "orders"):
        spark.sql(f"DROP TABLE hot_inputs_{name}")
