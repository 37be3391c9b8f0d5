from __future__ import annotations

import datetime
import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from rollcall.plans import LEVELS, MART_SCHEMA, MEASURES, REASONS, build_attendance_mart
from rollcall.plans import load_attendance_mart
from rollcall.plans.tables import SCHEMAS

DATA = "/root/testdata/sf0.01"

REGIONS = [(0, "North"), (1, "South")]
NATIONS = [(0, "A", 0), (1, "B", 0), (2, "C", 1)]
# Customer 0 will hold a third of all orders. Several customers share one school name, within
# an authority and across authorities, regions and types; two have no name.
CUSTOMERS = [
    (0, "hot", 0, "PRIMARY"),
    (1, "shared", 0, "PRIMARY"),
    (2, "shared", 0, "PRIMARY"),
    (3, "shared", 1, "SPECIAL"),
    (4, "shared", 2, "SPECIAL"),
    (5, "shared", 0, "SPECIAL"),
    (6, None, 1, "PRIMARY"),
    (7, None, 2, "SPECIAL"),
    (8, "alone", 2, None),
]


def _orders_and_lines():
    chance = random.Random(7)
    orders, lines = [], []

    def some_line():
        return chance.randrange(1, 8), chance.randrange(1, 51), chance.choice("RAN")

    for key in range(300):
        customer = 0 if key % 3 == 0 else chance.randrange(1, len(CUSTOMERS))
        date = datetime.datetime(chance.randrange(1995, 2001), chance.randrange(1, 13), 28)
        orders.append((key, customer, date))
        for _ in range(chance.randrange(0, 4)):
            lines.append((key, *some_line()))
    # Order 1 alone has a third of all lines; some lines belong to no order.
    lines += [(1, *some_line()) for _ in range(len(lines) // 2)]
    lines += [(None, 1, 5, "R"), (999, 1, 5, "R")]
    chance.shuffle(lines)
    return orders, lines


def _brute_force(orders, lines):
    """The stacked table by looping, a distinct count as the size of a set."""
    nation = {key: (name, dict(REGIONS)[region]) for key, name, region in NATIONS}
    place = {key: (name, *nation[n], kind) for key, name, n, kind in CUSTOMERS}
    by_order = defaultdict(list)
    for key, number, quantity, flag in lines:
        by_order[key].append((number, quantity, flag))
    cells = defaultdict(lambda: [defaultdict(int), set()])
    for key, customer, date in orders:
        if not by_order[key]:
            continue
        school, la, region, kind = place[customer]
        sums = defaultdict(int, enrolments=1)
        for number, quantity, flag in by_order[key]:
            sums["sess_possible"] += quantity
            if flag == "R":
                sums["sess_authorised"] += quantity
                sums[REASONS[number - 1]] += quantity
            if flag == "A":
                sums["sess_unauthorised"] += quantity
        sums["sess_overall"] = sums["sess_authorised"] + sums["sess_unauthorised"]
        period = date.year * 100 + (date.year + 1) % 100
        targets = [(period, "School", region, la, school, kind)]
        geographies = {
            "National": (None, None),
            "Regional": (region, None),
            "Local authority": (region, la),
        }
        for (level, names), shown in itertools.product(geographies.items(), ("Total", kind)):
            targets.append((period, level, *names, None, shown))
        for target in targets:
            cell = cells[target]
            for name, value in sums.items():
                cell[0][name] += value
            if school is not None:
                cell[1].add(school)
    rows = []
    for key, (sums, schools) in cells.items():
        values = {**sums, "num_schools": len(schools)}
        rows.append((*key, *[values.get(name, 0) for name in MART_SCHEMA.names[6:]]))
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    orders, lines = _orders_and_lines()
    narrow = "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"
    return (
        spark.createDataFrame(
            [(k, n, float(q), f) for k, n, q, f in lines],
            "l_orderkey bigint, l_linenumber int, l_quantity double, l_returnflag string",
        ),
        spark.createDataFrame(orders, narrow),
        spark.createDataFrame(
            CUSTOMERS, "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string"
        ),
        spark.createDataFrame(NATIONS, SCHEMAS["nation"]),
        spark.createDataFrame(REGIONS, SCHEMAS["region"]),
    )


@pytest.fixture(params=["10MB", "-1"], ids=["broadcast", "no-broadcast"])
def broadcasting(spark, request):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _sorted(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_mart_equals_brute_force_with_hot_keys_and_shared_names(tables, broadcasting):
    mart = build_attendance_mart(*tables)
    assert mart.columns == MART_SCHEMA.names
    assert _sorted(mart) == _brute_force(*_orders_and_lines())


@pytest.mark.parametrize("school_counts", [True, False])
@pytest.mark.parametrize(
    "levels",
    [*[(level,) for level in LEVELS], ("National", "Local authority"), ("School", "Regional")],
    ids="+".join,
)
def test_chosen_levels_are_those_rows_of_the_whole(tables, levels, school_counts):
    names = [n for n in MART_SCHEMA.names if school_counts or n != "num_schools"]
    part = build_attendance_mart(*tables, levels=levels, school_counts=school_counts)
    assert part.columns == names
    positions = [MART_SCHEMA.names.index(name) for name in names]
    expected = [
        tuple(row[i] for i in positions)
        for row in _brute_force(*_orders_and_lines())
        if row[1] in levels
    ]
    assert _sorted(part) == sorted(expected, key=repr)


def test_unknown_level_is_an_error(tables):
    with pytest.raises(ValueError):
        build_attendance_mart(*tables, levels=("District",))
    with pytest.raises(ValueError):
        build_attendance_mart(*tables, levels=())


@pytest.fixture(scope="module")
def whole(spark):
    return load_attendance_mart(spark, DATA, school_counts=True).cache()


def test_types_match_the_declared_schema(whole):
    assert [(f.name, f.dataType) for f in whole.schema] == [
        (f.name, f.dataType) for f in MART_SCHEMA
    ]


def test_rows_per_level(whole):
    counts = dict(whole.groupBy("geographic_level").count().collect())
    assert counts == {"National": 42, "Regional": 210, "Local authority": 1050, "School": 7837}


def test_reasons_sum_to_authorised(whole):
    reasons = sum((F.col(r) for r in REASONS), F.lit(0))
    assert whole.filter(reasons != F.col("sess_authorised")).count() == 0
    parts = F.col("sess_authorised") + F.col("sess_unauthorised")
    assert whole.filter(parts != F.col("sess_overall")).count() == 0


def test_levels_add_up(whole):
    totals = (
        whole.filter((F.col("school_type") == "Total") | (F.col("geographic_level") == "School"))
        .groupBy("geographic_level")
        .agg(*[F.sum(m).alias(m) for m in MEASURES])
        .drop("geographic_level")
        .collect()
    )
    assert len(totals) == 4 and len({tuple(t) for t in totals}) == 1
    assert totals[0]["enrolments"] == 14743


def test_types_add_up_to_total(whole):
    flagged = whole.filter("geographic_level <> 'School'").withColumn(
        "all_types", F.col("school_type") == "Total"
    )
    keys = ("time_period", "geographic_level", "region_name", "la_name")
    sums = flagged.groupBy(*keys).agg(
        *[
            F.sum(F.when(F.col("all_types"), F.col(m)).otherwise(-F.col(m))).alias(m)
            for m in MEASURES
        ]
    )
    for measure in MEASURES:
        assert sums.filter(F.col(measure) != 0).count() == 0
