"""The same queries as SQL over the same tables, for an independent check.

``MART`` states the stacked table with plain grouping sets; each query builds on it or reads
the base tables.
"""

from __future__ import annotations

_REASONS = (
    "sess_auth_appointments",
    "sess_auth_holiday",
    "sess_auth_illness",
    "sess_auth_other",
    "sess_auth_religious",
    "sess_auth_study",
    "sess_auth_traveller",
)
_SESSIONS = ("sess_possible", "sess_authorised", "sess_unauthorised", "sess_overall", *_REASONS)

_REASON_SUMS = ",\n    ".join(
    f"SUM(CASE WHEN l_returnflag = 'R' AND l_linenumber = {i}"
    f" THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS {reason}"
    for i, reason in enumerate(_REASONS, start=1)
)
_SESSION_SUMS = ",\n    ".join(f"CAST(SUM({s}) AS BIGINT) AS {s}" for s in _SESSIONS)

MART = f"""
per_order AS (
  SELECT l_orderkey,
    SUM(CAST(l_quantity AS BIGINT)) AS sess_possible,
    SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END)
      AS sess_authorised,
    SUM(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) ELSE 0 END)
      AS sess_unauthorised,
    SUM(CASE WHEN l_returnflag IN ('R', 'A') THEN CAST(l_quantity AS BIGINT) ELSE 0 END)
      AS sess_overall,
    {_REASON_SUMS}
  FROM lineitem GROUP BY l_orderkey),
base AS (
  SELECT year(o_orderdate) * 100 + (year(o_orderdate) + 1) % 100 AS period,
    r_name, n_name, c_name, c_mktsegment, per_order.*
  FROM per_order
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey),
mart AS (
  SELECT CAST(period AS INTEGER) AS time_period,
    CASE WHEN GROUPING(c_name) = 0 THEN 'School'
         WHEN GROUPING(n_name) = 0 THEN 'Local authority'
         WHEN GROUPING(r_name) = 0 THEN 'Regional'
         ELSE 'National' END AS geographic_level,
    r_name AS region_name,
    n_name AS la_name,
    c_name AS school_name,
    CASE WHEN GROUPING(c_mktsegment) = 0 THEN c_mktsegment ELSE 'Total' END AS school_type,
    COUNT(*) AS enrolments,
    COUNT(DISTINCT c_name) AS num_schools,
    {_SESSION_SUMS}
  FROM base
  GROUP BY GROUPING SETS (
    (period), (period, c_mktsegment),
    (period, r_name), (period, r_name, c_mktsegment),
    (period, r_name, n_name), (period, r_name, n_name, c_mktsegment),
    (period, r_name, n_name, c_name, c_mktsegment)))
"""

UNCLEAN = """
unclean AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_orderkey % 11 = 0 THEN 'null' WHEN l_orderkey % 17 <> 0 THEN l_returnflag END
      AS flag_s,
    CASE WHEN l_orderkey % 7 <> 0 THEN CAST(l_quantity AS INTEGER) END AS quantity_i,
    CASE WHEN l_orderkey % 5 <> 0 THEN l_partkey END AS part_l,
    CASE WHEN l_orderkey % 13 <> 0 THEN l_extendedprice END AS price_d,
    CASE WHEN l_orderkey % 9 = 0 THEN NULL WHEN l_orderkey % 6 = 0 THEN ':'
         ELSE CAST(l_suppkey AS VARCHAR) END AS supplier_s
  FROM lineitem)
"""

_CELLS = f"""{MART},
cells AS (
  SELECT school_type, region_name, time_period,
    CAST(SUM(sess_overall) AS BIGINT) AS total_sessions,
    CAST(SUM(sess_possible) AS BIGINT) AS total_possible_sessions
  FROM mart
  WHERE geographic_level = 'Regional' AND school_type <> 'Total'
    AND region_name IS NOT NULL AND region_name <> 'null'
  GROUP BY school_type, region_name, time_period)
"""

_RATES = f"""{MART},
rates AS (
  SELECT region_name, time_period,
    100 * (1 - SUM(sess_overall)::DOUBLE / NULLIF(SUM(sess_possible), 0)) AS avg_attendance,
    100.0::DOUBLE * SUM(sess_overall) / NULLIF(SUM(sess_possible), 0) AS avg_absence
  FROM mart
  WHERE geographic_level = 'Regional' AND school_type = 'Total'
    AND region_name IS NOT NULL AND region_name <> 'null'
  GROUP BY region_name, time_period)
"""

_PERFORMANCE = f"""{_RATES},
performance AS (
  SELECT region_name,
    ARG_MAX(avg_attendance, time_period) - ARG_MIN(avg_attendance, time_period) AS change,
    AVG(avg_attendance) AS average
  FROM rates GROUP BY region_name)
"""

_SUMS = """CAST(SUM(total_sessions) AS BIGINT) AS total_sessions,
  CAST(SUM(total_possible_sessions) AS BIGINT) AS total_possible_sessions,
  ROUND(100.0::DOUBLE * SUM(total_sessions) / NULLIF(SUM(total_possible_sessions), 0), 6)
    AS avg_absence_rate"""

_COLUMNS = ", ".join(
    (
        "time_period",
        "geographic_level",
        "region_name",
        "la_name",
        "school_name",
        "school_type",
        "enrolments",
        *_SESSIONS,
    )
)
_LA_TOTAL = "geographic_level = 'Local authority' AND school_type = 'Total'"
_BUILDING = "geographic_level = 'School' AND school_type = 'BUILDING'"
_FOUR = "la_name IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3')"
_PERIODS = (199596, 199697, 199798, 199899, 199900, 200001, 200102)
_ORDERS = (
    "o_orderkey, o_custkey, o_orderstatus, o_totalprice,"
    " strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority"
)
_LINES = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,"
    " l_tax, l_returnflag, l_linestatus,"
    " strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate"
)
_UNCLEAN_COLUMNS = (
    "l_orderkey",
    "l_linenumber",
    "flag_s",
    "quantity_i",
    "part_l",
    "price_d",
    "supplier_s",
)


def _ratio(part: str, whole: str, scale: str = "1.0") -> str:
    """Guarded division: 0 where ``whole`` is not positive."""
    return (
        f"ROUND(CASE WHEN {whole} > 0 THEN {scale}::DOUBLE * {part} / {whole} ELSE 0 END, 6)"
    )


def _each(template: str, values: tuple[str, ...]) -> str:
    return " UNION ALL ".join(template.format(v=value) for value in values)


_LINE_NUMBERS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
)

# The tables of a data directory.
_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

ORACLES: dict[str, str] = {}

ORACLES["attendance_mart"] = f"WITH {MART} SELECT * FROM mart"

ORACLES["attendance_mart_bucketed"] = ORACLES["attendance_mart"]

# --- sources and sinks ---------------------------------------------------------------------

# Inferred types: a column whose values fit 32 bits comes back as INTEGER.
ORACLES["scan_csv_raw"] = """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
  o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
  o_orderpriority FROM orders"""
ORACLES["scan_csv_saved"] = """
SELECT CAST(doc_id AS INTEGER) AS doc_id, text, lang, source,
  CAST(n_chars AS INTEGER) AS n_chars FROM documents"""
ORACLES["saved_csv_types"] = """
SELECT o_orderkey, lpad(o_orderkey::VARCHAR, 12, '0') AS code,
  o_custkey || '.' || (o_orderkey % 10) || '0' AS amount, strftime(o_orderdate, '%Y-%m-%d') AS day,
  o_totalprice, CASE WHEN o_custkey % 3 = 0 THEN o_custkey END AS customer FROM orders"""
for _sink in ("sink_csv", "sink_parquet", "sink_json"):
    ORACLES[_sink] = f"WITH {MART} SELECT * FROM mart"
# In the data compared, each table is one file.
ORACLES["source_file_inventory"] = _each(
    "SELECT '{v}' AS table_name, CAST(1 AS BIGINT) AS file_count, COUNT(*) AS row_count,"
    " true AS sized, true AS timed FROM {v}",
    _TABLES,
)
ORACLES["list_files"] = """
SELECT DISTINCT 'n_regionkey=' || n_regionkey AS directory, true AS is_parquet, true AS sized,
  true AS timed FROM nation"""
ORACLES["list_directories"] = """
SELECT DISTINCT 'n_regionkey=' || n_regionkey AS directory, CAST(1 AS BIGINT) AS file_count,
  true AS sized, true AS timed FROM nation"""
ORACLES["sink_mode_append"] = "SELECT * FROM customer UNION ALL SELECT * FROM customer"
ORACLES["sink_mode_overwrite"] = "SELECT * FROM customer"

# --- profiling -----------------------------------------------------------------------------

ORACLES["null_counts"] = f"WITH {UNCLEAN} " + _each(
    "SELECT '{v}' AS column_name, COUNT(*) - COUNT({v}) AS null_count FROM unclean",
    _UNCLEAN_COLUMNS,
)
_profile = _each(
    "SELECT '{v}' AS column_name, COUNT(*) - COUNT({v}) AS null_count,"
    " ROUND(100.0::DOUBLE * (COUNT(*) - COUNT({v})) / COUNT(*), 6) AS null_percent FROM unclean",
    _UNCLEAN_COLUMNS,
)
ORACLES["null_profile"] = (
    f"WITH {UNCLEAN} SELECT * FROM ({_profile}) AS p WHERE null_count > 0"
)
ORACLES["table_status"] = """
SELECT COUNT(*) AS row_count, (SELECT COUNT(*) FROM (DESCRIBE lineitem)) AS column_count
FROM lineitem"""
ORACLES["preview"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
  LEAST(CAST(5 AS BIGINT), (SELECT COUNT(*) FROM lineitem)) AS shown_rows,
  (SELECT COUNT(*) FROM lineitem) AS total_rows,
  CAST(6 AS BIGINT) AS shown_columns, (SELECT COUNT(*) FROM (DESCRIBE lineitem)) AS total_columns
FROM lineitem
ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
  l_tax, l_returnflag, l_linestatus, l_shipdate
LIMIT 5"""
ORACLES["numeric_summary"] = _each(
    "SELECT '{v}' AS column_name, COUNT({v}) AS non_null_count, ROUND(AVG({v}), 6) AS mean,"
    " ROUND(CAST(MIN({v}) AS DOUBLE), 6) AS minimum,"
    " ROUND(CAST(MAX({v}) AS DOUBLE), 6) AS maximum, CAST(MIN({v}) AS VARCHAR) AS minimum_exact,"
    " CAST(MAX({v}) AS VARCHAR) AS maximum_exact FROM lineitem",
    _LINE_NUMBERS,
)
ORACLES["distinct_values"] = f"""
WITH {MART} SELECT DISTINCT school_type FROM mart
WHERE geographic_level = 'School' AND school_type IS NOT NULL"""
ORACLES["value_counts"] = f"""
WITH {MART} SELECT la_name, COUNT(*) AS row_count FROM mart
WHERE {_LA_TOTAL} AND la_name IS NOT NULL GROUP BY la_name"""
ORACLES["available_years"] = f"""
WITH {MART} SELECT DISTINCT CAST(time_period AS VARCHAR) AS time_period FROM mart
WHERE {_LA_TOTAL}"""
ORACLES["pattern_scope"] = f"""
WITH {_CELLS} SELECT COUNT(DISTINCT school_type) AS school_type_count,
  COUNT(DISTINCT region_name) AS region_count,
  MIN(time_period) AS first_period, MAX(time_period) AS last_period FROM cells"""

# --- cleaning ------------------------------------------------------------------------------

ORACLES["fill_null_numeric"] = f"""
WITH {UNCLEAN} SELECT l_orderkey, l_linenumber, flag_s, COALESCE(quantity_i, -1) AS quantity_i,
  part_l, price_d, supplier_s FROM unclean"""
ORACLES["fill_null_text"] = f"""
WITH {UNCLEAN} SELECT l_orderkey, l_linenumber, COALESCE(flag_s, 'MISSING') AS flag_s, quantity_i,
  part_l, price_d, COALESCE(supplier_s, 'MISSING') AS supplier_s FROM unclean"""
ORACLES["replace_suppressed"] = f"""
WITH {UNCLEAN} SELECT l_orderkey, l_linenumber,
  CASE WHEN flag_s = ':' AND (SELECT COUNT(*) - COUNT(flag_s) FROM unclean) > 0
       THEN '-1' ELSE flag_s END AS flag_s,
  quantity_i, part_l, price_d,
  CASE WHEN supplier_s = ':' AND (SELECT COUNT(*) - COUNT(supplier_s) FROM unclean) > 0
       THEN '-1' ELSE supplier_s END AS supplier_s FROM unclean"""
ORACLES["clean_nulls"] = f"""
WITH {UNCLEAN} SELECT l_orderkey, l_linenumber,
  CASE WHEN flag_s = ':' AND (SELECT COUNT(*) - COUNT(flag_s) FROM unclean) > 0
       THEN '-1' ELSE COALESCE(flag_s, 'MISSING') END AS flag_s,
  COALESCE(quantity_i, -1) AS quantity_i, part_l, price_d,
  CASE WHEN supplier_s = ':' AND (SELECT COUNT(*) - COUNT(supplier_s) FROM unclean) > 0
       THEN '-1' ELSE COALESCE(supplier_s, 'MISSING') END AS supplier_s FROM unclean"""
ORACLES["remaining_nulls"] = f"""
WITH {UNCLEAN},
cleaned AS (
  SELECT COALESCE(flag_s, 'MISSING') AS flag_s,
    COALESCE(quantity_i, -1) AS quantity_i, part_l, price_d,
    COALESCE(supplier_s, 'MISSING') AS supplier_s FROM unclean)
""" + _each(
    "SELECT '{v}' AS column_name, COUNT(*) - COUNT({v}) AS remaining_nulls FROM cleaned"
    " HAVING (SELECT COUNT(*) - COUNT({v}) FROM unclean) > 0",
    _UNCLEAN_COLUMNS[2:],
)
ORACLES["save_cleaned"] = f"""
WITH {UNCLEAN},
cleaned AS (
  SELECT l_orderkey, COALESCE(l_linenumber, -1) AS l_linenumber,
    COALESCE(flag_s, 'MISSING') AS flag_s,
    COALESCE(quantity_i, -1) AS quantity_i, part_l, price_d,
    COALESCE(supplier_s, 'MISSING') AS supplier_s FROM unclean)
""" + _each(
    "SELECT '{v}' AS column_name, (SELECT COUNT(*) - COUNT({v}) FROM unclean) AS null_count,"
    " COUNT(*) - COUNT({v}) AS remaining_nulls FROM cleaned",
    _UNCLEAN_COLUMNS,
)
ORACLES["suppressed_to_number"] = f"""
WITH {UNCLEAN} SELECT CAST(SUM(TRY_CAST(supplier_s AS BIGINT)) AS BIGINT) AS supplier_s_sum
FROM unclean"""

# --- filters and projections ---------------------------------------------------------------

ORACLES["filter_eq"] = f"SELECT {_ORDERS} FROM orders WHERE o_custkey = 42"
ORACLES["filter_ne"] = f"WITH {UNCLEAN} SELECT * FROM unclean WHERE flag_s <> 'R'"
ORACLES["filter_gt"] = f"SELECT {_LINES} FROM lineitem WHERE l_quantity > 45"
ORACLES["filter_lt"] = f"""
WITH {UNCLEAN} SELECT * FROM unclean WHERE TRY_CAST(supplier_s AS DOUBLE) < 40"""
ORACLES["filter_contains"] = f"""
SELECT {_ORDERS} FROM orders WHERE CAST(o_custkey AS VARCHAR) LIKE '%99%'"""
ORACLES["filter_startswith"] = "SELECT * FROM customer WHERE c_name LIKE 'Customer#0000001%'"
ORACLES["filter_in"] = f"WITH {MART} SELECT {_COLUMNS} FROM mart WHERE {_LA_TOTAL} AND {_FOUR}"
ORACLES["filter_present"] = f"""
WITH {UNCLEAN} SELECT * FROM unclean WHERE flag_s IS NOT NULL AND flag_s <> 'null'"""
ORACLES["slice_level_total"] = f"WITH {MART} SELECT {_COLUMNS} FROM mart WHERE {_LA_TOTAL}"
ORACLES["slice_level_by_type"] = f"""
WITH {MART} SELECT {_COLUMNS} FROM mart
WHERE geographic_level = 'Regional' AND school_type <> 'Total'
  AND region_name IS NOT NULL AND region_name <> 'null'"""
ORACLES["slice_school_type"] = f"WITH {MART} SELECT {_COLUMNS} FROM mart WHERE {_BUILDING}"
ORACLES["period_single"] = f"""
WITH {MART} SELECT {_COLUMNS} FROM mart WHERE {_BUILDING} AND time_period = 199697"""
ORACLES["period_range"] = f"""
WITH {MART} SELECT {_COLUMNS} FROM mart
WHERE {_BUILDING} AND time_period BETWEEN 199697 AND 199899"""
ORACLES["project_columns"] = "SELECT l_orderkey, l_quantity FROM lineitem"

# --- enrolment and absence -----------------------------------------------------------------

def _enrolments(periods: tuple[int, ...]) -> str:
    """SQL must spell the columns out; the query finds them."""
    years = ", ".join(
        f"CAST(COALESCE(SUM(enrolments) FILTER (WHERE time_period = {p}), 0) AS BIGINT) AS y{p}"
        for p in periods
    )
    return f"""
WITH {MART} SELECT la_name, {years}, CAST(SUM(enrolments) AS BIGINT) AS total
FROM mart WHERE {_LA_TOTAL} AND {_FOUR} AND time_period BETWEEN {periods[0]} AND {periods[-1]}
GROUP BY la_name"""


ORACLES["enrolment_by_la_year"] = _enrolments(_PERIODS)
ORACLES["enrolment_one_year"] = _enrolments(_PERIODS[1:2])
ORACLES["enrolment_year_range"] = _enrolments(_PERIODS[1:4])
ORACLES["enrolment_year_summary"] = f"""
WITH {MART} SELECT time_period, CAST(SUM(enrolments) AS BIGINT) AS total_enrolments,
  ROUND(SUM(enrolments)::DOUBLE / 4, 6) AS average_per_la
FROM mart WHERE {_LA_TOTAL} AND {_FOUR} GROUP BY time_period"""
for _key, _schools in (
    ("authorised_absence_by_year", _BUILDING),
    ("authorised_absence_all_types", "geographic_level = 'School'"),
):
    ORACLES[_key] = f"""
WITH {MART} SELECT time_period, CAST(SUM(sess_authorised) AS BIGINT) AS total_absences,
  CAST(SUM(enrolments) AS BIGINT) AS total_enrolments,
  {_ratio("SUM(sess_authorised)", "SUM(enrolments)")} AS absences_per_student
FROM mart WHERE {_schools} GROUP BY time_period"""

# Labels in the results, here and below for the comparison of authorities.
_REASON_LABELS = (
    ("sess_auth_appointments", "Medical appointments"),
    ("sess_auth_holiday", "Authorised holiday"),
    ("sess_auth_illness", "Illness"),
    ("sess_auth_other", "Other authorised"),
    ("sess_auth_religious", "Religious observance"),
    ("sess_auth_study", "Study leave"),
    ("sess_auth_traveller", "Traveller"),
)
ORACLES["authorised_reason_breakdown"] = f"WITH {MART} " + " UNION ALL ".join(
    f"""SELECT '{label}' AS absence_type,
  CAST(COALESCE(SUM({reason}), 0) AS BIGINT) AS total_sessions,
  {_ratio(f"SUM({reason})", "SUM(sess_authorised)", "100.0")} AS percent_of_authorised,
  {_ratio(f"SUM({reason})", "SUM(enrolments)")} AS sessions_per_student
FROM mart WHERE {_BUILDING} AND time_period = 199697"""
    for reason, label in _REASON_LABELS
)
ORACLES["authorised_reason_totals"] = f"""
WITH {MART} SELECT CAST(COALESCE(SUM(enrolments), 0) AS BIGINT) AS total_students,
  CAST(COALESCE(SUM(sess_authorised), 0) AS BIGINT) AS total_authorised
FROM mart WHERE {_BUILDING} AND time_period = 199697"""


def _areas(area: str, level: str) -> str:
    return f"""{MART},
areas AS (
  SELECT {area}, CAST(COALESCE(SUM(sess_unauthorised), 0) AS BIGINT) AS total_unauthorised,
    CAST(COALESCE(SUM(enrolments), 0) AS BIGINT) AS total_students
  FROM mart
  WHERE geographic_level = '{level}' AND school_type = 'Total' AND time_period = 199697
    AND {area} IS NOT NULL AND {area} <> 'null'
  GROUP BY {area}),
overall AS (
  SELECT CAST(COALESCE(SUM(total_unauthorised), 0) AS BIGINT) AS overall_unauthorised,
    CAST(COALESCE(SUM(total_students), 0) AS BIGINT) AS overall_students FROM areas)
"""


for _key, _area, _level in (
    ("unauthorised_by_region", "region_name", "Regional"),
    ("unauthorised_by_la", "la_name", "Local authority"),
):
    ORACLES[_key] = f"""
WITH {_areas(_area, _level)} SELECT {_area}, total_unauthorised, total_students,
  {_ratio("total_unauthorised", "overall_unauthorised", "100.0")} AS percent_of_all,
  {_ratio("total_unauthorised", "total_students")} AS sessions_per_student
FROM areas CROSS JOIN overall"""
ORACLES["unauthorised_overall"] = f"""
WITH {_areas("la_name", "Local authority")} SELECT overall_unauthorised, overall_students,
  {_ratio("overall_unauthorised", "overall_students")} AS overall_sessions_per_student
FROM overall"""

_PAIR_MEASURES = ("enrolments", "sess_authorised", "sess_unauthorised", "sess_possible")
_pair_sums = ", ".join(
    f"CAST(COALESCE(SUM({m}) FILTER (WHERE la_name = 'NATION_{side - 1}'), 0) AS BIGINT)"
    f" AS {m}_{side}"
    for m in _PAIR_MEASURES
    for side in (1, 2)
)
_PAIR = f"""{MART},
pair AS (
  SELECT {_pair_sums} FROM mart
  WHERE {_LA_TOTAL} AND time_period = 199697 AND la_name IN ('NATION_0', 'NATION_1'))
"""
_DIFFERENCE = """value_1, value_2, {difference} AS difference,
  CASE WHEN value_1 - value_2 > 0 THEN 'higher' ELSE 'lower' END AS direction"""
ORACLES["la_presence"] = f"""
WITH {MART}, wanted(la_name) AS (VALUES ('NATION_0'), ('NATION_1'))
SELECT wanted.la_name, COUNT(mart.la_name) AS row_count, COUNT(mart.la_name) > 0 AS has_data
FROM wanted LEFT JOIN mart ON mart.la_name = wanted.la_name AND {_LA_TOTAL}
  AND time_period = 199697
GROUP BY wanted.la_name"""
_totals = " UNION ALL ".join(
    f"SELECT '{label}' AS metric, {m}_1 AS value_1, {m}_2 AS value_2 FROM pair"
    for label, m in zip(
        (
            "Total Enrolments",
            "Total Authorised Absences",
            "Total Unauthorised Absences",
            "Total Possible Sessions",
        ),
        _PAIR_MEASURES,
    )
)
ORACLES["la_compare_totals"] = f"""
WITH {_PAIR} SELECT metric, {_DIFFERENCE.format(difference="ABS(value_1 - value_2)")}
FROM ({_totals}) AS t"""


def _rate(measure: str, side: int) -> str:
    return (
        f"CASE WHEN sess_possible_{side} > 0"
        f" THEN 100.0::DOUBLE * {measure}_{side} / sess_possible_{side} ELSE 0 END"
    )


_rates = " UNION ALL ".join(
    f"SELECT '{label}' AS metric, "
    + ", ".join(
        " + ".join(_rate(m, side) for m in measures) + f" AS value_{side}" for side in (1, 2)
    )
    + " FROM pair"
    for label, measures in (
        ("Authorised Absence Rate", ("sess_authorised",)),
        ("Unauthorised Absence Rate", ("sess_unauthorised",)),
        ("Total Absence Rate", ("sess_authorised", "sess_unauthorised")),
    )
)
ORACLES["la_compare_rates"] = f"""
WITH {_PAIR} SELECT metric, ROUND(value_1, 6) AS value_1, ROUND(value_2, 6) AS value_2,
  ROUND(ABS(value_1 - value_2), 6) AS difference,
  CASE WHEN value_1 - value_2 > 0 THEN 'higher' ELSE 'lower' END AS direction
FROM ({_rates}) AS r"""

# --- patterns by school type and region ----------------------------------------------------

ORACLES["absence_pattern_cells"] = f"""
WITH {_CELLS} SELECT *, ROUND(100.0::DOUBLE * total_sessions
  / NULLIF(total_possible_sessions, 0), 6) AS avg_absence_rate FROM cells"""
ORACLES["absence_pattern_ranked"] = f"""
WITH {_CELLS} SELECT school_type, region_name, {_SUMS} FROM cells
GROUP BY school_type, region_name"""
_TOP = "100.0::DOUBLE * SUM(total_sessions) / SUM(total_possible_sessions) DESC NULLS LAST"
ORACLES["absence_top_combinations"] = f"""
WITH {_CELLS} SELECT school_type, region_name, {_SUMS} FROM cells
GROUP BY school_type, region_name ORDER BY {_TOP}, school_type, region_name LIMIT 3"""
ORACLES["absence_by_school_type"] = f"""
WITH {_CELLS} SELECT school_type, {_SUMS} FROM cells
GROUP BY school_type ORDER BY {_TOP}, school_type LIMIT 3"""
ORACLES["absence_by_region"] = f"""
WITH {_CELLS} SELECT region_name, {_SUMS} FROM cells
GROUP BY region_name ORDER BY {_TOP}, region_name LIMIT 3"""
ORACLES["absence_conclusion"] = f"""
WITH {_CELLS},
by_type AS (
  SELECT school_type, {_SUMS} FROM cells GROUP BY school_type
  ORDER BY {_TOP}, school_type LIMIT 1),
by_both AS (
  SELECT school_type, region_name, {_SUMS} FROM cells GROUP BY school_type, region_name
  ORDER BY {_TOP}, school_type, region_name LIMIT 1),
by_region AS (
  SELECT region_name, {_SUMS} FROM cells GROUP BY region_name
  ORDER BY {_TOP}, region_name LIMIT 1)
SELECT by_type.school_type AS top_school_type,
  by_type.avg_absence_rate AS top_school_type_rate,
  by_both.region_name AS top_combination_region,
  by_both.avg_absence_rate AS top_combination_rate,
  by_region.region_name AS top_region,
  by_region.avg_absence_rate AS top_region_rate
FROM by_type CROSS JOIN by_both CROSS JOIN by_region"""
_heat = ", ".join(
    f"ROUND(COALESCE(100.0::DOUBLE * SUM(total_sessions) FILTER (WHERE region_name = '{r}')"
    f" / NULLIF(SUM(total_possible_sessions) FILTER (WHERE region_name = '{r}'), 0), 0), 6)"
    f" AS {r.lower().replace(' ', '_')}"
    for r in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
)
ORACLES["absence_heatmap"] = f"""
WITH {_CELLS} SELECT school_type, {_heat} FROM cells GROUP BY school_type"""
ORACLES["absence_trend_by_type"] = f"""
WITH {_CELLS} SELECT school_type, time_period, {_SUMS} FROM cells
GROUP BY school_type, time_period"""

# --- regional attendance -------------------------------------------------------------------

ORACLES["regional_attendance"] = f"""
WITH {_RATES} SELECT region_name, time_period, ROUND(avg_attendance, 6) AS avg_attendance,
  ROUND(avg_absence, 6) AS avg_absence FROM rates"""
ORACLES["regional_trend_series"] = f"""
WITH {_RATES} SELECT region_name, time_period,
  CAST(time_period // 100 AS VARCHAR) || '/'
    || LPAD(CAST((time_period // 100 + 1) % 100 AS VARCHAR), 2, '0') AS academic_year,
  ROUND(avg_attendance, 6) AS avg_attendance FROM rates"""
ORACLES["regional_absence_spread"] = f"""
WITH {_RATES} SELECT region_name, ROUND(AVG(avg_absence), 6) AS mean_absence,
  ROUND(COALESCE(STDDEV_SAMP(avg_absence), 0), 6) AS std_absence FROM rates
GROUP BY region_name"""
ORACLES["regional_improvement"] = f"""
WITH {_PERFORMANCE} SELECT region_name, ROUND(change, 6) AS change FROM performance"""
ORACLES["regional_performance"] = f"""
WITH {_PERFORMANCE} SELECT region_name, ROUND(change, 6) AS change,
  ROUND(average, 6) AS average,
  CASE WHEN change > 0 THEN 'Improved' WHEN change < 0 THEN 'Worsened'
       WHEN change = 0 THEN 'No Change' END AS status FROM performance"""
ORACLES["regional_extremes"] = f"WITH {_PERFORMANCE} " + " UNION ALL ".join(
    f"""SELECT * FROM (SELECT '{name}' AS measure, region_name, ROUND({metric}, 6) AS value
  FROM performance ORDER BY {metric} {direction}, region_name LIMIT 1) AS {name}"""
    for name, metric, direction in (
        ("best_change", "change", "DESC"),
        ("worst_change", "change", "ASC"),
        ("best_average", "average", "DESC"),
        ("worst_average", "average", "ASC"),
    )
)

# --- sorting and limits --------------------------------------------------------------------

ORACLES["sort_asc"] = f"SELECT {_ORDERS} FROM orders ORDER BY o_orderpriority, o_orderkey"
ORACLES["sort_desc"] = f"""
SELECT {_LINES} FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber"""
ORACLES["limit_n"] = f"SELECT {_ORDERS} FROM orders ORDER BY o_orderkey LIMIT 10"
