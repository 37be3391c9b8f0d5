from __future__ import annotations

import duckdb
import pytest
from pyspark.errors import AnalysisException

from rollcall import sources
from rollcall.catalog import ORACLES, QUERIES
from rollcall.catalog.queries import TABLES
from rollcall.operators import absence, comparison, patterns, regional
from rollcall.operators.predicates import level_total
from rollcall.plans import load_attendance_mart
from tests.oracle import differences


def test_default_csv_reader_infers_types(spark, tmp_path):
    file = tmp_path / "raw.csv"
    file.write_text('code,big,rate,marked,name\n201819,3000000000,1.5,:,"a, b"\n201718,1,2,7,\n')
    df = sources.read_csv(spark, str(file))
    assert df.dtypes == [
        ("code", "int"),
        ("big", "bigint"),
        ("rate", "double"),
        ("marked", "string"),
        ("name", "string"),
    ]
    assert {tuple(r) for r in df.collect()} == {
        (201819, 3000000000, 1.5, ":", "a, b"),
        (201718, 1, 2.0, "7", None),
    }


def test_default_csv_reader_leaves_doubled_quotes(spark, tmp_path):
    file = tmp_path / "raw.csv"
    file.write_text('name\n"say ""hi"""\n')
    assert sources.read_csv(spark, str(file)).collect()[0]["name"] != 'say "hi"'


def test_declared_schema_is_kept(spark, tmp_path):
    file = tmp_path / "raw.csv"
    file.write_text("code\n201819\n")
    frame = spark.createDataFrame([], "code bigint")
    assert sources.read_csv(spark, str(file), frame.schema).dtypes == [("code", "bigint")]


def test_saved_csv_round_trip(spark, tmp_path):
    rows = [
        (1, 'say "hi"', "x"),
        (2, "two\nlines", "y,z"),
        (3, None, ":"),
        (4, "", "\\ backslash"),
        (5, "  blanks  ", "end"),
        (6, "\ttab", "carriage\rreturn\r\n"),
        (7, '"', "null"),
    ]
    path = str(tmp_path / "saved")
    sources.save(spark.createDataFrame(rows, "id int, text string, other string"), path)
    got = {tuple(r) for r in sources.read_saved_csv(spark, path).collect()}
    assert got == set(rows)


@pytest.mark.parametrize("file_format", ["parquet", "json"])
def test_other_formats_round_trip(spark, tmp_path, file_format):
    df = spark.createDataFrame([(1, ""), (2, None), (3, 'a "b"\n')], "id int, text string")
    path = str(tmp_path / file_format)
    sources.save(df, path, file_format)
    back = spark.read.schema(df.schema).format(file_format).load(path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_save_modes(spark, tmp_path):
    df, path = spark.range(3), str(tmp_path / "modes")
    sources.save(df, path, "parquet")
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        sources.save(df, path, "parquet")
    sources.save(df, path, "parquet", "append")
    assert spark.read.parquet(path).count() == 6
    sources.save(df, path, "parquet", "overwrite")
    assert spark.read.parquet(path).count() == 3


def test_save_creates_missing_parents_and_rejects_unknown_choices(spark, tmp_path):
    path = tmp_path / "new" / "folder" / "table"
    sources.save(spark.range(1), str(path), "json")
    assert path.exists()
    with pytest.raises(ValueError):
        sources.save(spark.range(1), str(tmp_path / "x"), "orc")
    with pytest.raises(ValueError):
        sources.save(spark.range(1), str(tmp_path / "x"), "csv", "ignore")


def test_partitioned_save_skips_other_directories(spark, tmp_path):
    df = spark.createDataFrame([("Regional", 1), ("School", 2)], "geographic_level string, n int")
    path = str(tmp_path / "by_level")
    sources.save(df, path, "parquet", partition_by=["geographic_level"])
    chosen = spark.read.parquet(path).filter("geographic_level = 'Regional'")
    assert [tuple(r) for r in chosen.select("n").collect()] == [(1,)]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(geographic_level" in plan


def test_rows_per_file_bounds_the_part_files(spark, tmp_path):
    path = str(tmp_path / "bounded")
    sources.save(spark.range(10).coalesce(1), path, "csv", rows_per_file=4)
    files = sources.list_files(spark, path).collect()
    assert len(files) == 3 and all(f["size_kb"] > 0 and f["modified"] for f in files)
    counts = sources.rows_per_file(sources.read_saved_csv(spark, path)).collect()
    assert sorted(c["row_count"] for c in counts) == [2, 4, 4]
    assert {c["file_name"] for c in counts} == {f["file_name"] for f in files}


def test_files_of_equal_name_in_different_directories_are_apart(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id % 2 AS side").coalesce(1)
    path = str(tmp_path / "sides")
    sources.save(df, path, "parquet", partition_by=["side"])
    counts = sources.rows_per_file(spark.read.parquet(path)).collect()
    assert sorted(c["row_count"] for c in counts) == [5, 5]
    assert len({c["directory"] for c in counts}) == 2 and len({c["file_name"] for c in counts}) == 1


def test_file_inventory_of_the_tables(spark):
    rows = QUERIES["source_file_inventory"](spark, "/root/testdata/sf0.001").collect()
    counts = {r["table_name"]: r["row_count"] for r in rows}
    assert len(counts) == 14 and counts["lineitem"] == 6000 and counts["region"] == 5
    assert all(r["file_count"] == 1 and r["sized"] and r["timed"] for r in rows)


def test_file_inventory_counts_a_directory_once_and_tables_without_rows(spark, tmp_path):
    duck = duckdb.connect()
    for name in TABLES:
        table = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        rows = table.limit(0) if name == "labels" else table.limit(50).repartition(3)
        rows.write.parquet(path := str(tmp_path / f"{name}.parquet"))
        duck.execute(f"CREATE VIEW {name} AS FROM read_parquet('{path}/*.parquet')")
    df = QUERIES["source_file_inventory"](spark, str(tmp_path))
    assert differences(duck, ORACLES["source_file_inventory"], df) == []


def test_analysis_of_a_table_saved_as_csv_equals_that_of_the_table(spark, tmp_path):
    levels = ("National", "Regional", "Local authority")
    mart = load_attendance_mart(spark, "/root/testdata/sf0.001", levels)
    path = str(tmp_path / "mart")
    sources.save(mart, path)
    read = sources.read_saved_csv(spark, path)
    assert read.count() == mart.count()
    for operator in (
        regional.regional_attendance,
        patterns.absence_pattern_cells,
        lambda df: absence.unauthorised_by_area(level_total(df, "Regional"), "region_name", 199697),
        lambda df: comparison.compare_rates(
            level_total(df, "Local authority"), "NATION_0", "NATION_1", 199697
        ),
    ):
        expected = list(map(tuple, operator(mart).collect()))
        assert expected and list(map(tuple, operator(read).collect())) == expected


def test_scratch_paths_lie_in_the_shared_folder_and_differ(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = (sources.scratch_path(spark, "x") for _ in range(2))
    assert first != second and first.startswith(shared) and second.startswith(shared)


def test_stored_table_is_read_back_from_the_shared_folder(spark):
    df = spark.range(5).selectExpr("id", "if(id = 2, NULL, 'x') AS text")
    stored = sources.store(df, "stored")
    assert stored.dtypes == df.dtypes
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, df.collect()))
    shared = spark.conf.get("spark.checkpoint.dir")
    assert all(shared in file for file in stored.inputFiles())


def test_directories_sum_their_files(spark, tmp_path):
    for name, count in (("first", 3), ("second", 1)):
        sources.save(spark.range(6).repartition(count), str(tmp_path / name), "parquet")
    files = sources.list_files(spark, str(tmp_path)).collect()
    found = {r["directory"]: r for r in sources.list_directories(spark, str(tmp_path)).collect()}
    assert {name: r["file_count"] for name, r in found.items()} == {"first": 3, "second": 1}
    for name, r in found.items():
        sizes = [f["size_kb"] for f in files if f["directory"] == name]
        assert r["size_kb"] == pytest.approx(sum(sizes)) and r["modified"] is not None


class _Session:
    """Stands for a session whose settings are the given ones."""

    def __init__(self, **settings):
        self.settings = {key.replace("_", "."): value for key, value in settings.items()}
        self.conf = self

    def get(self, key, default):
        return self.settings.get(key, default)


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sources.scratch_path(_Session(spark_master="yarn"), "x")
    shared = _Session(spark_master="yarn", spark_checkpoint_dir="hdfs://shared/")
    assert sources.scratch_path(shared, "x").startswith("hdfs://shared/x-")
    assert "rollcall-" in sources.scratch_path(_Session(spark_master="local[2]"), "x")


TEXTS = [
    (7, "007", "1.50", "2020-01-01", 5_000_000_000, None),
    (8, "010", "-0", "2020-01-01 00:00:00", 1, 1.5),
    (9, "", None, "true", None, None),
]
TEXT_SCHEMA = "id int, code string, amount string, day string, big bigint, rate double"


@pytest.mark.parametrize("file_format", ["csv", "json"])
def test_digits_amounts_and_dates_stay_texts(spark, tmp_path, file_format):
    df = spark.createDataFrame(TEXTS, TEXT_SCHEMA)
    path = str(tmp_path / "texts")
    sources.save(df, path, file_format)
    read = {"csv": sources.read_saved_csv, "json": sources.read_saved_json}[file_format]
    back = read(spark, path)
    assert back.dtypes == df.dtypes
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))
    sources.save(df, path, file_format, "append")
    assert read(spark, path).count() == 6
    with pytest.raises(ValueError, match="was saved with"):
        sources.save(df.withColumn("id", df["id"].cast("bigint")), path, file_format, "append")
    assert read(spark, path).count() == 6
    sources.save(spark.range(2), path, file_format, "overwrite")
    assert read(spark, path).dtypes == [("id", "bigint")]


def test_types_are_inferred_only_without_a_stored_schema(spark, tmp_path):
    df = spark.createDataFrame([("007", "x")], "code string, name string")
    path = str(tmp_path / "inferred")
    sources.save(df, path)
    assert sources.read_saved_csv(spark, path, infer=True).dtypes[0] == ("code", "int")
    assert sources.read_saved_csv(spark, path).first()["code"] == "007"
    foreign = str(tmp_path / "foreign")
    df.write.option("header", True).csv(foreign)
    assert sources.stored_schema(spark, foreign) is None
    assert sources.read_saved_csv(spark, foreign).dtypes[0] == ("code", "int")


def test_the_schema_is_no_data_and_no_listed_file(spark, tmp_path):
    path = str(tmp_path / "listed")
    sources.save(spark.range(4).coalesce(1), path)
    assert sources.list_files(spark, path).count() == 1
    assert sources.read_saved_csv(spark, path).count() == 4


def test_partitioned_csv_keeps_its_types(spark, tmp_path):
    df = spark.createDataFrame([("01", "007", 1), ("02", "1.0", 2)], "level string, t string, n int")
    path = str(tmp_path / "levels")
    sources.save(df, path, partition_by=["level"])
    back = sources.read_saved_csv(spark, path).select(df.columns)
    assert back.dtypes == df.dtypes
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_partitioned_saving_writes_few_files_of_even_size(spark, tmp_path):
    """Twenty levels, one with half of the rows, from thirty tasks: without rebalancing, up to
    600 files.
    """
    level = "if(id % 2 = 0, 0, id % 20)"
    df = spark.range(0, 300_000, 1, 30).selectExpr(f"{level} AS level", "id", "uuid() AS text")
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        sources.save(df, str(tmp_path / "even"), "parquet", partition_by=["level"])
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    df.write.partitionBy("level").parquet(str(tmp_path / "plain"))
    even, plain = (
        {r["directory"]: r["file_count"] for r in
         sources.list_directories(spark, str(tmp_path / name)).collect()}
        for name in ("even", "plain")
    )
    assert sum(plain.values()) == 330 and sum(even.values()) <= 60
    hot = even.pop("level=0")
    assert hot >= 4 and max(even.values()) <= 3  # the hot level is split, the others are not
    back = spark.read.parquet(str(tmp_path / "even"))
    assert back.count() == 300_000 and back.select("id").distinct().count() == 300_000


def test_bucketed_table_has_one_sorted_file_a_bucket(spark, tmp_path):
    df = spark.range(1000).selectExpr("id % 100 AS k", "id", "if(id % 9 = 0, NULL, 'x') AS `a.b`")
    path = str(tmp_path / "bucketed")
    saved = sources.save_bucketed(df, "saved_in_buckets", path, ["k"], 4)
    assert len(saved.inputFiles()) == 4
    assert sorted(map(repr, saved.collect())) == sorted(map(repr, df.collect()))
    plan = saved.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    with pytest.raises(AnalysisException):
        sources.save_bucketed(df, "saved_in_buckets", path, ["k"], 4)
    spark.sql("DROP TABLE saved_in_buckets")
