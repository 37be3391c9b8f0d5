"""Reading and writing CSV, parquet and JSON."""

from __future__ import annotations

import atexit
import json
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rollcall.functions import column

# Formats and modes a table can be saved with.
FORMATS = ("csv", "parquet", "json")
MODES = ("errorifexists", "overwrite", "append")
# How saved CSV is written and read: quotes doubled, blanks kept, NULL as \\N, so
# that an empty text (written as two quotes) is another value.
_SAVED_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header and Spark's default quoting: one line per row, so files split.

    Without a ``schema`` the types are inferred, which reads the data one extra time.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_saved_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, infer: bool = False
) -> DataFrame:
    """A directory of CSV part files written by ``save``: quotes are doubled and values may
    span lines. Such files do not split; the parallelism is the number of part files, which
    ``save(..., rows_per_file=n)`` controls.

    The types are those the table was saved with, from the schema beside the files: every text
    comes back as it was, also one of digits (``007``, ``1.50``) or a date, empty ones and NULL
    included; only the text ``\\N`` itself reads as NULL. Types are inferred, by one more pass, only
    if there is no such schema (files that ``save`` did not write) or ``infer`` asks for it.
    """
    reader = spark.read.options(**_SAVED_CSV).option("multiLine", True)
    schema = schema or (None if infer else stored_schema(spark, path))
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def read_saved_json(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """JSON written by ``save``, with the types it was saved with, as in ``read_saved_csv``."""
    reader = spark.read
    schema = schema or stored_schema(spark, path)
    return (reader.schema(schema) if schema else reader).json(path)


# Fixed value: the folder of the schema; a name with an underscore is no data for Spark's readers.
_SCHEMA_FOLDER = "_schema"


def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema that ``save`` wrote beside the files of ``path``, if there is one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{_SCHEMA_FOLDER}/_SUCCESS")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    # One line, whatever the table.
    line = spark.read.text(str(place.getParent())).first()
    return StructType.fromJson(json.loads(line["value"]))


def _store_schema(df: DataFrame, path: str) -> None:
    text = df.schema.json()
    one = df.sparkSession.range(1, numPartitions=1).select(F.lit(text).alias("value"))
    one.write.mode("overwrite").text(f"{path.rstrip('/')}/{_SCHEMA_FOLDER}")


def _check_appended(df: DataFrame, path: str) -> None:
    known = stored_schema(df.sparkSession, path)
    pairs = lambda schema: [(f.name, f.dataType) for f in schema]
    if known is not None and pairs(known) != pairs(df.schema):
        raise ValueError(
            f"{path} was saved with {known.simpleString()}, not {df.schema.simpleString()}"
        )


def save(
    df: DataFrame,
    path: str,
    file_format: str = "csv",
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    rows_per_file: int | None = None,
) -> None:
    """Write one file per task (more with ``rows_per_file``); an existing path is an error
    unless ``mode`` says otherwise. CSV and JSON get the schema stored beside them, which appended
    rows must have too.

    Partition columns let later level and period filters skip whole directories. Rows are
    rebalanced by these columns first, so that a directory has few files of even size instead of
    one per task: adaptive execution joins small directories' rows into one task and splits a hot
    one among several.
    """
    if file_format not in FORMATS:
        raise ValueError(f"file_format must be one of {FORMATS}, got {file_format!r}")
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    typed = file_format != "parquet"
    if typed and mode == "append":
        _check_appended(df, path)
    if partition_by:
        df = df.hint("rebalance", *[column(name) for name in partition_by])
    writer = df.write.format(file_format).mode(mode)
    if file_format == "csv":
        writer = writer.options(**_SAVED_CSV)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.save(path)
    if typed:
        _store_schema(df, path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Directory, name, size in KB and modification time of every file under ``path``.

    The contents stay unread.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("directory"),
            F.regexp_extract("path", "([^/]+)$", 1).alias("file_name"),
            (F.col("length") / 1024).alias("size_kb"),
            F.col("modificationTime").alias("modified"),
        )
    )


def list_directories(spark: SparkSession, path: str) -> DataFrame:
    """Files, their size in KB together and the latest change, per directory under ``path``."""
    return (
        list_files(spark, path)
        .groupBy("directory")
        .agg(
            F.count("*").alias("file_count"),
            F.sum("size_kb").alias("size_kb"),
            F.max("modified").alias("modified"),
        )
    )


def rows_per_file(df: DataFrame) -> DataFrame:
    """Directory, name, rows, size in KB and modification time of the files behind a file-based
    ``df``. Files of equal name in different directories are different files.

    Only counts leave the map tasks, and no data column is read.
    """
    metadata = F.col("_metadata")
    return (
        df.groupBy(
            F.regexp_extract(metadata["file_path"], "^(.*)/[^/]+$", 1).alias("directory"),
            metadata["file_name"].alias("file_name"),
            (metadata["file_size"] / 1024).alias("size_kb"),
            metadata["file_modification_time"].alias("modified"),
        )
        .agg(F.count("*").alias("row_count"))
    )


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names. Only a local
    session without that setting may use a temporary folder of this machine. What is there when
    this Python process ends is removed.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="rollcall-")
    path = f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _remove_at_exit(spark, path)
    return path


_SCRATCH: list[str] = []


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    if not _SCRATCH:
        jvm, configuration = spark._jvm, spark._jsc.hadoopConfiguration()

        def remove() -> None:
            try:
                for made in _SCRATCH:
                    place = jvm.org.apache.hadoop.fs.Path(made)
                    place.getFileSystem(configuration).delete(place, True)
            except Exception:  # noqa: BLE001  the JVM is gone, and nobody is left to be told
                return

        atexit.register(remove)
    _SCRATCH.append(path)


def store(df: DataFrame, label: str) -> DataFrame:
    """Compute ``df`` once into a scratch table and continue from the table: later passes, and
    tasks rerun after a lost executor, read the files instead of repeating the plan.
    """
    path = scratch_path(df.sparkSession, label)
    save(df, path, "parquet")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_bucketed(
    df: DataFrame, name: str, path: str, by: Sequence[str], buckets: int, mode: str = "errorifexists"
) -> DataFrame:
    """Save as the catalog table ``name`` with its files under ``path``, dealt by a hash of ``by``
    into one sorted file per bucket. Two tables with as many buckets by their join keys are joined,
    and one is grouped by its key, without a shuffle.

    One task reads a bucket whole, so a value of ``by`` with a large part of all rows makes a long
    task: fold such rows first. Rows with a NULL in ``by`` share a bucket.
    """
    dealt = df.repartition(buckets, *[column(name_) for name_ in by])
    writer = dealt.write.format("parquet").mode(mode).option("path", path)
    writer.bucketBy(buckets, *by).sortBy(*by).saveAsTable(name)
    return df.sparkSession.table(name)


def attach_bucketed(
    spark: SparkSession, name: str, path: str, schema: StructType, by: Sequence[str], buckets: int
) -> DataFrame:
    """Make files that ``save_bucketed`` wrote known under ``name`` to a session whose catalog has
    no such table. ``by`` and ``buckets`` must be those of the files.
    """
    quoted = lambda names: ", ".join(f"`{n.replace('`', '``')}`" for n in names)
    fields = ", ".join(f"{quoted([f.name])} {f.dataType.simpleString()}" for f in schema)
    keys = quoted(by)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({fields}) USING parquet"
        f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {int(buckets)} BUCKETS"
        f" LOCATION '{location}'"
    )
    return spark.table(name)
