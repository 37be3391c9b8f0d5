"""What the operators of this subpackage share: reading tables, and text as arrays in tasks."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Constants of the splitmix64 finalizer.
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)


def session_of(df: DataFrame) -> SparkSession:
    """The session of ``df``, whose Python workers can import this package from where the driver
    has it (on a cluster the package is installed at the same path, or shipped with ``addPyFile``).

    Arrow batches of the session are held to ``BATCH_ROWS`` rows, unless it asks for fewer: rows
    are whole texts, and a batch is held by the executor and by the worker at the same time.
    """
    spark = df.sparkSession
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(":")
    if root not in known:
        environment["PYTHONPATH"] = ":".join([*filter(None, known), root])
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with every column its files have."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_few_files(df: DataFrame) -> DataFrame:
    """The same rows in as many partitions as the executors' cores take up in four waves, or fewer:
    small results of many partitions are written to as many files otherwise, which costs more than
    the work. Partitions are joined without a shuffle and computed one after the other, so a task
    needs no more memory. Left alone where the number of executors is not fixed.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return df
    return df.coalesce(4 * spark.sparkContext.defaultParallelism)


#: Most rows of an Arrow batch.
BATCH_ROWS = 1000


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is; NULL counts as empty.

    Where a text is plain ASCII (as many bytes as characters), ``lower`` does the same faster.
    """
    filled = F.coalesce(text, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    plain = F.octet_length(filled) == F.char_length(filled)
    return F.when(plain, F.lower(filled)).otherwise(F.translate(filled, upper, upper.lower()))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection), without the input being changed."""
    with np.errstate(over="ignore"):
        z = values.astype(np.uint64, copy=False) + _GOLDEN
        z ^= z >> np.uint64(30)
        z *= _MIX_1
        z ^= z >> np.uint64(27)
        z *= _MIX_2
        z ^= z >> np.uint64(31)
    return z


def mix_upper(values: np.ndarray, spare: np.ndarray) -> None:
    """``mix`` in place, but for its last step, which leaves the upper 31 bits as they are."""
    values += _GOLDEN
    values ^= np.right_shift(values, np.uint64(30), out=spare)
    values *= _MIX_1
    values ^= np.right_shift(values, np.uint64(27), out=spare)
    values *= _MIX_2


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows in a row, and where each row starts (one entry more than rows);
    NULL counts as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, starts, data = column.buffers()
    starts = np.frombuffer(starts, kind)[column.offset : column.offset + len(column) + 1]
    starts = starts.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), starts - starts[0]
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def blocks(starts: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``size`` bytes together; a longer row is a run of its own."""
    first, rows = 0, len(starts) - 1
    while first < rows:
        last = int(np.searchsorted(starts, starts[first] + size, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def pieces(starts: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... anew within every run that ``starts`` delimits."""
    lengths = np.diff(starts)
    return np.arange(starts[-1] - starts[0]) - np.repeat(starts[:-1] - starts[0], lengths)
