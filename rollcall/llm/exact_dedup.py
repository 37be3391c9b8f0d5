"""Exact duplicates by two passes over a Bloom filter.

Pass one fills two bit arrays of equal, bounded size: bits hit at least once, and bits hit at
least twice. A text that occurs twice hits each of its bits twice, so a row of which some bit
was hit once only is unique for certain and passes straight through. Pass two shuffles the other
rows alone, by the SHA-256 of the text, which decides; false alarms of the filter only cost a
shuffled row.

The filter is built by at most ``BUILDERS`` tasks and holds at most ``max_filter_bits`` bits
(32 MiB by default), whatever the number of rows; that is its bound on the driver and in a
broadcast. Beyond about 60 million rows more unique rows take part in the shuffle unless the
bound is raised; the result stays the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import lower_ascii, session_of
from rollcall.sources import store

BUILDERS = 64
HASHES = 3
MAX_FILTER_BITS = 1 << 28
_SEGMENT = 1 << 16  # bytes of a filter that travel together


def _positions(hashes: np.ndarray, n_bits: int) -> np.ndarray:
    """HASHES bit numbers per 64-bit hash, by double hashing; ``n_bits`` is a power of two."""
    values = hashes.astype(np.int64).view(np.uint64)
    low, high = values & np.uint64(0xFFFFFFFF), values >> np.uint64(32) | np.uint64(1)
    steps = np.arange(HASHES, dtype=np.uint64)
    return (low[:, None] + steps * high[:, None]) & np.uint64(n_bits - 1)


def _fill(n_bits: int):
    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        once, twice = np.zeros(n_bits // 8, np.uint8), np.zeros(n_bits // 8, np.uint8)
        for batch in batches:
            bits, hits = np.unique(_positions(batch["hash"].to_numpy(), n_bits), return_counts=True)
            at, mask = (bits >> np.uint64(3)).astype(np.int64), 1 << (bits & np.uint64(7))
            mask = mask.astype(np.uint8)
            np.bitwise_or.at(twice, at, np.where(hits > 1, mask, once[at] & mask))
            np.bitwise_or.at(once, at, mask)
        for segment, start in enumerate(range(0, len(once), _SEGMENT)):
            part = slice(start, start + _SEGMENT)
            if once[part].any():
                yield pd.DataFrame(
                    {
                        "segment": [segment],
                        "once": [once[part].tobytes()],
                        "twice": [twice[part].tobytes()],
                    }
                )

    return fill


def _merge(parts: pd.DataFrame) -> pd.DataFrame:
    once = twice = np.uint8(0)
    for row in parts.itertuples():
        more = np.frombuffer(row.once, np.uint8)
        twice = twice | np.frombuffer(row.twice, np.uint8) | (once & more)
        once = once | more
    return pd.DataFrame({"segment": parts["segment"].iloc[:1], "twice": [twice.tobytes()]})


def with_repeat_flag(
    rows: DataFrame, flag: str, hashed: Column, max_filter_bits: int = MAX_FILTER_BITS
) -> DataFrame:
    """``rows`` with a boolean column ``flag``: false where the 64-bit ``hashed`` is unique in
    ``rows`` for certain. No row moves. Reads ``rows`` twice: to store the hashes, from which the
    filter is counted and filled by few tasks, and to test.
    """
    spark = session_of(rows)
    hashes = store(rows.select(hashed.alias("hash")), "exact_hashes")
    wanted = 8 * max(hashes.count(), 1 << 12)
    n_bits = min(1 << (wanted - 1).bit_length(), max_filter_bits)
    filled = (
        hashes.coalesce(BUILDERS)
        .mapInPandas(_fill(n_bits), "segment int, once binary, twice binary")
        .groupBy("segment")
        .applyInPandas(_merge, "segment int, twice binary")
    )
    twice = np.zeros(n_bits // 8, np.uint8)
    for row in filled.toLocalIterator():
        part = np.frombuffer(bytes(row["twice"]), np.uint8)
        twice[row["segment"] * _SEGMENT :][: len(part)] = part
    shared = spark.sparkContext.broadcast(twice)

    @F.pandas_udf("boolean")
    def repeated(hashes: pd.Series) -> pd.Series:
        bits = _positions(hashes.to_numpy(), n_bits)
        hit = shared.value[(bits >> np.uint64(3)).astype(np.int64)] >> (bits & np.uint64(7))
        return pd.Series((hit & 1).all(axis=1))

    return rows.withColumn(flag, repeated(hashed))


def mark_duplicates(docs: DataFrame, max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id`` (of the equal text that stays, the
    largest ``doc_id``), ``group_size``, ``kept``, ``text_sha256`` of the normalised text.

    Texts are equal when identical after lower-casing A-Z only; NULL counts as empty, and an
    empty text is a text like others. A NULL ``doc_id`` is below every other. Rows that repeat
    both text and ``doc_id`` are counted each and marked alike. No rows give no rows. Other
    columns are not read.
    """
    digests = store(
        docs.select("doc_id", F.sha2(lower_ascii(F.col("text")), 256).alias("text_sha256")),
        "exact_digests",
    )
    flagged = with_repeat_flag(digests, "maybe", F.xxhash64("text_sha256"), max_filter_bits)
    flagged = store(flagged, "exact_flagged")
    maybe = flagged.filter("maybe").drop("maybe")
    # Stored, so that the join has an exchange of its own, which Spark can split at a hot text.
    groups = store(
        maybe.groupBy("text_sha256").agg(
            F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
        ),
        "exact_groups",
    )
    single = flagged.filter("NOT maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256",
    )
    return single.unionByName(
        maybe.join(groups, "text_sha256").select(
            "doc_id", "keep_id", "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
        )
    )


def drop_duplicates(docs: DataFrame, max_filter_bits: int = MAX_FILTER_BITS) -> DataFrame:
    """The rows of ``docs``, all columns, without the ones whose text a row of larger ``doc_id``
    has too. Of rows that repeat both text and ``doc_id`` exactly one stays. NULLs, empty texts
    and empty tables as in ``mark_duplicates``.
    """
    packed = docs.select(F.struct("*").alias("row"))
    normal = lower_ascii(F.col("row.text"))
    flagged = with_repeat_flag(packed, "maybe", F.xxhash64(normal), max_filter_bits)
    stays = (
        flagged.filter("maybe")
        .groupBy(F.sha2(normal, 256).alias("digest"))
        .agg(F.max_by("row", F.struct("row.doc_id", F.xxhash64(F.to_json("row")))).alias("row"))
    )
    return flagged.filter("NOT maybe").select("row.*").unionByName(stays.select("row.*"))
