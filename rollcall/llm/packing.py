"""Documents cut into token pieces and packed into sequences of bounded length.

Texts are tokenized once, where they are read; what is stored and shuffled afterwards is one short
row per piece. The packing itself is planned on the histogram of lengths (see ``packing_plan``);
a piece finds its place from its rank among the pieces of its length. Ranks are counted within
hashed buckets of bounded size and shifted by the sizes of the buckets before, so a length that a
third of all pieces have is spread like any other.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import session_of
from rollcall.llm.packing_plan import locate, plan
from rollcall.llm.tokens import word_encoder
from rollcall.sources import store

CAPACITY = 2048
END = b"\0\0\0\0"
#: Pieces of one length that are ranked together, about.
BUCKET_ROWS = 20_000


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """Pieces of every row's token ids followed by id 0: ``doc_id``, ``piece`` (from 0), ``start``,
    ``length``, ``ids_crc32``, and with ``ids`` the ids themselves (``array<int>``).

    ``tokenizer`` is the path of a tokenizers file of a word-level BPE, the same on all executors.
    NULL counts as empty and gives one piece of length 1. Documents of more than ``capacity`` ids
    are cut every ``capacity``; the last piece may be shorter.
    """
    session_of(docs)

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        for batch in batches:
            rows = []
            texts = batch.column(1)
            for k, doc_id in enumerate(batch.column(0).to_pylist()):
                data = encoder.encode(texts[k].as_py() or "") + END
                for number, start in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[start : start + 4 * capacity]
                    row = (doc_id, number, start // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, memoryview(part).cast("i").tolist()) if ids else row)
            columns = zip(*rows, strict=True) if rows else [()] * len(types)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, types, strict=True)], names
            )

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])]
    long = pa.int64()
    types = [long, pa.int32(), long, long, long, *([pa.list_(pa.int32())] if ids else [])]
    kinds = ["long", "int", "long", "long", "long", *(["array<int>"] if ids else [])]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True))
    return docs.select("doc_id", "text").mapInArrow(tokenize, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` (the place of the piece's first token): within
    a sequence the pieces follow each other without gaps from 0 and hold at most ``capacity``
    tokens. ``pieces`` must be stored, have ``doc_id``, ``piece`` and a ``length`` of 1 to
    ``capacity``; repeated rows are packed each. No rows give no rows.
    """
    spark = session_of(pieces)
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    rows = spark.sparkContext.broadcast(plan(histogram, capacity))
    buckets = max(1, sum(histogram.values()) // BUCKET_ROWS)
    dealt = pieces.withColumn(
        "__bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int")
    )
    sizes = dealt.groupBy("length", "__bucket").agg(F.count("*").alias("__rows"))
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = sizes.select(
        F.col("length").alias("__length"),
        F.col("__bucket").alias("__at"),
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
    )
    own = Window.partitionBy("length", "__bucket").orderBy("doc_id", "piece")
    ranked = (
        dealt.withColumn("__rank", F.row_number().over(own) - 1)
        .join(sizes, (F.col("length") == F.col("__length")) & (F.col("__bucket") == F.col("__at")))
        .withColumn("__rank", F.col("__rank") + F.col("__before"))
    )

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = locate(rows.value, length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return ranked.withColumn("__place", place("length", "__rank")).select(
        *pieces.columns, "__place.sequence_id", "__place.offset"
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` and ``pack`` in one: all of ``docs`` in few sequences. Other columns are not read."""
    return pack(store(cut(docs, tokenizer, capacity), "packing_pieces"), capacity)
