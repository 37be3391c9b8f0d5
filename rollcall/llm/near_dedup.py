"""Near duplicates: SuperMinHash signatures, banding, exact verification, union-find.

Texts with the same set of shingles are one class from the start, whatever their number, and one
member stands for them. Representatives that agree in a band meet in a bucket. First, each is
compared with the smallest member of its buckets, on full sets, and links are united. That
settles a bucket unless its other members still belong to different components. Such a bucket's
members are packed into blocks of bounded size, with signatures and full sets, and pairs of blocks
meet. Inside a task, the members outside the bucket's largest component are held against all:
signatures rule out pairs far from the threshold, pairs united meanwhile or met in an earlier band
are passed over, and full sets decide. Only links leave the task, never the pairs of a group, and
every join before sees a member once per bucket.

With 32 bands of 4 slots, two texts of similarity 0.75 miss each other in all bands with a
probability of 0.684^32 = 5e-6, and less above. A pair that meets is ruled out by its signatures
below 0.55, five standard deviations from 0.75.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.common import blocks, in_few_files, session_of, text_buffers
from rollcall.llm.components import components
from rollcall.llm.shingles import band_hashes, set_keys, shingle_sets, super_minhash
from rollcall.sources import store

SLOTS, WIDTH = 128, 4
PERCENT = 75
#: Least share of equal slots with which a pair of a crowded bucket is compared on full sets.
LEAST_EQUAL = 0.55
#: Members of a bucket in a block, and shingles of their sets together, on average.
BLOCK_ROWS, BLOCK_SHINGLES = 1024, 1 << 19
BLOCK = 1 << 19


@contextmanager
def _rows_per_batch(spark: SparkSession, rows: int):
    """Arrow batches of so many rows at most while a table of long texts is computed."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _store_small(df: DataFrame, label: str) -> DataFrame:
    """Ids and hashes; texts, sets and what is computed in Python keep their partitions."""
    return store(in_few_files(df), label)


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, pa.int64())


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, starts = text_buffers(batch.column(1))
        for first, last in blocks(starts, BLOCK):
            part = slice(starts[first], starts[last])
            hashes, at = shingle_sets(data[part], starts[first : last + 1] - starts[first])
            key_1, key_2 = set_keys(hashes, at)
            bands = band_hashes(super_minhash(hashes, at, SLOTS), WIDTH)
            ends = np.arange(0, bands.size + 1, bands.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, last - first),
                    _long(np.diff(at)),
                    _long(key_1),
                    _long(key_2),
                    pa.ListArray.from_arrays(pa.array(ends), _long(bands.reshape(-1))),
                ],
                ["doc_id", "n_shingles", "key_1", "key_2", "bands"],
            )


def _overlap(one: np.ndarray, other: np.ndarray) -> int:
    """Members that two ascending sets share."""
    if len(one) > len(other):
        one, other = other, one
    if not len(one):
        return 0
    near = np.searchsorted(other, one)
    near[near == len(other)] = 0
    return int((other[near] == one).sum())


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of intersection and union for rows (hub, id, hub_text, text)."""
    for batch in batches:
        hubs = batch.column(0).to_numpy()
        shared, total = np.zeros(len(hubs), np.int64), np.zeros(len(hubs), np.int64)
        data, starts = text_buffers(batch.column(3))
        of_hub, at_hub = text_buffers(batch.column(2))
        hub, base = None, np.zeros(0, np.uint64)
        for first, last in blocks(starts, BLOCK):
            part = slice(starts[first], starts[last])
            hashes, at = shingle_sets(data[part], starts[first : last + 1] - starts[first])
            for row in range(first, last):
                if hubs[row] != hub:  # rows of one hub follow each other after the join
                    hub, own = hubs[row], slice(at_hub[row], at_hub[row + 1])
                    base, _ = shingle_sets(of_hub[own], np.array([0, own.stop - own.start]))
                other = hashes[at[row - first] : at[row - first + 1]]
                shared[row] = _overlap(base, other)
                total[row] = len(base) + len(other) - shared[row]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(shared), pa.array(total)],
            ["hub", "id", "shared", "total"],
        )


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """``pairs`` (hub, id) with the sizes of intersection and union of their full sets."""
    joined = (
        pairs.join(texts.select(F.col("doc_id").alias("id"), "text"), "id")
        .join(texts.select(F.col("doc_id").alias("hub"), F.col("text").alias("hub_text")), "hub")
        .select("hub", "id", "hub_text", "text")
    )
    compared = joined.mapInArrow(_compare, "hub long, id long, shared long, total long")
    with _rows_per_batch(pairs.sparkSession, 500):
        return store(compared, "near_compared")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text) with signature, bands and the whole set as bytes."""
    for batch in batches:
        data, starts = text_buffers(batch.column(1))
        for first, last in blocks(starts, BLOCK):
            part = slice(starts[first], starts[last])
            hashes, at = shingle_sets(data[part], starts[first : last + 1] - starts[first])
            signature = super_minhash(hashes, at, SLOTS)
            bands = band_hashes(signature, WIDTH)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, last - first),
                    pa.array([low.tobytes() for low in signature.astype(np.uint8)], pa.binary()),
                    pa.array([own.tobytes() for own in bands], pa.binary()),
                    pa.array(
                        [hashes[i:j].tobytes() for i, j in zip(at[:-1], at[1:], strict=True)],
                        pa.binary(),
                    ),
                ],
                ["id", "low_bytes", "band_bytes", "members"],
            )


class _Block:
    """Some members of a bucket, with the component that each is known to be in."""

    def __init__(self, rows: pa.StructArray):
        self.ids = rows.field("id").to_numpy()
        self.groups = rows.field("group").to_numpy().copy()
        self.queries = rows.field("query").to_numpy(zero_copy_only=False)
        self.low = np.frombuffer(b"".join(rows.field("low_bytes").to_pylist()), np.uint8)
        self.low = self.low.reshape(-1, SLOTS)
        self.bands = np.frombuffer(b"".join(rows.field("band_bytes").to_pylist()), np.int64)
        self.bands = self.bands.reshape(len(self.ids), -1)
        self.sets = [np.frombuffer(own, np.uint64) for own in rows.field("members").to_pylist()]
        self.sizes = np.array([len(own) for own in self.sets])


def _links_across(bucket: int, one: _Block, other: _Block) -> list[tuple[int, int]]:
    """Links between queries of ``one`` and members of ``other`` in different components.

    Signatures rule out pairs far from the threshold, sizes those that cannot reach it; pairs that
    also meet in an earlier band are left to that bucket. The likeliest are compared first on full
    sets, and components that turn out to be one are passed over from then on, in both blocks.
    """
    found = []
    for k in np.flatnonzero(one.queries):
        low, sizes = np.minimum(one.sizes[k], other.sizes), np.maximum(one.sizes[k], other.sizes)
        near = np.flatnonzero((other.groups != one.groups[k]) & (100 * low >= PERCENT * sizes))
        equal = (other.low[near] == one.low[k]).sum(axis=1)
        near, equal = near[equal >= LEAST_EQUAL * SLOTS], equal[equal >= LEAST_EQUAL * SLOTS]
        band = int(np.argmax(one.bands[k] == bucket))
        fresh = ~(other.bands[near, :band] == one.bands[k, :band]).any(axis=1)
        for m in near[fresh][np.argsort(-equal[fresh], kind="stable")]:
            if (old := other.groups[m]) == (now := one.groups[k]):
                continue
            shared = _overlap(one.sets[k], other.sets[m])
            if 100 * shared >= PERCENT * (one.sizes[k] + other.sizes[m] - shared):
                found.append((int(one.ids[k]), int(other.ids[m])))
                for block in (one, other):
                    block.groups[block.groups == old] = now
    return found


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links across components for rows (bucket, members of a block, of another one or NULL)."""
    for batch in batches:
        found = []
        for row in range(len(batch)):
            bucket = batch.column(0)[row].as_py()
            one = _Block(batch.column(1)[row].values)
            if not batch.column(2)[row].is_valid:
                found += _links_across(bucket, one, one)
                continue
            other = _Block(batch.column(2)[row].values)
            found += _links_across(bucket, one, other)
            found += _links_across(bucket, other, one)
        a, b = zip(*found, strict=True) if found else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
        )


def _open_links(crowded: DataFrame, joined: DataFrame, texts: DataFrame) -> DataFrame:
    """Links between members of different components (``joined``) of a bucket, of which the
    bucket's hub is not one: those are known.

    Each member of an open bucket is joined with its set once; the bucket's members are packed
    into blocks of bounded rows and bytes, and only pairs of whole blocks meet.
    """
    rest = (
        crowded.filter("id <> hub")
        .join(joined.withColumnRenamed("node", "id"), "id", "left")
        .select("bucket", "id", F.coalesce("component", "id").alias("group"), "n_shingles")
    )
    shape = (
        rest.groupBy("bucket", "group")
        .agg(F.count("*").alias("rows"), F.sum("n_shingles").alias("shingles"))
        .groupBy("bucket")
        .agg(
            F.count("*").alias("groups"),
            F.max_by("group", F.struct("rows", "group")).alias("largest"),
            F.sum("rows").alias("rows"),
            F.sum("shingles").alias("shingles"),
        )
        .filter("groups > 1")
        .select(
            "bucket",
            "largest",
            F.ceil(
                F.greatest(F.col("rows") / BLOCK_ROWS, F.col("shingles") / BLOCK_SHINGLES)
            ).cast("int").alias("n_blocks"),
        )
    )
    open_ = _store_small(rest.join(_store_small(shape, "near_shapes"), "bucket"), "near_open")
    used = open_.select(F.col("id").alias("doc_id")).distinct()
    sets = (
        texts.join(used.hint("merge"), "doc_id", "left_semi")
        .select(F.col("doc_id").alias("id"), "text")
        .mapInArrow(_sets, "id long, low_bytes binary, band_bytes binary, members binary")
    )
    with _rows_per_batch(crowded.sparkSession, 500):
        sets = store(sets, "near_sets")
    row = F.struct(
        "id", "group", (F.col("group") != F.col("largest")).alias("query"), "low_bytes",
        "band_bytes", "members",
    )

    def packed(rows: DataFrame) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int")
        return (
            rows.join(sets, "id").withColumn("block", block)
            .groupBy("bucket", "block").agg(F.collect_list(row).alias("rows"))
        )

    # Most buckets are one block, which is compared with itself; only the others are joined.
    alone = packed(open_.filter("n_blocks = 1")).select(
        "bucket", "rows", F.lit(None).cast(packed(open_).schema["rows"].dataType).alias("others")
    )
    several = store(packed(open_.filter("n_blocks > 1")), "near_blocks")
    others = several.select("bucket", F.col("block").alias("other"), F.col("rows").alias("others"))
    pairs = several.join(others, "bucket").filter("block <= other").select(
        "bucket", "rows", F.when(F.col("block") < F.col("other"), F.col("others")).alias("others")
    )
    with _rows_per_batch(crowded.sparkSession, 1):
        links = alone.unionByName(pairs).mapInArrow(_resolve, "a long, b long")
        return store(links, "near_open_links")


def _linked() -> Column:
    return F.col("shared") * 100 >= F.col("total") * PERCENT


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    A text is the set of its distinct shingles of five words ``[^\\x20\\x09-\\x0D]+``, A-Z
    lower-cased; of fewer words, the whole sequence is its only shingle; NULL and texts without
    words have none and are linked with nothing. Texts are linked if 100 times the shingles they
    share is at least 75 times those of either. ``component_id`` is the smallest ``doc_id``
    reachable over links, the own included, and ``kept`` marks it. Rows of equal ``doc_id`` are
    one document, linked if any of its rows is. Rows with a NULL ``doc_id`` take no part: their
    ``component_id`` is NULL, and they are kept. No rows give no rows. Other columns are not read.
    """
    session_of(docs)
    rows = docs.select("doc_id", "text")
    sketches = store(
        rows.mapInArrow(
            _sketch,
            "doc_id long, n_shingles long, key_1 long, key_2 long, bands array<long>",
        ),
        "near_sketches",
    )
    key = ["n_shingles", "key_1", "key_2"]
    some = sketches.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    # Stored, so that the join has an exchange of its own, which Spark can split at a hot class.
    classes = _store_small(some.groupBy(*key).agg(F.min("doc_id").alias("id")), "near_classes")
    first = F.col("doc_id") == F.col("id")
    members = _store_small(
        some.join(classes, key).select(
            "doc_id", "id", "n_shingles", F.when(first, F.col("bands")).alias("bands"),
        ),
        "near_members",
    )
    banded = members.filter("bands IS NOT NULL").select(
        "id", "n_shingles", F.explode("bands").alias("bucket")
    )
    hubs = banded.groupBy("bucket").agg(F.min("id").alias("hub"), F.max("id").alias("last"))
    hubs = _store_small(hubs.filter("hub <> last").drop("last"), "near_hubs")
    crowded = _store_small(banded.join(hubs, "bucket").distinct(), "near_buckets")
    pairs = _store_small(crowded.filter("id <> hub").select("hub", "id").distinct(), "near_pairs")
    used = pairs.select(F.explode(F.array("hub", "id")).alias("doc_id")).distinct()
    # Merged at any size: the ids of candidates grow with the documents.
    texts = store(rows.join(used.hint("merge"), "doc_id", "left_semi"), "near_texts")
    links = (
        _verified(pairs, texts)
        .filter(_linked())
        .select(F.col("hub").alias("a"), F.col("id").alias("b"))
    )
    joined = _store_small(components(links), "near_joined")
    more = _open_links(crowded, joined, texts)
    final = components(links.unionByName(more))
    ids = members.select("doc_id", "id").distinct()
    placed = _store_small(
        ids.join(final.withColumnRenamed("node", "id"), "id", "left").select(
            F.col("doc_id").alias("member"), F.coalesce("component", "id").alias("component")
        ).groupBy("member").agg(F.min("component").alias("component")),
        "near_placed",
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        sketches.select("doc_id", "n_shingles")
        .join(placed, F.col("doc_id") == F.col("member"), "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that ``near_duplicates`` keeps: one document of each
    component, and every row with a NULL ``doc_id``.
    """
    dropped = near_duplicates(docs).filter("NOT kept").select(F.col("doc_id").alias("dropped"))
    return docs.join(dropped, docs["doc_id"] == dropped["dropped"], "left_anti")
