"""The trie of conversations that share their first turns, without writing the shared turns again.

A conversation may be rebuilt from the head of another and a suffix of its own. Every turn is an
affine map x -> ax + b modulo the prime 2^31 - 1, in four lanes, with a and b drawn from a digest of
role and text. Maps compose associatively and can be undone, so the fingerprint of a rebuilt prefix
is the product of the base's head, the inverse of the own head and the own prefix: three stored
products, whatever the length of the texts, which are never put together.

Products run along each conversation in sort order. Rows are dealt by ranges, so a conversation
may span tasks; each task multiplies its own stretch, and the stretches' totals (one or two per
task) are combined afterwards.

Rebuilt turns of equal depth and fingerprint are a node. That is verified, not trusted: all members
must refer to the same turn by the SHA-256 stored with it, and to the same parent node, and all
texts behind a SHA-256 must be equal. If fingerprints collide, they are drawn anew with another salt.

Sums over subtrees need no walk of the tree. A node belongs to its smallest member, so a
conversation owns the end of its path, from one depth on. A conversation adds to a node above what
it owns exactly the turns between the two, which its running count of code points gives; so each sum
is a grouped aggregation over members.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import mix, session_of
from rollcall.sources import store

#: Conversations of a hundred share their base; a head has fewer turns than HEADS.
HUNDRED, HEADS = 100, 6
PRIME = 2**31 - 1
LANES = 4
#: Characters of ids that one row of a chunk holds, about.
CHUNK = 1 << 16
_IDENTITY = 1 << 31  # a = 1, b = 0, packed as a * 2^31 + b

Product = list[Column]


def _turns(conversations: DataFrame) -> DataFrame:
    """Rows with NULL role and text as empty, the digest of both and the text's code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        text.alias("text"),
        F.unhex(F.sha2(F.concat_ws(":", F.char_length(role), role, text), 256)).alias("digest"),
        F.char_length(text).cast("long").alias("chars"),
    )


def _verify_texts(turns: DataFrame) -> None:
    """All turns of a digest have the same role and text."""
    ends = [f(c).alias(f"{n}_{c}") for c in ("role", "text") for n, f in
            (("low", F.min), ("high", F.max))]
    if turns.groupBy("digest").agg(*ends).filter(
        "low_role <> high_role OR low_text <> high_text"
    ).take(1):
        raise ValueError("two turns have the same SHA-256")


def _maps(digests: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """The lanes' a (not 0) and b of each digest, given as rows of four 64-bit values."""
    with np.errstate(over="ignore"):
        whole = mix(digests[:, 0] + mix(np.array([salt], np.uint64)))
        for k in range(1, 4):
            whole = mix(whole ^ digests[:, k])
        drawn = mix(whole[:, None] + np.arange(2 * LANES, dtype=np.uint64)[None] * mix(
            np.array([salt + 1], np.uint64)))
    return 1 + drawn[:, :LANES] % np.uint64(PRIME - 1), drawn[:, LANES:] % np.uint64(PRIME)


def _running(a: np.ndarray, b: np.ndarray, head: np.ndarray) -> None:
    """In place, the product of all maps since the last row that ``head`` marks, itself included,
    for every row; the number of rounds is the logarithm of the longest run.
    """
    since = np.arange(len(head)) - np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))
    prime, step = np.uint64(PRIME), 1
    while step <= since.max(initial=0):
        later = np.flatnonzero(since >= step)
        left_a, left_b = a[later - step], b[later - step]
        b[later] = (a[later] * left_b + b[later]) % prime
        a[later] = a[later] * left_a % prime
        step *= 2


def _pack(a: np.ndarray, b: np.ndarray) -> list[pa.Array]:
    packed = (a << np.uint64(31) | b).astype(np.int64)
    return [pa.array(packed[:, lane]) for lane in range(LANES)]


_LANES = [f"p{lane}" for lane in range(LANES)]
_BEFORE = [f"q{lane}" for lane in range(LANES)]
_STRETCH = (
    "part int, conv_id long, place long, digest binary, chars long, upto long, "
    + ", ".join(f"{name} long" for name in _LANES + _BEFORE)
)


def _stretches(salt: int):
    """Sorted rows (conv_id, digest, chars) of a task with their place, running product, the one
    before, and running code points within the task's stretch of the conversation.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last = None  # of the batch before: conversation, place, code points and product
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            conv = batch.column(0).to_numpy()
            chars = batch.column(2).to_numpy()
            digests = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64)
            a, b = _maps(digests.reshape(-1, 4), salt)
            head = np.concatenate([[True], conv[1:] != conv[:-1]])
            place = np.arange(n) - np.maximum.accumulate(np.where(head, np.arange(n), 0)) + 1
            upto = np.cumsum(chars)
            upto = upto - np.maximum.accumulate(np.where(head, upto - chars, 0))
            _running(a, b, head)
            if last and last[0] == conv[0]:
                own = place == np.arange(1, n + 1)
                place[own] += last[1]
                upto[own] += last[2]
                b[own] = (a[own] * last[4] + b[own]) % np.uint64(PRIME)
                a[own] = a[own] * last[3] % np.uint64(PRIME)
                first = last[3], last[4]
            else:
                first = np.ones(LANES, np.uint64), np.zeros(LANES, np.uint64)
            before_a, before_b = np.roll(a, 1, axis=0), np.roll(b, 1, axis=0)
            before_a[head], before_b[head] = 1, 0
            before_a[0], before_b[0] = first
            last = conv[-1], place[-1], upto[-1], a[-1].copy(), b[-1].copy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, part, np.int32)), batch.column(0), pa.array(place),
                    batch.column(1), batch.column(2), pa.array(upto),
                    *_pack(a, b), *_pack(before_a, before_b),
                ],
                ["part", "conv_id", "place", "digest", "chars", "upto", *_LANES, *_BEFORE],
            )

    return read


def _carries(stretches: pd.DataFrame) -> pd.DataFrame:
    """What came before each stretch (but the first) of one conversation, a row per task of it."""
    place, upto, a, b, made = 0, 0, [1] * LANES, [0] * LANES, []
    for row in stretches.sort_values("part").to_dict("records"):
        carry = {"place": place, "upto": upto}
        carry |= {n: a[k] << 31 | b[k] for k, n in enumerate(_LANES)}
        made.append((row["conv_id"], row["part"], carry))
        place, upto = place + row["place"], upto + row["upto"]
        for k, name in enumerate(_LANES):
            a2, b2 = row[name] >> 31, row[name] & PRIME
            a[k], b[k] = a[k] * a2 % PRIME, (a2 * b[k] + b2) % PRIME
    return pd.DataFrame(made[1:], columns=["conv_id", "part", "carry"])


def _split(value: Column) -> tuple[Column, Column]:
    return F.shiftright(value, 31), value.bitwiseAND(PRIME)


def _then(first: Column, second: Column) -> Column:
    """The packed product of two packed maps, applied in this order."""
    (a1, b1), (a2, b2) = _split(first), _split(second)
    return F.shiftleft((a1 * a2) % PRIME, 31) + (a2 * b1 + b2) % PRIME


def _product(*factors: list[Column]) -> Product:
    found = factors[0]
    for factor in factors[1:]:
        found = [_then(x, y) for x, y in zip(found, factor, strict=True)]
    return found


def _lanes(names: list[str]) -> Product:
    return [F.col(name) for name in names]


def _inverse(value: Column) -> Column:
    """The packed map that undoes a packed map: a^(p-2) by repeated squaring."""
    a, b = _split(value)
    inverse = F.aggregate(
        F.array(*(F.lit(PRIME - 2 >> k & 1) for k in range(31))),
        F.struct(F.lit(1).cast("long").alias("found"), a.alias("power")),
        lambda s, bit: F.struct(
            F.when(bit == 1, s["found"] * s["power"] % PRIME).otherwise(s["found"]).alias("found"),
            (s["power"] * s["power"] % PRIME).alias("power"),
        ),
        lambda s: s["found"],
    )
    return F.shiftleft(inverse, 31) + F.pmod(-(b * inverse) % PRIME, F.lit(PRIME))


def _placed(turns: DataFrame, salt: int) -> DataFrame:
    """``conv_id``, ``place`` (from 1), ``digest``, ``chars``, ``upto`` and the running products
    of every turn, over whole conversations.
    """
    # Rows that are equal in all of it are interchangeable; the last key spreads them.
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text", "spread"]
    dealt = (
        turns.withColumn("spread", F.rand(salt)).repartitionByRange(*order)
        .sortWithinPartitions(*order).select("conv_id", "digest", "chars")
    )
    rows = store(dealt.mapInArrow(_stretches(salt), _STRETCH), "trie_stretches")
    ends = rows.groupBy("conv_id", "part").agg(
        F.max(F.struct("place", "upto", *_LANES)).alias("end")
    )
    # A conversation in more than one part: at most two stretches of each part, so few rows.
    several = (
        ends.groupBy("conv_id").agg(F.count("*").alias("parts")).filter("parts > 1")
        .select("conv_id")
    )
    spanning = ends.join(several, "conv_id").select("conv_id", "part", "end.*")
    carried = spanning.groupBy("conv_id").applyInPandas(
        _carries, "conv_id long, part int, carry struct<place: long, upto: long, "
        + ", ".join(f"{n}: long" for n in _LANES) + ">"
    )
    joined = rows.join(F.broadcast(store(carried, "trie_carries")), ["conv_id", "part"], "left")
    carry = F.col("carry")

    def after(name: str) -> Column:
        return F.when(carry.isNull(), F.col(name)).otherwise(
            _then(carry[f"p{name[1]}"], F.col(name))
        ).alias(name)

    plus = lambda n: (F.col(n) + F.coalesce(carry[n], F.lit(0))).alias(n)
    return joined.select("conv_id", plus("place"), "digest", "chars", plus("upto"),
                         *map(after, _LANES + _BEFORE))


def _paths(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt turns (``conv_id``, ``depth``, node and parent fingerprint, digest, code points
    and those up to it) and ``conv_id``, ``turns`` of every rebuilt conversation.
    """
    named = lambda names, to: [F.col(n).alias(t) for n, t in zip(names, to, strict=True)]
    length = F.crc32(F.col("conv_id").cast("string")) % HEADS
    own = placed.groupBy("conv_id").agg(
        F.max("place").alias("n"),
        F.max(F.when(F.col("place") == length, F.struct("upto", *_LANES))).alias("cut"),
    )
    heads = placed.filter((F.col("conv_id") % HUNDRED == 0) & (F.col("place") < HEADS))
    bases = heads.groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("place", "chars", "upto", "digest", *_LANES,
                                             *_BEFORE))).alias("turns")
    )
    whole = (
        own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % HUNDRED, "h": length})
        .join(store(bases, "trie_bases"), "base", "left")
        .withColumn("head", F.coalesce(
            F.filter("turns", lambda t: t["place"] <= F.col("h")), F.array()))
        .withColumns({"k": F.size("head").cast("long"), "top": F.try_element_at(
            "head", F.greatest(F.size("head"), F.lit(1)))})
        .withColumn("own", F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    )
    nothing = F.lit(_IDENTITY).cast("long")
    shift = [
        _then(F.coalesce(F.col("top")[name], nothing),
              F.coalesce(_inverse(F.col("cut")[name]), nothing)).alias(f"s{name[1]}")
        for name in _LANES
    ]
    whole = store(
        whole.select(
            "conv_id", "h", "k", "own", "head",
            (F.coalesce(F.col("top.upto"), F.lit(0)) - F.coalesce(F.col("cut.upto"), F.lit(0)))
            .alias("more"), *shift,
        ),
        "trie_conversations",
    )
    key, above = [f"n{lane}" for lane in range(LANES)], [f"u{lane}" for lane in range(LANES)]
    shared = whole.select("conv_id", F.explode("head").alias("t")).select(
        "conv_id", F.col("t.place").alias("depth"), "t.digest", "t.chars", "t.upto",
        *named([f"t.{n}" for n in _LANES + _BEFORE], key + above),
    )
    kept = placed.join(
        whole.filter("own > 0").select("conv_id", "h", "k", "more", "s0", "s1", "s2", "s3"),
        "conv_id",
    ).filter("place > h")
    shifts = _lanes([f"s{lane}" for lane in range(LANES)])
    products = _product(shifts, _lanes(_LANES)) + _product(shifts, _lanes(_BEFORE))
    suffix = kept.select(
        "conv_id", (F.col("k") + F.col("place") - F.col("h")).alias("depth"), "digest", "chars",
        (F.col("upto") + F.col("more")).alias("upto"),
        *(p.alias(n) for p, n in zip(products, key + above, strict=True)),
    )
    ends = whole.select("conv_id", (F.col("k") + F.col("own")).alias("turns"))
    return shared.unionByName(suffix), ends


_KEY = [f"n{lane}" for lane in range(LANES)]
_ABOVE = [f"u{lane}" for lane in range(LANES)]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (depth, four keys, conv_id): ids of a node joined by commas, in few rows."""
    node, first, ids, size = None, 0, [], 0
    made: list[tuple] = []

    def rows():
        columns = list(zip(*made, strict=True)) if made else [[]] * 7
        made.clear()
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in columns[:6]), pa.array(columns[6], pa.string())],
            ["depth", *_KEY, "first", "ids"],
        )

    for batch in batches:
        for *key, conv in zip(*(c.to_numpy().tolist() for c in batch.columns), strict=True):
            if key != node or size >= CHUNK:
                if ids:
                    made.append((*node, first, ",".join(ids)))
                node, first, ids, size = key, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        yield rows()
    if ids:
        made.append((*node, first, ",".join(ids)))
    yield rows()


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted chunks (depth, four keys, first, ids) to the SHA-256 of each node's ids."""
    node, sha, made = None, None, []

    def rows():
        columns = list(zip(*made, strict=True)) if made else [[]] * 6
        made.clear()
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.string())],
            ["depth", *_KEY, "ends_sha256"],
        )

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for *key, _, ids in zip(*columns, strict=True):
            if key != node:
                if node:
                    made.append((*node, sha.hexdigest()))
                node, sha = key, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        yield rows()
    if node:
        made.append((*node, sha.hexdigest()))
    yield rows()


def _ends_hashed(rows: DataFrame) -> DataFrame:
    """``ends_sha256`` of each node (depth, key), of rows (depth, key, conv_id): a range of ids
    becomes text in a task of its own, and only the text of a node meets in one.
    """
    node = ["depth", *_KEY]
    chunks = (
        rows.repartitionByRange(*node, "conv_id").sortWithinPartitions(*node, "conv_id")
        .mapInArrow(_chunks, ", ".join(f"{n} long" for n in [*node, "first"]) + ", ids string")
    )
    return (
        store(chunks, "trie_chunks").repartition(*node).sortWithinPartitions(*node, "first")
        .mapInArrow(_hash, ", ".join(f"{n} long" for n in node) + ", ends_sha256 string")
    )


def _distinct(name: str) -> Column:
    return F.min(name) != F.max(name)


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt ``conversations`` (``conv_id``, ``turn``, ``role``,
    ``text``): ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id`` (the parent's, NULL
    for the root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256`` and
    ``turn_sha256``, the stored reference to the node's last turn (NULL for the root).

    Conversation c is rebuilt as the first h turns of conversation c - c % 100 (all if it has
    fewer, none if it is absent) and c's own turns after its first h, with h the unsigned CRC-32 of
    the decimal c, modulo 6. Turns are in the order of ``turn``, NULL first, ties by role and text;
    repeated rows are turns like others. NULL roles and texts are empty. A node is a distinct
    sequence of first turns; all conversations, also those rebuilt without a turn, are members of
    the root. ``saved_tokens`` sums (members - 1) times the code points of the last text over a
    node's subtree. Rows with a NULL ``conv_id`` take no part. No rows give no nodes; other columns
    are not read. Texts may have any length; a conversation may have any number of turns.
    """
    session_of(conversations)
    turns = _turns(conversations)
    _verify_texts(turns)
    node = ["depth", *_KEY]
    salt = 1
    while True:
        paths, ends = _paths(store(_placed(turns, salt), "trie_placed"))
        paths = store(paths, "trie_paths")
        unlike = reduce(Column.__or__, map(_distinct, ["digest", *_ABOVE]))
        wrong = paths.groupBy(*node).agg(unlike.alias("wrong"))
        if not wrong.filter("wrong").take(1):
            break
        salt += 1
    # The root: the product of no turn.
    root = [F.lit(_IDENTITY).cast("long").alias(n) for n in _KEY]
    unknown = [F.lit(None).cast("long").alias(n) for n in _ABOVE]
    roots = ends.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("digest"),
        F.lit(0).cast("long").alias("chars"), F.lit(0).cast("long").alias("upto"), *root, *unknown,
    )
    members = paths.unionByName(roots)
    stops = ends.select("conv_id", F.col("turns").alias("depth"))
    last = store(members.join(stops, ["conv_id", "depth"]).select(*node, "conv_id"), "trie_ends")
    ended = last.groupBy(*node).agg(F.count("*").alias("n_ends"))
    nodes = members.groupBy(*node).agg(
        F.min("conv_id").alias("owner"), F.count("*").alias("n_convs"),
        F.min("digest").alias("digest"), *(F.min(n).alias(n) for n in _ABOVE),
    ).join(ended, node, "left")
    nodes = store(nodes, "trie_nodes")
    owners = nodes.groupBy(F.col("owner").alias("conv_id")).agg(
        F.min("depth").alias("owns_from"),
        F.max((F.col("n_ends") == F.col("n_convs")).cast("int")).alias("leaf"),
    )
    known = store(ends.join(owners, "conv_id", "left"), "trie_owners")
    # Turns of a member between a node and what the member owns are saved there. Their code points
    # run up to the turn before the first owned one, or to the last turn.
    border = paths.join(known.select("conv_id", "owns_from", "turns"), "conv_id").filter(
        F.col("depth") == F.coalesce(F.col("owns_from") - 1, F.col("turns"))
    ).select("conv_id", F.col("upto").alias("border"))
    known = store(known.join(border, "conv_id", "left"), "trie_known")
    before = F.col("upto") - F.col("chars")
    saved = F.greatest(F.coalesce("border", F.lit(0)) - before, F.lit(0))
    deeper = (F.col("turns") > F.col("depth")) & (F.col("owns_from") <= F.col("depth") + 1)
    sums = members.join(known, "conv_id").groupBy(*node).agg(
        F.sum(F.coalesce(deeper, F.lit(False)).cast("long")).alias("n_children"),
        F.sum(F.coalesce("leaf", F.lit(0)).cast("long")).alias("n_leaves"),
        F.sum(saved).alias("saved_tokens"),
    )
    parents = nodes.select((F.col("depth") + 1).alias("depth"),
                           *(F.col(n).alias(u) for n, u in zip(_KEY, _ABOVE, strict=True)),
                           F.col("owner").alias("parent_conv_id"))
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(store(sums, "trie_sums"), node)
        .join(store(_ends_hashed(last), "trie_hashes"), node, "left")
        .join(store(parents, "trie_parents"), ["depth", *_ABOVE], "left")
        .select(
            F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children",
            "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
            F.lower(F.hex("digest")).alias("turn_sha256"),
        )
    )
