from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from rollcall.llm import prefix_trie
from rollcall.llm.common import read

COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
]
SCHEMA = "conv_id long, turn long, role string, text string, depth int, k int"


def slow_trie(rows):
    """The nodes by putting every rebuilt conversation together and walking the tree."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(turns.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:])
    members, children = defaultdict(list), defaultdict(list)
    for c, path in rebuilt.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved, found = {}, {}, set()
    for path in sorted(members, key=len, reverse=True):
        below = children[path]
        leaves[path] = sum(leaves[x] for x in below) if below else 1
        own = (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
        saved[path] = own + sum(saved[x] for x in below)
        ends = ",".join(map(str, sorted(c for c in members[path] if rebuilt[c] == path)))
        parent = min(members[path[:-1]]) if path else None
        found.add((
            min(members[path]), len(path), parent, len(members[path]), len(below), leaves[path],
            saved[path], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    assert len(found) == len(members)
    return found


def hard_conversations():
    rng = random.Random(11)
    rows = []
    for conv in [*range(300), 901, -150, -100, 10**12 + 3]:
        n = rng.choice((1, 1, 2, 3, 5, 8))
        for turn in range(n):
            rows.append((conv, turn, rng.choice(("user", "assistant")), rng.choice("ab") * 2))
    rows += [(400, t, "user", f"turn {t % 3}") for t in range(900)]  # one long conversation
    rows += [(401, t, "user", f"turn {t % 3}") for t in range(700)]
    rows += [(500, 0, None, None), (500, None, "x", ""), (500, None, None, "x"), (500, 0, "", "")]
    rows += [(501, 1, "user", "same")] * 7  # repeated rows
    rows += [(502, 0, "user", "é" * 50_000), (503, 0, "user", "é" * 50_000)]
    rows += [(None, 0, "user", "nobody"), (504, 0, "a\nb", "c"), (505, 0, "a", "b\nc")]
    rng.shuffle(rows)
    return rows


def nodes_of(df):
    return {tuple(r) for r in df.select(*COLUMNS).collect()}


def test_trie_equals_brute_force(spark):
    rows = hard_conversations()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA).repartition(5)
    got = prefix_trie.trie(df)
    assert got.columns == [*COLUMNS, "turn_sha256"]
    assert nodes_of(got) == slow_trie(rows)


def test_query_equals_brute_force(spark):
    df = read(spark, "/root/testdata/sf0.01", "conversations")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    assert nodes_of(prefix_trie.trie(df)) == slow_trie(rows)


def test_colliding_fingerprints_are_seen_and_drawn_anew(spark, monkeypatch):
    original, salts = prefix_trie._stretches, []

    def colliding(salt):
        """With the first salt, all turns of a place have the same products."""
        salts.append(salt)
        inner, n = original(salt), len(prefix_trie._LANES)

        def read(batches):
            for batch in inner(batches):
                place = batch.column("place").to_numpy()
                columns = list(batch.columns)
                if salt == 1:
                    for k in range(2 * n):
                        columns[-2 * n + k] = pa.array((1 << 31) + place - (k >= n))
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

        return read

    monkeypatch.setattr(prefix_trie, "_stretches", colliding)
    rows = [(c, t, "user", f"{c % 4} {t} {c % 2}") for c in range(12) for t in range(3)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    assert nodes_of(prefix_trie.trie(df)) == slow_trie(rows)
    assert salts == [1, 2]


def test_no_conversations_give_no_nodes(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.trie(df).collect() == []


def test_products_compose_and_undo(spark):
    rng = random.Random(5)
    p = prefix_trie.PRIME
    maps = [(rng.randrange(1, p), rng.randrange(p)) for _ in range(40)]
    packed = [(a << 31 | b, c << 31 | d) for (a, b), (c, d) in zip(maps, maps[1:], strict=False)]
    df = spark.createDataFrame(packed, "one long, two long").select(
        "one", "two", prefix_trie._then(prefix_trie.F.col("one"), prefix_trie.F.col("two"))
        .alias("both"),
        prefix_trie._then(prefix_trie.F.col("one"),
                          prefix_trie._inverse(prefix_trie.F.col("one"))).alias("undone"),
    )
    for one, two, both, undone in df.collect():
        a, b, c, d = one >> 31, one % 2**31, two >> 31, two % 2**31
        assert both == (a * c % p) << 31 | (c * b + d) % p
        assert undone == 1 << 31


@pytest.mark.parametrize("lengths", [(1,), (5, 1, 9), (130, 2)])
def test_running_products(lengths):
    rng = np.random.default_rng(1)
    n = sum(lengths)
    a = rng.integers(1, prefix_trie.PRIME, (n, 4)).astype(np.uint64)
    b = rng.integers(0, prefix_trie.PRIME, (n, 4)).astype(np.uint64)
    head = np.zeros(n, bool)
    head[np.cumsum((0, *lengths[:-1]))] = True
    want, one, two = [], None, None
    for k in range(n):
        x, y = [int(v) for v in a[k]], [int(v) for v in b[k]]
        if head[k]:
            one, two = x, y
        else:
            two = [(p * q + r) % prefix_trie.PRIME for p, q, r in zip(x, two, y, strict=True)]
            one = [p * q % prefix_trie.PRIME for p, q in zip(x, one, strict=True)]
        want.append((one, two))
    prefix_trie._running(a, b, head)
    assert [(u.tolist(), v.tolist()) for u, v in zip(a, b, strict=True)] == want
