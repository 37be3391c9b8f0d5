from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import hard_negatives
from rollcall.llm.hard_negatives import SortedLists

SCHEMA = "vec_id long, label string, embedding array<double>, line int, positives string"


def slow(rows, anchors):
    """Hard negatives by scoring every pair in whole numbers."""
    best = {}
    for i, label, vec in rows:
        if i is None or label is None or vec is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vec):
            continue
        best[i] = min(best.get(i, (label, vec)), (label, vec))
    whole = {i: (label, [math.floor(256 * x) if abs(x) < 2**60 else int(x) * 256 for x in vec])
             for i, (label, vec) in best.items()}
    found = set()
    for a in filter(anchors, whole):
        label, vec = whole[a]
        score = {
            i: max(-(2**63) + 1, min(2**63 - 1, sum(x * y for x, y in zip(vec, v, strict=False))))
            for i, (_, v) in whole.items() if i != a
        }
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if whole[i][0] == label][:5]:
            fits = [n for n in order if whole[n][0] != label
                    and 30 * score[p] <= 100 * score[n] <= 90 * score[p]]
            found |= {(a, p, k + 1, n, score[p], score[n]) for k, n in enumerate(fits[:10])}
    return found


def random_rows(n, width, seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(width)] for _ in range(4)]
    rows = []
    for i in range(n):
        label = rng.randrange(4)
        vec = [round(x + rng.gauss(0, 0.2), 2) for x in centres[label]]
        rows.append((i - 20, str(label), vec))
    return rows


def mined(spark, rows, blocks, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", blocks)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 7)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    return hard_negatives.mine(df, F.col("vec_id") % 10 == 0)


def test_mining_equals_brute_force(spark, monkeypatch):
    rows = random_rows(400, 6, 1)
    rows += [(i + 1000, label, vec) for i, label, vec in rows[:80]]  # ties by score
    rows += [rows[5], rows[5], (7, "9", rows[7][2]), (7, "9", [5.0])]  # repeated ids
    rows += [
        (None, "1", [1.0] * 6), (2000, None, [1.0] * 6), (2001, "1", None), (2010, "1", []),
        (2002, "1", [1.0, None] * 3), (2003, "1", [math.nan] * 6), (2004, "1", [math.inf] * 6),
        (2020, "2", [0.0] * 6), (2030, "3", [1.0, 2.0]), (2040, "0", [-5.0] * 6),
    ]
    got = mined(spark, rows, 60, monkeypatch)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    want = slow(rows, lambda i: i % 10 == 0)
    assert len(want) > 500
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_scores_beyond_floats_are_exact(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, str(i % 2), [rng.randint(-9, 9) * 2.0 ** rng.randint(0, 21) for _ in range(5)])
            for i in range(120)]
    rows += [(500, "0", [1e300, -1e18, 3.0, 1e18, 0.1])]
    assert set(map(tuple, mined(spark, rows, 1000, monkeypatch).collect())) == slow(
        rows, lambda i: i % 10 == 0)


def test_no_rows_and_no_anchors_give_none(spark, monkeypatch):
    assert mined(spark, [], 10, monkeypatch).collect() == []
    assert mined(spark, [(1, "a", [1.0]), (2, "b", [1.0])], 10, monkeypatch).collect() == []


@pytest.mark.parametrize("width", [1, 3])
def test_reading_stops_early_and_only_when_no_other_row_can_win(width):
    rng = np.random.default_rng(width)
    n = 4000
    vectors = rng.integers(-200, 200, (n, width)).astype(float)
    lists = SortedLists(np.arange(n), vectors)
    depths = []
    for _ in range(20):
        anchor = rng.integers(-200, 200, width).astype(float)
        label = rng.integers(0, 3, n) == 0
        rows, scores, depth = lists.read(
            anchor, label, lambda r, s, t: t < hard_negatives._kth(s, 5))
        best = rows[lists.best(rows, scores, 5)]
        every = vectors @ anchor
        order = np.lexsort((np.arange(n), -every))
        assert best.tolist() == order[label[order]][:5].tolist()
        depths.append(depth)
    assert np.median(depths) < n / 4


def test_a_hot_label_does_not_grow_a_group(spark, monkeypatch):
    rows = [(i, "hot" if i % 3 else str(i), [float(i % 17), 1.0, float(i % 5)]) for i in range(300)]
    sizes = []
    real = hard_negatives._in_blocks

    def watched(anchors, rows, columns, lines, find, schema):
        sizes.append((columns, lines))
        return real(anchors, rows, columns, lines, find, schema)

    monkeypatch.setattr(hard_negatives, "_in_blocks", watched)
    got = set(map(tuple, mined(spark, rows, 50, monkeypatch).collect()))
    assert got == slow(rows, lambda i: i % 10 == 0)
    assert sizes == [(6, 5), (6, 5)]
