"""Hard negatives by the threshold algorithm over sorted lists of components.

Vectors become whole numbers, so that scores (inner products) are exact. They are dealt by a hash
of their id into blocks of bounded size, anchors likewise, and every block of anchors meets every
block of vectors in one group of a cogroup. There, each dimension has a list of the block's rows in
order of that component. An anchor reads the lists of its non-zero dimensions from the end where
its sign makes the product largest, all to the same depth; each row met for the first time is
scored in full by random access. No unread row can score more than the threshold, the anchor times
the components at the present depth, so reading ends once the threshold is strictly below the kth
best score (strictly, as a tie may go to a smaller id). A search for negatives has several windows
of scores; it ends when the threshold is strictly below each window's kth best score or floor.

The best of all blocks are merged per anchor. The first run finds the positives, which fix the
windows of the second. Work and copies grow with anchors times vectors, as every anchor has to be
held against every block; a group never holds more than the two blocks, and no label, vector or
anchor is in more rows of a group than its own.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollcall.llm.common import session_of
from rollcall.sources import store

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score is at least and at most these percentages of the positive's.
WINDOW = (30, 90)
#: Vectors and anchors of a block, on average.
BLOCK_ROWS, ANCHOR_ROWS = 8192, 4096
FIRST_DEPTH = 32
_LONG = 2**63 - 1


def _whole(vectors: list[np.ndarray], width: int) -> np.ndarray:
    """Components times 256, rounded down, a row per vector, filled up with zeros; floats where
    all of them are exact, else whole numbers of any size.
    """
    full = np.zeros((len(vectors), width))
    for row, vector in enumerate(vectors):
        full[row, : len(vector)] = vector
    if not full.size or np.abs(full).max() < 2.0**40:
        return np.floor(full * SCALE)
    exact = [int(x) * SCALE if abs(x) > 2.0**60 else math.floor(x * SCALE) for x in full.flat]
    return np.array(exact, object).reshape(full.shape)


class SortedLists:
    """The rows of a block with a list per dimension, in order of the component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.rising = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T)
        self.values = np.take_along_axis(vectors.T, self.rising, axis=1)

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        found = self.vectors[rows] @ anchor
        if found.dtype == object:
            found = np.array([max(-_LONG, min(_LONG, x)) for x in found], np.int64)
        return found.astype(np.int64)

    def read(
        self,
        anchor: np.ndarray,
        taken: np.ndarray,
        enough: Callable[[np.ndarray, np.ndarray, float], bool],
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows that ``taken`` marks and their scores, read until ``enough`` says so of rows,
        scores and threshold, and the depth reached.
        """
        n = len(self.ids)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        depth, step = 0, FIRST_DEPTH
        unseen = np.ones(n, bool)
        rows, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while depth < n:
            upto = min(n, depth + step)
            if len(up) + len(down):
                met = np.zeros(n, bool)
                met[self.rising[down, depth:upto]] = True
                met[self.rising[up, n - upto : n - depth]] = True
                threshold = anchor[down] @ self.values[down, upto - 1]
                threshold += anchor[up] @ self.values[up, n - upto]
            else:  # every score is 0, and no list says more
                met, threshold, upto = unseen.copy(), 0, n
            new = np.flatnonzero(met & unseen & taken)
            unseen &= ~met
            if len(new):
                rows = np.concatenate([rows, new])
                scores = np.concatenate([scores, self.scores(new, anchor)])
            depth, step = upto, 2 * step
            if enough(rows, scores, threshold):
                break
        return rows, scores, depth

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """Places of the first ``k`` by score, ties by id."""
        return np.lexsort((self.ids[rows], -scores))[:k]


def _kth(scores: np.ndarray, k: int) -> float:
    return np.partition(scores, len(scores) - k)[-k] if len(scores) >= k else -math.inf


def _within(scores: np.ndarray, positive: int) -> np.ndarray:
    low, high = WINDOW
    if abs(positive) < 2**55 and (not len(scores) or np.abs(scores).max() < 2**55):
        return (low * positive <= 100 * scores) & (100 * scores <= high * positive)
    return np.array([low * positive <= 100 * int(s) <= high * positive for s in scores], bool)


def _positives(lists: SortedLists, anchor: np.ndarray, same: np.ndarray):
    def enough(rows, scores, threshold):
        return threshold < _kth(scores, POSITIVES)

    rows, scores, _ = lists.read(anchor, same, enough)
    best = lists.best(rows, scores, POSITIVES)
    return lists.ids[rows[best]], scores[best]


def _negatives(lists: SortedLists, anchor: np.ndarray, other: np.ndarray, positives: list[int]):
    """Ids and scores of the best of each window; windows of equal positives are one."""

    def enough(rows, scores, threshold):
        return all(
            100 * threshold < WINDOW[0] * positive
            or threshold < _kth(scores[_within(scores, positive)], NEGATIVES)
            for positive in windows
        )

    windows = {p for p in positives if p >= 0}  # below zero a window is empty
    if not windows:
        return {}
    rows, scores, _ = lists.read(anchor, other, enough)
    found = {}
    for positive in windows:
        inside = np.flatnonzero(_within(scores, positive))
        best = inside[lists.best(rows[inside], scores[inside], NEGATIVES)]
        found[positive] = lists.ids[rows[best]], scores[best]
    return found


def _block(anchors: pa.Table, rows: pa.Table):
    """Anchors and lists of one group, and for each anchor the rows of its own label."""
    vectors = [np.array(v) for t in (anchors, rows) for v in t["vec"].to_pylist()]
    whole = _whole(vectors, max((len(v) for v in vectors), default=0))
    mine, theirs = whole[: len(anchors)], whole[len(anchors) :]
    if whole.dtype != object and whole.size:
        if np.abs(mine).max(initial=0) * np.abs(theirs).max(initial=0) * whole.shape[1] >= 2**53:
            mine, theirs = (np.array([int(x) for x in w.flat], object).reshape(w.shape)
                            for w in (mine, theirs))
    lists = SortedLists(rows["vec_id"].to_numpy(), theirs)
    _, label = np.unique(
        np.array(anchors["label"].to_pylist() + rows["label"].to_pylist(), object),
        return_inverse=True,
    )
    return mine, lists, label[: len(anchors)], label[len(anchors) :]


_POSITIVE = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()),
                       ("positive_score", pa.int64())])
_NEGATIVE = pa.schema([*_POSITIVE, ("negative_id", pa.int64()), ("negative_score", pa.int64())])


def _find_positives(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    found = []
    if len(anchors) and len(rows):
        vectors, lists, own, label = _block(anchors, rows)
        for k, anchor_id in enumerate(anchors["vec_id"].to_numpy()):
            same = (label == own[k]) & (lists.ids != anchor_id)
            for i, s in zip(*_positives(lists, vectors[k], same), strict=True):
                found.append((anchor_id, i, s))
    return pa.table([pa.array(c, pa.int64()) for c in zip(*found)] if found
                    else [[], [], []], schema=_POSITIVE)


def _find_negatives(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    found = []
    if len(anchors) and len(rows):
        vectors, lists, own, label = _block(anchors, rows)
        positives = anchors["positives"].to_pylist()
        for k, anchor_id in enumerate(anchors["vec_id"].to_numpy()):
            scores = [p["positive_score"] for p in positives[k]]
            windows = _negatives(lists, vectors[k], label != own[k], scores)
            for p in positives[k]:
                for i, s in zip(*windows.get(p["positive_score"], ((), ())), strict=True):
                    found.append((anchor_id, p["positive_id"], p["positive_score"], i, s))
    return pa.table([pa.array(c, pa.int64()) for c in zip(*found)] if found
                    else [[], [], [], [], []], schema=_NEGATIVE)


def _in_blocks(anchors: DataFrame, rows: DataFrame, columns: int, lines: int, find, schema: str):
    """``find`` applied to every block of anchors with every block of rows."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    place = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), "vec_id"), F.lit(n)).cast("int")
    left = anchors.withColumns({"line": place(lines, 1)}).withColumn("column", every(columns))
    right = rows.withColumns({"column": place(columns, 2)}).withColumn("line", every(lines))
    keys = ("line", "column")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(find, schema)


def mine(embeddings: DataFrame, is_anchor: Column) -> DataFrame:
    """Hard negatives of ``embeddings`` (``vec_id``, ``label``, ``embedding``): ``anchor_id``,
    ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``.

    Components become ``floor(256 * x)``; a score is the whole-number inner product, the shorter
    vector filled up with zeros. Anchors are the rows that ``is_anchor`` holds for. Their positives
    are the first ``POSITIVES`` other rows of the same label, highest score first, ties by smaller
    ``vec_id``; for each, the first ``NEGATIVES`` rows of other labels with a score of 30 to 90 % of
    the positive's are returned, so none where that is negative.

    Rows with a NULL id, label or vector, or a NULL or non-finite component take no part; an empty
    vector scores 0 with all. Of rows with the same id, the one with the smallest label (as text),
    then vector, takes part. Scores beyond 64 bits are cut to the largest long. An empty table
    gives no rows; other columns are not read.
    """
    session_of(embeddings)
    vec = F.transform("embedding", lambda x: x.cast("double"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                    & (F.abs(x.cast("double")) < float("inf")))
    some = (
        embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
        .filter(F.coalesce(fine, F.lit(False)))
        .groupBy(F.col("vec_id").cast("long").alias("vec_id"))
        .agg(F.min(F.struct(F.col("label").cast("string").alias("label"), vec.alias("vec")))
             .alias("row"))
        .select("vec_id", "row.*")
    )
    rows = store(some, "negative_rows")
    anchors = rows.filter(is_anchor)
    columns = max(1, math.ceil(rows.count() / BLOCK_ROWS))
    lines = max(1, math.ceil(anchors.count() / ANCHOR_ROWS))
    schema = "anchor_id long, positive_id long, positive_score long"
    positives = _in_blocks(anchors, rows, columns, lines, _find_positives, schema)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    positives = (
        positives.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= POSITIVES)
        .groupBy("anchor_id")
        .agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    )
    known = store(
        anchors.join(positives, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id"),
        "negative_anchors",
    )
    schema += ", negative_id long, negative_score long"
    negatives = _in_blocks(known, rows, columns, lines, _find_negatives, schema)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(
        F.desc("negative_score"), "negative_id"
    )
    return (
        negatives.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= NEGATIVES)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                "negative_score")
    )
