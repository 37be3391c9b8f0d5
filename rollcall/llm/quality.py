"""Document quality: evidence of the text combined with what its site is like.

Evidence. Six figures of a text (shares of capitals, signs, bars, exclamation marks, digits, and
of words said twice in a row) fall into bins. For each bin, the log of how much likelier it is in
good labelled documents than in bad ones, shrunk toward none where few labelled documents have it,
is added up.

Sites. A host's share of good documents counts labels, and for documents without a label the
probability from the text alone, over all documents. It is shrunk toward the global share, and a
path's share toward its host's, by Beta priors whose strength comes from how much hosts (or paths
within hosts) differ beyond chance; sparse sites stay near their parent. The odds of a path times
the evidence of the text are the odds that a document is good.

Texts are read once and leave small rows; everything after is grouped aggregation over hosts and
paths, partial before each shuffle, so a host with a third of all documents leaves each task as
one row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import blocks, session_of, text_buffers
from rollcall.llm.shingles import word_hashes
from rollcall.sources import store

FIGURES, BINS = 6, 32
#: Labelled documents that a bin needs for its own shares to weigh as much as the global one.
SPARSE = 2
_BLOCK = 1 << 18


def _class(signs: bytes) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[list(signs)] = 1
    return table


_CLASSES = [
    _class(bytes(range(65, 91))),
    _class(b"#$%&*+/<=>@[\\]^_`{}~"),
    _class(b"|"),
    _class(b"!?"),
    _class(b"0123456789"),
]


def _share_bin(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """0 for no part, then 1 to 31: 31 above a share of 0.71, 30 above 0.5, 29 above 0.35, ..."""
    share = part / np.maximum(whole, 1)
    with np.errstate(divide="ignore"):
        return np.where(part > 0, np.clip(np.ceil(2 * np.log2(share)) + BINS - 1, 1, BINS - 1), 0)


def text_bins(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The bin of every figure, one row per text."""
    rows, lengths = len(starts) - 1, np.diff(starts)
    bins = np.zeros((rows, FIGURES), np.int64)
    for k, table in enumerate(_CLASSES):
        ends = np.concatenate([[0], np.cumsum(table[data])])
        bins[:, k] = _share_bin(ends[starts[1:]] - ends[starts[:-1]], lengths)
    words, at = word_hashes(data, starts)
    counts = np.diff(at)
    again = np.zeros(len(words) + 1, np.int64)  # words that are as the one before, summed up
    again[2:] = np.cumsum(words[1:] == words[:-1])
    bins[:, 5] = _share_bin(again[at[1:]] - again[np.minimum(at[:-1] + 1, at[1:])], counts - 1)
    return bins


def _bins(text: str | Column) -> Column:
    @F.arrow_udf("array<int>")
    def bins(texts: pa.Array) -> pa.Array:
        data, starts = text_buffers(texts)
        found = [np.zeros((0, FIGURES), np.int64)]
        for first, last in blocks(starts, _BLOCK):
            part = slice(starts[first], starts[last])
            found.append(text_bins(data[part], starts[first : last + 1] - starts[first]))
        values = np.concatenate(found).astype(np.int32).reshape(-1)
        ends = np.arange(0, len(values) + 1, FIGURES, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))

    return bins(F.coalesce(text, F.lit("")))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, mean: Column) -> float:
    """Strength of the Beta prior from the spread of group shares (``good`` of ``rows``) around
    ``mean``, by moments: spread beyond chance is p (1 - p) / (strength + 1). Between 1 and a
    million; a million, so groups are as their parent, where they don't differ beyond chance.
    """
    share = F.col("good") / F.col("rows")
    found = groups.filter("rows > 0").agg(
        F.sum(F.col("rows") * (share - mean) ** 2).alias("spread"),
        F.sum(mean * (1 - mean)).alias("chance"),
        F.sum(F.col("rows") * mean * (1 - mean)).alias("scale"),
    ).first()
    if not found["scale"]:
        return 1e6
    beyond = (found["spread"] - found["chance"]) / found["scale"]
    return min(max(1 / beyond - 1, 1.0), 1e6) if beyond > 0 else 1e6


class Model:
    """A fitted model: the log likelihood ratio per figure and bin, and a stored table ``paths`` of
    log odds per ``host`` and ``path``, one row each; ``prior`` is for paths it doesn't have.
    """

    def __init__(self, ratios: list[float], prior: float, paths: DataFrame):
        self.ratios, self.prior, self.paths = ratios, prior, paths

    def evidence(self, bins: Column) -> Column:
        table = F.array(*(F.lit(float(r)) for r in self.ratios))
        picked = F.transform(bins, lambda b, k: F.element_at(table, k * BINS + b + 1))
        return F.aggregate(picked, F.lit(0.0), lambda a, x: a + x)

    def score(self, docs: DataFrame, host: Column, path: Column, bins: Column) -> DataFrame:
        """``docs`` as column ``row``, with ``evidence``, ``site`` (log odds) and ``score``."""
        packed = docs.select(
            F.struct("*").alias("row"), host.alias("h"), path.alias("p"),
            self.evidence(bins).alias("evidence"),
        )
        same = F.col("h").eqNullSafe(F.col("host")) & F.col("p").eqNullSafe(F.col("path"))
        site = F.coalesce("site", F.lit(self.prior))
        return packed.join(self.paths, same, "left").select(
            "row", "evidence", site.alias("site"),
            (1 / (1 + F.exp(-(F.col("evidence") + site)))).alias("score"),
        )


def fit(figures: DataFrame, labels: DataFrame) -> Model:
    """From ``figures`` (stored: ``doc_id``, ``host``, ``path``, ``bins``) of all documents and
    ``labels`` (``doc_id``, ``quality`` 0 or 1; NULLs and other values teach nothing; repeated
    labels count each for the evidence and by their mean for the sites). Without labels of both
    kinds no text is better than another, and all score one half. All labels are used.
    """
    known = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("labelled"), F.col("quality").cast("double").alias("quality")
    )
    known = known.groupBy("labelled").agg(
        F.avg("quality").alias("good"), F.count("*").alias("times"), F.sum("quality").alias("sum")
    )
    marked = store(
        figures.join(known, F.col("doc_id") == F.col("labelled"), "left").drop("labelled"),
        "quality_marked",
    )
    counted = (
        marked.filter("times IS NOT NULL")
        .select("sum", (F.col("times") - F.col("sum")).alias("bad"), F.posexplode("bins"))
        .groupBy("pos", "col")
        .agg(F.sum("sum").alias("good"), F.sum("bad").alias("bad"))
        .collect()
    )
    good, bad = np.zeros((FIGURES, BINS)), np.zeros((FIGURES, BINS))
    for row in counted:
        good[row["pos"], row["col"]], bad[row["pos"], row["col"]] = row["good"], row["bad"]
    n_good, n_bad = good[0].sum(), bad[0].sum()
    share = n_good / (n_good + n_bad) if n_good and n_bad else 0.5
    prior = math.log(share / (1 - share))
    ratios = np.log((good + SPARSE * share) / (bad + SPARSE * (1 - share))) - prior
    ratios *= bool(n_good and n_bad)
    model = Model(ratios.reshape(-1).tolist(), prior, figures)
    alone = 1 / (1 + F.exp(-(model.evidence(F.col("bins")) + prior)))
    paths = store(
        marked.groupBy("host", "path").agg(
            F.sum(F.coalesce("good", alone)).alias("good"), F.count("*").alias("rows")
        ),
        "quality_paths",
    )
    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("rows").alias("rows"))
    of_hosts = _strength(hosts, F.lit(float(share)))
    posterior = hosts.select(
        F.col("host").alias("parent"),
        ((F.col("good") + of_hosts * share) / (F.col("rows") + of_hosts)).alias("host_share"),
    )
    nested = store(
        paths.join(posterior, F.col("host").eqNullSafe(F.col("parent"))).drop("parent"),
        "quality_nested",
    )
    of_paths = _strength(nested, F.col("host_share"))
    shrunk = (F.col("good") + of_paths * F.col("host_share")) / (F.col("rows") + of_paths)
    bounded = F.least(F.greatest(shrunk, F.lit(1e-6)), F.lit(1 - 1e-6))
    site = _logit(bounded).alias("site")
    model.paths = store(nested.select("host", "path", site), "quality_sites")
    return model


def figures_of(docs: DataFrame, host: Column, path: Column) -> DataFrame:
    """``doc_id``, ``host``, ``path`` and ``bins`` of every row, stored."""
    session_of(docs)
    return store(
        docs.select(
            "doc_id", host.alias("host"), path.alias("path"), _bins(F.col("text")).alias("bins")
        ),
        "quality_figures",
    )


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``evidence``, ``site`` (log odds of the path),
    ``score`` (probability of good quality), ``kept`` (a score of at least one half).

    ``host`` and ``path`` are columns of ``docs``; NULL is a host or path like any other. NULL
    text counts as empty. Repeated rows are scored each. No rows give no rows. Other columns are
    not read.
    """
    figures = figures_of(docs, host, path)
    scored = fit(figures, labels).score(figures, F.col("host"), F.col("path"), F.col("bins"))
    return scored.select(
        "row.doc_id", "evidence", "site", "score", (F.col("score") >= 0.5).alias("kept")
    )


def keep_good(docs: DataFrame, labels: DataFrame, host: Column, path: Column) -> DataFrame:
    """The rows of ``docs``, all columns, that ``classify`` keeps. Texts are read twice, to fit and
    to score, and not shuffled unless the table of paths is too large to broadcast.
    """
    model = fit(figures_of(docs, host, path), labels)
    scored = model.score(docs, host, path, _bins(docs["text"]))
    return scored.filter("score >= 0.5").select("row.*")
