"""Repeated passages removed by overlapping windows of three consecutive lines.

Built-in functions only. Every window is hashed to 128 bits: each line under two seeds, and the three
hashes of a seed together; windows are grouped by hash over the
whole table after partial aggregation, so a passage that a third of the rows share leaves each
task as one row. Only windows that repeat are looked up again (a join whose right side has one
row per repeated window, so that Spark can split a hot one), and what reaches the documents is
the list of start positions of later occurrences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.sources import store

WINDOW = 3


def _windows(lines: Column) -> Column:
    """(h1, h2) per window of consecutive lines; NULL hashes where all its lines are blank."""
    one = F.transform(
        lines,
        lambda line: F.struct(
            F.xxhash64(line).alias("a"),
            F.xxhash64(F.lit(1), line).alias("b"),  # salt first: another seed, not a hash of "a"
            (F.trim(line) != "").alias("filled"),
        ),
    )
    size = F.size(lines)
    shifted = [F.slice(one, 1 + k, F.greatest(size - WINDOW + 1, F.lit(0))) for k in range(WINDOW)]
    zipped = F.arrays_zip(*(part.alias(f"l{k}") for k, part in enumerate(shifted)))

    def window(x: Column) -> Column:
        each = [x[f"l{k}"] for k in range(WINDOW)]
        filled = each[0]["filled"] | each[1]["filled"] | each[2]["filled"]
        return F.struct(
            F.when(filled, F.xxhash64(*(e["a"] for e in each))).alias("h1"),
            F.when(filled, F.xxhash64(*(e["b"] for e in each))).alias("h2"),
        )

    return F.transform(zipped, window)


def _without(lines: Column, starts: Column) -> Column:
    """``lines`` without those that the windows at the ascending ``starts`` (from 0) cover:
    the slices between the merged windows, so the work follows the number of lines.
    """
    after = F.transform(starts, lambda s: s + WINDOW)
    gaps = F.arrays_zip(
        F.concat(F.array(F.lit(0)), after).alias("start"),
        F.concat(starts, F.array(F.size(lines))).alias("stop"),
    )
    return F.flatten(
        F.transform(
            gaps,
            lambda g: F.slice(lines, g["start"] + 1, F.greatest(g["stop"] - g["start"], F.lit(0))),
        )
    )


def remove_repeated_lines(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_lines``, ``removed_lines``, ``text`` without
    later occurrences of any three-line passage.

    Lines end at a line feed. Occurrences are in order of ``doc_id`` (NULL first), then of the
    hash of the text, then of position; the first of all stays, every later one goes, also one
    that overlaps the first within a document. What remains is joined by line feeds, and empty
    if nothing does. Windows of three blank lines are no passage. Texts of fewer than three
    lines, empty ones included, stay as they are; NULL stays NULL, with 0 lines. Rows that repeat
    ``doc_id`` and text are one document and stay alike. No rows give no rows. Other columns are
    not read.
    """
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("version"))
    at = F.struct("doc_id", "version", "pos")
    windows = (
        rows.filter(F.instr("text", "\n") > 0)
        .select("doc_id", "version", F.split("text", "\n", -1).alias("lines"))
        .select("doc_id", "version", F.posexplode(_windows(F.col("lines"))).alias("pos", "w"))
        .select("doc_id", "version", "pos", "w.h1", "w.h2")
        .filter("h1 IS NOT NULL")
    )
    # Stored, so that the join has an exchange of its own, which Spark can split at a hot window.
    repeated = store(
        windows.groupBy("h1", "h2")
        .agg(F.count("*").alias("times"), F.min(at).alias("first"))
        .filter("times > 1")
        .drop("times"),
        "repeated_windows",
    )
    later = (
        windows.join(repeated, ["h1", "h2"])
        .filter(at > F.col("first"))
        .groupBy(F.col("doc_id").alias("later_id"), F.col("version").alias("later_version"))
        .agg(F.sort_array(F.collect_set("pos")).alias("starts"))
    )
    lines = F.split("text", "\n", -1)
    same = F.col("doc_id").eqNullSafe(F.col("later_id"))
    same = same & (F.col("version") == F.col("later_version"))
    joined = rows.join(later, same, "left").select("doc_id", "text", "starts", F.when(F.col("text").isNotNull(), lines).alias("lines"))
    kept = joined.withColumn(
        "kept", F.when(F.col("starts").isNotNull(), _without(F.col("lines"), F.col("starts")))
    )
    n_lines = F.coalesce(F.size("lines"), F.lit(0))
    return kept.select(
        "doc_id",
        n_lines.cast("long").alias("n_lines"),
        F.coalesce(n_lines - F.size("kept"), F.lit(0)).cast("long").alias("removed_lines"),
        F.when(F.col("kept").isNotNull(), F.array_join("kept", "\n"))
        .otherwise(F.col("text"))
        .alias("text"),
    )
