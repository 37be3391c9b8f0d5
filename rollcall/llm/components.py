"""Union-find over tables: the smallest node reachable from each node."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import in_few_files
from rollcall.sources import store


def _descending(edges: DataFrame) -> DataFrame:
    edges = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    return store(in_few_files(edges.distinct()), "components")


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each node and how many it has; stored, so that joins with it have
    exchanges of their own, which Spark can split at a node with very many links.
    """
    least = edges.groupBy("a").agg(F.min("b").alias("least"), F.count("*").alias("n"))
    return store(in_few_files(least), "components")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node it reaches) for every node of ``edges``
    (``a``, ``b``, undirected, non-NULL).

    Each round hooks all larger neighbours of a node to its smallest one, then the node and its
    smaller neighbours alike, so that chains halve and every component ends as a star: then no
    node that has a smaller neighbour has another one. A node's smallest neighbour comes from a
    partial aggregation, and the join that hands it out has one row per node on one side, so Spark
    can split a node with very many links. Every round is stored; rounds grow with the logarithm
    of the longest chain.
    """
    edges = _descending(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both)
        if not least.agg(F.bool_or(F.expr("least < a AND n > 1"))).first()[0]:
            return least.select(
                F.col("a").alias("node"), F.least("least", "a").alias("component")
            )
        large = _descending(
            both.join(least, "a")
            .filter("b > a")
            .select(F.col("b").alias("a"), F.least("least", "a").alias("b"))
        )
        least = _least(large)
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        tops = least.select("a", F.col("least").alias("b"))
        edges = _descending(small.unionByName(tops))
