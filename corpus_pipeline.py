"""From raw documents to packed training sequences, in five stages.

Each stage works on all rows that the one before kept and returns the columns of ``documents``,
except the last, which returns the pieces and their places. Between stages the rows are written
to and read from the shared scratch folder, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.llm import catalog, exact_dedup, language, near_dedup, packing, quality
from rollcall.llm.common import read
from rollcall.sources import store

# Fixed value: texts less similar to every language than this are taken for none.
LEAST_LANGUAGE_SCORE = 0.1

# Tokenizing and the trained models cannot be said in SQL; tests compare with plain Python.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that ``quality.classify`` gives a score of one half or more, all columns; NULL and
    very long texts are judged like others, repeated rows each. Without labels all stay.
    """
    return quality.keep_good(docs, read(spark, sf_dir, "labels"), **catalog.sites())


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that ``docs`` teaches: neither without letters (NULL and empty texts
    go) nor, from 32 letters on, below the least score. Repeated rows are judged each.
    """
    return language.keep_known(docs, LEAST_LANGUAGE_SCORE)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal after lower-casing A-Z, the row with the largest ``doc_id``; NULL is empty."""
    return exact_dedup.drop_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates, the document with the smallest ``doc_id``; texts
    without words and rows without ``doc_id`` stay. Whole texts are compared, of any length.
    """
    return near_dedup.drop_near_duplicates(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of all documents with sequence and offset; longer documents are cut into pieces
    of 2,048 tokens, NULL is a piece of one token, repeated rows are packed each.
    """
    return packing.pack_documents(docs, catalog.tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("near_dedup", near_duplicates),
    ("packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
