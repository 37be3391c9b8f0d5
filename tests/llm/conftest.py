from __future__ import annotations

import pytest

from rollcall.llm.common import session_of


@pytest.fixture
def docs_of(spark):
    """Documents with given ids and texts, and more columns, two of which operators use inside."""

    def make(rows, lang="en", source="s"):
        full = [(*row, lang, source, len(row[1] or ""), 1, "x", False) for row in rows]
        df = spark.createDataFrame(
            full,
            "doc_id long, text string, lang string, source string, n_chars long, bucket int,"
            " row string, kept boolean",
        )
        session_of(df)
        return df.repartition(3)

    return make


#: Cases that every operator on documents must stand.
HARD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one two three four five six"),
    (4, "one two three four five six"),
    (5, "One Two Three Four Five Six"),
    (6, "x" * 100_000),
    (7, "w " * 30_000),
    (None, "one two three four five six"),
    (None, None),
    (8, "Éa ß 日本語 🙂 <|im_end|> a\x00b"),
    (-9, "a\nb\nc\nd\na\nb\nc\na\nb\nc"),
]
