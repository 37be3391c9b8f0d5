"""Language identification with hyperdimensional vectors.

Every letter has a fixed random vector of -1 and 1, drawn from its code point. Three letters in a
row (a word's start and end count as a letter) are bound: the first vector rotated by two places,
the second by one and the third as it is are multiplied. Bundling, the sum over all trigrams of a
text, gives the text's vector; bundling the texts of a language, each scaled to length one, gives
the language's prototype. A text has the language whose prototype has the largest cosine.

Training reads all labelled texts once and leaves one vector per language and task; the sums are
of whole numbers, so the prototypes do not depend on the order of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import blocks, mix, session_of, text_buffers

DIMENSIONS = 1024
UNKNOWN = "und"
#: Texts of fewer letters (a trigram each) are too short to be judged: the cosine falls with the
#: number of trigrams, while its noise stays at 1 / sqrt(DIMENSIONS).
SHORT = 32
_BLOCK = 1 << 18
_SCALE = 1 << 20
_CODE_BITS = 21


@cache
def _letters() -> np.ndarray:
    """Which code points are letters; surrogates are none."""
    return np.array([not 0xD800 <= c < 0xE000 and chr(c).isalpha() for c in range(0x110000)])


def _random_vectors(codes: np.ndarray) -> np.ndarray:
    """A row of -1 and 1 per code point (0 stands for a word's edge)."""
    words = np.arange(DIMENSIONS // 64, dtype=np.uint64)
    bits = mix(mix(codes.astype(np.uint64))[:, None] ^ mix(words + np.uint64(1 << 32)))
    return np.unpackbits(bits.view(np.uint8), axis=1).astype(np.int8) * 2 - 1


def text_vectors(texts: list[str]) -> np.ndarray:
    """The bundled vector of each text; zeros for a text without letters."""
    lowered = [text.lower() for text in texts]
    joined = " ".join([*lowered, ""])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(text) + 1 for text in lowered])
    codes = np.where(_letters()[codes], codes, 0).astype(np.int64)
    at = np.flatnonzero(codes)
    found = np.zeros((len(texts), DIMENSIONS), np.float32)
    if not len(at):
        return found
    before = np.where(at > 0, codes[at - 1], 0)
    grams = before << 2 * _CODE_BITS | codes[at] << _CODE_BITS | codes[at + 1]
    distinct, inverse = np.unique(grams, return_inverse=True)
    shifts = np.array([[2 * _CODE_BITS], [_CODE_BITS], [0]])
    alphabet, places = np.unique(distinct >> shifts & (1 << _CODE_BITS) - 1, return_inverse=True)
    places = places.reshape(3, -1)
    last = _random_vectors(alphabet)
    first, second = np.roll(last, 2, axis=1), np.roll(last, 1, axis=1)
    rows = row[at]
    width = 4096  # trigrams bound at a time
    for start in range(0, len(distinct), width):
        part = slice(start, start + width)
        bound = first[places[0, part]] * second[places[1, part]] * last[places[2, part]]
        here = (inverse >= start) & (inverse < start + width)
        counts = np.bincount(
            rows[here] * len(bound) + inverse[here] - start, minlength=len(texts) * len(bound)
        ).reshape(len(texts), len(bound))
        found += counts.astype(np.float32) @ bound.astype(np.float32)
    return found


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zeros stay."""
    length = np.linalg.norm(vectors, axis=-1, keepdims=True)
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


def _bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        _, starts = text_buffers(batch.column(1))
        for first, last in blocks(starts, _BLOCK):
            part = batch.slice(first, last - first)
            units = _unit(text_vectors([t or "" for t in part.column(1).to_pylist()]))
            whole = np.rint(units * _SCALE).astype(np.int64)
            for lang, vector in zip(part.column(0).to_pylist(), whole, strict=True):
                if lang in sums:
                    sums[lang] += vector
                else:
                    sums[lang] = vector.copy()
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(list(sums), pa.string()),
            pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64())),
        ],
        ["lang", "vector"],
    )


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages, in order, and their prototypes of length one, from ``text`` and ``lang`` of all
    rows with a non-NULL ``lang``. The driver gets 8 KB per language.
    """
    session_of(docs)
    parts = docs.filter("lang IS NOT NULL").select("lang", "text")
    sums = (
        parts.mapInArrow(_bundle, "lang string, vector array<long>")
        .select("lang", F.posexplode("vector"))
        .groupBy("lang", "pos")
        .agg(F.sum("col").alias("value"))
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "value"))).alias("vector"))
        .select("lang", "vector.value")
        .orderBy("lang")
        .collect()
    )
    prototypes = np.array([row["value"] for row in sums], np.float64).reshape(-1, DIMENSIONS)
    return [row["lang"] for row in sums], _unit(prototypes).astype(np.float32)


def predict(text: Column, languages: list[str], prototypes: np.ndarray) -> Column:
    """A struct of ``lang_pred`` and ``score`` (the cosine, at least 0) from ``text`` alone. NULL
    texts, texts without a letter, and all texts if there is no prototype are ``und`` with score
    0. Ties go to the first language by name.
    """

    @F.arrow_udf("lang_pred string, score double")
    def score(texts: pa.Array) -> pa.Array:
        names = np.array([*languages, UNKNOWN], object)
        best, cosine = np.full(len(texts), len(languages)), np.zeros(len(texts))
        _, starts = text_buffers(texts)
        for first, last in blocks(starts, _BLOCK):
            part = texts.slice(first, last - first).to_pylist()
            vectors = text_vectors([t or "" for t in part])
            lengths = np.linalg.norm(vectors, axis=1)
            some = np.flatnonzero(lengths > 0)
            if len(some) and languages:
                cosines = vectors[some] @ prototypes.T / lengths[some, None]
                best[first + some] = cosines.argmax(axis=1)
                cosine[first + some] = cosines.max(axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(names[best], pa.string()), pa.array(np.clip(cosine, 0, 1))],
            ["lang_pred", "score"],
        )

    return score(text)


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that training must not see; a NULL id counts as empty text."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(F.encode(key, "UTF-8")) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``lang_pred``, ``score``.

    Prototypes come from the rows that are not held out. NULL ``lang`` teaches nothing. Repeated
    rows are predicted each. No rows give no rows. Other columns are not read.
    """
    session_of(docs)
    marked = docs.select("doc_id", held_out().alias("held_out"), "text", "lang")
    model = train(marked.filter("NOT held_out"))
    return marked.select(
        "doc_id", "held_out", predict(F.col("text"), *model).alias("found")
    ).select("doc_id", "held_out", "found.*")


def keep_known(docs: DataFrame, least_score: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose text resembles a language of ``docs`` with a
    cosine of at least ``least_score``, or has fewer than ``SHORT`` letters, too few to tell;
    texts that are ``und`` go. Prototypes come from all rows with a ``lang``.
    """
    found = predict(docs["text"], *train(docs))
    packed = docs.select(F.struct("*").alias("row"), found.alias("found"))
    letters = F.char_length(F.regexp_replace("row.text", r"\P{L}+", ""))
    known = (F.col("found.score") >= least_score) | (letters < SHORT)
    return packed.filter((F.col("found.lang_pred") != UNKNOWN) & known).select("row.*")
