"""Document fingerprints by consistent weighted sampling.

A text's terms are its words (weight 0.2 for each time they occur) and its runs of five words
(weight 1), A-Z lower-cased. For each of 64 slots every term draws, from its hash alone, r and c
from Gamma(2, 1) and b from the unit interval. With weight w, t = floor(ln w / r + b), and the
term whose ln c - r (t - b + 1) is least gives the slot; what is kept is a hash of term and t. Two
texts agree in a slot with a probability equal to their generalised Jaccard similarity, the sum of
the smaller weights over the sum of the larger. A fingerprint is 64 slots of 16 bits, as 256
hexadecimal digits.

Few terms can give a slot. The least value among terms of total weight W is the logarithm of an
exponential variable of rate W, and a term's value is at least ln c - r - ln w. Terms whose bound is
over that of ``LIKELY`` / W are passed by after the draws' upper bits alone, once for all texts of
a block; the others are drawn in full. Where none of them is below ``LIKELY`` / W (a slot in some
150), all terms of the text are drawn, so the result is that of drawing every term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import BATCH_ROWS, blocks, mix, mix_upper, session_of, text_buffers
from rollcall.llm.shingles import word_hashes

SLOTS = 64
RUN = 5
WORD_WEIGHT = 0.2
#: What a text without words has in every slot.
EMPTY = 0xFFFF
#: A slot's term is sought below this, over the weight of all terms; e ** -5 are not found there.
LIKELY = 5.0
_BLOCK = 1 << 18
#: Terms whose draws are bounded at once (buffers of 256 KB), terms whose likely ones are kept at
#: once, and values offered to texts at once.
_CHUNK, _PIECE, _OFFERED = 512, 1 << 15, 1 << 18
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SALTS = [mix(np.arange(SLOTS, dtype=np.uint64) + np.uint64(k << 32)) for k in (1, 2)]


def _unit(bits: np.ndarray, digits: int) -> np.ndarray:
    """So many bits, 24 at most, as a number strictly between 0 and 1."""
    # Signed 32-bit integers are converted several at a time, unsigned 64-bit ones are not.
    unit = bits.astype(np.uint32).view(np.int32).astype(np.float32)
    unit += np.float32(0.5)
    unit *= np.float32(2.0**-digits)
    return unit


def _gamma(bits: np.ndarray) -> np.ndarray:
    """Gamma(2, 1) from the upper 48 bits."""
    found = _unit(bits >> np.uint64(40), 24)
    found *= _unit(bits >> np.uint64(16) & np.uint64(0xFFFFFF), 24)
    # Both may have been rounded to 1, which has no second logarithm.
    np.minimum(found, np.float32(1 - 2.0**-24), out=found)
    np.log(found, out=found)
    return np.negative(found, out=found)


def _drawn(terms: np.ndarray, slots: int | slice | np.ndarray, log_weight: np.ndarray):
    """ln c - r (t - b + 1) and t for terms and slots."""
    one = mix(terms ^ _SALTS[0][slots])
    r, b = _gamma(one), _unit(one & np.uint64(0xFFFF), 16)
    c = _gamma(mix(terms ^ _SALTS[1][slots]))
    t = log_weight / r
    t += b
    np.floor(t, out=t)
    np.subtract(t, b, out=b)
    b += np.float32(1)
    b *= r
    np.log(c, out=c)
    c -= b
    return c, t


class _Bounds:
    """Bounds from below for ``exp`` of the values of ``_drawn``, times the weight."""

    def __init__(self) -> None:
        shape = (SLOTS, _CHUNK)
        self._wide = [np.empty(shape, np.uint64) for _ in range(2)]
        self._bits = [np.empty(shape, np.uint32) for _ in range(2)]
        self._parts = [np.empty(shape, np.float32) for _ in range(3)]

    def _product(self, terms: np.ndarray, salts: np.ndarray, more: int, out: np.ndarray) -> None:
        """2 ** 32 times the two units of ``_gamma``, of the second only its upper 7 bits, with
        ``more`` added to these times 2.
        """
        mixed, spare = (x[:, : len(terms)] for x in self._wide)
        high, bits = (x[:, : len(terms)] for x in self._bits)
        np.bitwise_xor(terms, salts[:, None], out=mixed)
        mix_upper(mixed, spare)
        np.copyto(high, mixed.view(np.uint32)[:, 1::2])
        np.right_shift(high, np.uint32(8), out=bits)
        np.copyto(out, bits.view(np.int32))
        high &= np.uint32(0xFE)
        if more:
            high += np.uint32(more)
        part = self._parts[2][:, : len(terms)]
        np.copyto(part, high.view(np.int32))
        out *= part

    def of(self, terms: np.ndarray) -> np.ndarray:
        """2 ** 64 times exp(-r) (1 - exp(-c)) or less, by slot and term: c is larger than that."""
        least, most = (x[:, : len(terms)] for x in self._parts[:2])
        self._product(terms, _SALTS[0], 0, least)
        self._product(terms, _SALTS[1], 2, most)
        # Less by more than what the first unit's lower bound and the rounding leave out.
        np.subtract(np.float32(2.0**32 - 2.0**11), most, out=most)
        least *= most
        return least


def _likely(terms: np.ndarray, limit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of terms and slots whose bound is within the term's limit."""
    bounds = _Bounds()
    for first in range(0, len(terms), _PIECE):
        places, slots = [], []
        for start in range(first, min(first + _PIECE, len(terms)), _CHUNK):
            part = slice(start, start + _CHUNK)
            within = bounds.of(terms[part]) <= limit[part]
            slot, place = np.divmod(np.flatnonzero(within), within.shape[1])
            places.append(place + start)
            slots.append(slot)
        yield np.concatenate(places), np.concatenate(slots)


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """So many numbers from each start on."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def _counted(hashes: np.ndarray, starts: np.ndarray):
    """The distinct values of each row, ascending, how often each occurs, and where each row's
    start.
    """
    ordered = hashes.copy()
    for begin, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        ordered[begin:end].sort()
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    new[starts[:-1][starts[:-1] < len(ordered)]] = True
    first = np.flatnonzero(new)
    return ordered[first], np.diff(first, append=len(ordered)), np.searchsorted(first, starts)


def weighted_terms(data: np.ndarray, starts: np.ndarray):
    """Hashes and weights of the distinct terms of each row, and where each row's terms start."""
    words, at = word_hashes(data, starts)
    many = max(len(words) - RUN + 1, 0)
    with np.errstate(over="ignore"):
        runs = np.full(many, np.uint64(1))
        mixed = mix(words)
        for k in range(RUN):
            runs *= _STEP
            runs += mixed[k : many + k]
        runs = mix(runs)
    counts = np.diff(at)
    inside = np.arange(many) + RUN <= np.repeat(at[1:], counts)[:many]
    runs_at = np.concatenate([[0], np.cumsum(np.maximum(counts - RUN + 1, 0))])
    kinds = (_counted(words, at), WORD_WEIGHT), (_counted(runs[inside], runs_at), 1.0)
    ends = sum(of_rows for (_, _, of_rows), _ in kinds)
    terms, weights = np.empty(ends[-1], np.uint64), np.empty(ends[-1], np.float32)
    begin = ends[:-1]
    for (distinct, often, of_rows), unit in kinds:
        sizes = np.diff(of_rows)
        places = _spread(begin, sizes)
        terms[places] = distinct
        weights[places] = often * np.float32(unit)
        begin = begin + sizes
    return terms, weights, ends


def fingerprints(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One row of SLOTS 16-bit values per text."""
    terms, weights, ends = weighted_terms(data, starts)
    found = np.full((len(starts) - 1, SLOTS), EMPTY, np.uint16)
    some = np.flatnonzero(np.diff(ends))
    if not len(some):
        return found
    begin, sizes = ends[some], np.diff(ends)[some]
    row = np.repeat(np.arange(len(some)), sizes)
    log_weight = np.log(weights)
    sought = LIKELY / np.add.reduceat(weights, begin, dtype=np.float64)

    # A term and its weight together: equal pairs draw alike.
    pair = mix(terms ^ mix(weights.view(np.uint32).astype(np.uint64)))
    order = np.argsort(pair)
    pair = pair[order]
    first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
    counts = np.diff(first, append=len(pair))
    widest = np.maximum.reduceat(sought[row[order]], first)
    own, own_weight = terms[order[first]], weights[order[first]]
    # More by a thousandth, over any rounding.
    limit = (widest * own_weight * (1.001 * 2.0**64)).astype(np.float32)
    log_own, highest = np.log(own_weight), np.log(widest).astype(np.float32)

    best = np.full(len(some) * SLOTS, np.inf, np.float32)
    chosen = np.empty(len(best), np.int64)

    def offer(key: np.ndarray, score: np.ndarray, at: np.ndarray) -> None:
        """Terms for texts' slots: the least value stays, of equal ones the first term."""
        before = best.copy()
        np.minimum.at(best, key, score)
        chosen[best < before] = len(terms)
        least = score == best[key]
        np.minimum.at(chosen, key[least], at[least])

    for place, slot in _likely(own, limit):
        score, _ = _drawn(own[place], slot, log_own[place])
        low = np.flatnonzero(score <= highest[place])
        many = counts[place[low]]
        for start, end in blocks(np.concatenate([[0], np.cumsum(many)]), _OFFERED):
            these, n = low[start:end], many[start:end]
            at = order[_spread(first[place[these]], n)]
            key = row[at] * SLOTS + np.repeat(slot[these], n)
            offer(key, np.repeat(score[these], n), at)
    unsettled = np.flatnonzero(best >= np.repeat(np.log(sought).astype(np.float32), SLOTS))
    text = unsettled // SLOTS
    for start, end in blocks(np.concatenate([[0], np.cumsum(sizes[text])]), _OFFERED):
        mine = text[start:end]
        key = np.repeat(unsettled[start:end], sizes[mine])
        at = _spread(begin[mine], sizes[mine])
        offer(key, _drawn(terms[at], key % SLOTS, log_weight[at])[0], at)

    chosen = chosen.reshape(-1, SLOTS)
    _, t = _drawn(terms[chosen], np.arange(SLOTS), log_weight[chosen])
    kept = mix(terms[chosen] ^ mix(t.astype(np.int64).view(np.uint64)))
    found[some] = (kept % np.uint64(EMPTY)).astype(np.uint16)
    return found


def likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Share of equal slots, row by row: an estimate of the generalised Jaccard similarity."""
    return (one == other).mean(axis=-1)


def _hex(values: np.ndarray) -> list[str]:
    return [row.tobytes().hex() for row in values.astype(">u2")]


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, starts = text_buffers(batch.column(1))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(starts, starts[first] + _BLOCK, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            part = slice(starts[first], starts[last])
            values = fingerprints(data[part], starts[first : last + 1] - starts[first])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, last - first), pa.array(_hex(values))],
                ["doc_id", "fingerprint"],
            )
            first = last


def fingerprint(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of each row's whole ``text``.

    NULL, empty texts and texts of white space have the fingerprint of all ``f``. Equal texts have
    equal fingerprints. No rows give no rows. Other columns are not read.
    """
    session_of(docs)
    return docs.select("doc_id", "text").mapInArrow(
        _fingerprint, "doc_id long, fingerprint string"
    )


def _edited(text: str, following: str) -> str:
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, halo, doc_id, text) in order; the first halo row of a bucket follows its
    last own row.
    """
    from hashlib import sha256

    def emit(ids: list, texts: list[str]) -> pa.RecordBatch:
        """All texts but the last, which only follows."""
        edited = [_edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
        values = fingerprints(*text_buffers(pa.array([*texts, *edited], pa.large_string())))
        plain, changed = values[: len(texts)], values[len(texts) :]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids[:-1], pa.int64()),
                pa.array([len(t) for t in texts[:-1]], pa.int64()),
                pa.array([sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array(_hex(plain[:-1]), pa.string()),
                pa.array(_hex(changed), pa.string()),
                pa.array(likeness(plain[:-1], changed), pa.float64()),
                pa.array(likeness(plain[:-1], plain[1:]), pa.float64()),
            ],
            COLUMNS,
        )

    ids, texts, size, bucket, closed = [], [], 0, None, False
    for batch in batches:
        lists = (batch.column(k).to_pylist() for k in range(4))
        for now, halo, doc_id, text in zip(*lists, strict=True):
            if now != bucket:
                ids, texts, size, bucket, closed = [], [], 0, now, False
            if closed:
                continue
            ids.append(doc_id)
            texts.append(text or "")
            size += len(texts[-1])
            closed = halo
            if len(texts) > 1 and (halo or size > _BLOCK or len(texts) > BATCH_ROWS):
                yield emit(ids, texts)
                ids, texts = ids[-1:], texts[-1:]
                size = len(texts[0])


COLUMNS = [
    "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
    "near_next",
]


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_chars`` (code points), ``edited_sha256``,
    ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The edited text is the text with its last quarter (rounded down) replaced by as many first
    characters of the next row's text, or all of them; the next row is that of the next larger
    ``doc_id`` (NULL first, ties by text), after the last the first; a single row follows itself.
    NULL text counts as empty. Two texts without words are alike (1). No rows give no rows. Other
    columns are not read.

    Rows are dealt into ranges of ``doc_id``, four for each shuffle partition; the smallest row
    of each range also goes to the range before, so every row meets the next one in its own task
    and texts are shuffled once. The driver holds one row per range.
    """
    spark = session_of(docs)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.coalesce("doc_id", F.lit(-(1 << 63)))
    shares = [k / (4 * tasks) for k in range(1, 4 * tasks)]
    cuts = docs.agg(F.percentile_approx(order, shares, 100 * tasks)).first()[0] or []
    cuts = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def bucket(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.to_numpy(), side="right").astype(np.int32))

    placed = docs.select("doc_id", "text", order.alias("key")).withColumn("bucket", bucket("key"))
    heads = placed.groupBy("bucket").agg(F.min("key").alias("head")).orderBy("bucket").collect()
    before = [(h["bucket"], h["head"], heads[k - 1]["bucket"]) for k, h in enumerate(heads)]
    first = spark.createDataFrame(before, "bucket int, head long, before int")
    own = F.struct(F.col("bucket"), F.lit(False).alias("halo"))
    also = F.struct(F.col("before").alias("bucket"), F.lit(True).alias("halo"))
    at_head = F.col("key") == F.col("head")
    dealt = (
        placed.join(F.broadcast(first), "bucket")
        .select(
            "doc_id", "text", "key",
            F.explode(F.when(at_head, F.array(own, also)).otherwise(F.array(own))).alias("at"),
        )
        .select("at.bucket", "at.halo", "doc_id", "text", "key")
        .repartition(tasks, "bucket")
        .sortWithinPartitions("bucket", "halo", "key", "text")
        .drop("key")
    )
    return dealt.mapInArrow(
        _neighbours,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double",
    )
