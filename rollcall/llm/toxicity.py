"""Toxicity of documents, read through obfuscation as through a noisy channel.

What a writer disguises ("1d10t", "i d i o t", "id.iot", "iiidiooot") is a lattice of readings: a
sign is a letter it looks like or no letter, a repeated letter was meant once or twice, a
separator joins or parts. Viterbi decoding takes the reading that a character model (trigrams of
all documents) and the costs of the channel make likeliest. A stretch with a single reading, plain
letters without repeats, is its own restoration and needs no decoding.

The restored words are the evidence. A word speaks for toxicity if the labelled documents that hold
it are toxic far more often than all labelled documents, by a likelihood ratio test that rare words
do not pass; its weight is the difference of the log odds, shrunk toward 0. Weak words have none, as
many of them in a long text or a group of copies would add up to what none of them says, and no word
speaks against toxicity. A document's score is the logistic of the share of toxic documents and the
weights of its distinct words; without any, it is the share of toxic ones among labelled documents
without any. Words of one text and its copies are no independent witnesses: a word
counts only if the toxic documents that hold it differ in the strongest other such word they hold.
Texts are read once for the model and once for their words, in tasks;
what follows are grouped counts and a join of small rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import blocks, session_of, text_buffers
from rollcall.llm.shingles import word_hashes
from rollcall.sources import store

# The letters that a sign can stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t",
}
#: Costs of the channel, in nats: a sign read as a letter, a sign read as none; a repeat of two and
#: of more letters meant fewer times; a separator between single letters and another one ignored.
SIGN, NO_LETTER, DOUBLED, REPEATED, SPACED, JOINED = 0.5, 6.0, 4.0, 0.5, 0.5, 2.0
#: Single letters in a row that may be one spaced word.
CHAIN = 3
#: Weight of the share of all labelled documents in that of a word, in documents.
SHRINK = 1.0
#: Least log odds ratio and least likelihood ratio statistic (a squared number of standard
#: deviations) of a word that counts.
STRONG, SURE = 3.5, 20.0
#: Largest share of a word's toxic documents that may have the same strongest other word.
SAME_COMPANY = 0.8
TOXIC_FROM = 0.3
#: Most words (two or three numbers each) that are sent to all executors; more are joined.
BROADCAST_WORDS = 1_000_000

_SYMBOLS = 59
_BLOCK = 1 << 19
_KNOWN_STRETCHES = 100_000


def _byte_classes() -> tuple[np.ndarray, ...]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    symbol = np.zeros(256, np.uint8)  # 0: no letter, also a word's edge
    symbol[97:123] = symbol[65:91] = np.arange(1, 27)
    symbol[128:] = 27 + (np.arange(128, 256) & 31)
    space, sign, soft = (np.zeros(256, bool) for _ in range(3))
    space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    sign[[ord(c) for c in LOOKS_LIKE]] = True
    soft[[ord(c) for c in "!|+"]] = True  # at a token's end these are punctuation
    return lower, symbol, space, sign, soft


_LOWER, _SYMBOL, _SPACE, _SIGN, _SOFT = _byte_classes()


def _letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to letters: a-z, A-Z and all above ASCII but general punctuation."""
    found = _SYMBOL[data] > 0
    lead = np.flatnonzero(data[:-1] == 0xC2)  # U+0080 to U+00BF
    found[lead], found[lead + 1] = False, False
    lead = np.flatnonzero((data[:-2] == 0xE2) & ((data[1:-1] == 0x80) | (data[1:-1] == 0x81)))
    for k in range(3):  # U+2000 to U+207F
        found[lead + k] = False
    return found


def trigram_counts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How often each three symbols follow each other; a word starts after two edges."""
    symbol = np.where(_letters(data), _SYMBOL[data], 0).astype(np.int64)
    symbol = np.append(np.insert(symbol, starts[:-1], 0), 0)
    kept = np.ones(len(symbol), bool)
    kept[1:] = (symbol[1:] > 0) | (symbol[:-1] > 0)
    symbol = np.concatenate([[0], symbol[kept]])
    two, one, now = symbol[:-2], symbol[1:-1], symbol[2:]
    two = np.where(one > 0, two, 0)
    return np.bincount((two * _SYMBOLS + one) * _SYMBOLS + now, minlength=_SYMBOLS**3)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_SYMBOLS**3, np.int64)
    for batch in batches:
        data, starts = text_buffers(batch.column(0))
        for first, last in blocks(starts, _BLOCK):
            part = data[starts[first] : starts[last]]
            total += trigram_counts(part, starts[first : last + 1] - starts[first])
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "times"])


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probability of a symbol after two others, from the whole ``text`` of all rows.

    Each task leaves at most one row per trigram, of which there are 59^3 (205,379).
    """
    session_of(docs)
    counted = (
        docs.select("text").mapInArrow(_count, "gram long, times long")
        .groupBy("gram").agg(F.sum("times").alias("times"))
    )
    three = np.zeros(_SYMBOLS**3)
    for gram, times in counted.collect():
        three[gram] = times
    three = three.reshape((_SYMBOLS,) * 3)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    share = (one + 1) / (one.sum() + _SYMBOLS)
    after_one = (two + 5 * share) / (two.sum(axis=1, keepdims=True) + 5)
    after_two = (three + 5 * after_one[None]) / (three.sum(axis=2, keepdims=True) + 5)
    return np.log(after_two).astype(np.float32)


class Decoder:
    """The likeliest reading of a stretch of text."""

    def __init__(self, model: np.ndarray):
        self.cost = [-float(x) for x in model.reshape(-1)]
        self.known: dict[bytes, bytes] = {}

    def restore(self, stretch: bytes) -> bytes:
        """The words of a lower-case stretch, parted by blanks."""
        found = self.known.get(stretch)
        if found is None:
            if len(self.known) >= _KNOWN_STRETCHES:
                self.known.clear()
            found = self.known[stretch] = self._viterbi(_lattice(stretch))
        return found

    def _viterbi(self, lattice: list[list[tuple[float, bytes, tuple[int, ...]]]]) -> bytes:
        cost, size = self.cost, _SYMBOLS
        # The state is the last two symbols; a path is a linked list of what was read.
        states = {(0, 0): (0.0, None)}
        for readings in lattice:
            after: dict = {}
            for (two, one), (sofar, path) in states.items():
                for channel, text, symbols in readings:
                    a, b, total = two, one, sofar + channel
                    for symbol in symbols:
                        if symbol or b:  # edges in a row are one
                            total += cost[(a * size + b) * size + symbol]
                            a, b = (b, symbol) if symbol else (0, 0)
                    best = after.get((a, b))
                    if best is None or total < best[0]:
                        after[(a, b)] = (total, (path, text))
            states = after
        ends = [
            (sofar + (cost[(two * size + one) * size] if one else 0.0), path)
            for (two, one), (sofar, path) in states.items()
        ]
        path, parts = min(ends, key=lambda end: end[0])[1], []
        while path:
            path, text = path
            parts.append(text)
        return b" ".join(b"".join(reversed(parts)).split())


def _lattice(stretch: bytes) -> list[list[tuple[float, bytes, tuple[int, ...]]]]:
    """Readings of each unit, a character with its repeats: cost, text and symbols."""
    units, k = [], 0
    while k < len(stretch):
        upto = k + 1
        while upto < len(stretch) and stretch[upto] == stretch[k]:
            upto += 1
        units.append((stretch[k], upto - k))
        k = upto
    filled = [char >= 128 or 97 <= char <= 122 or bool(_SIGN[char]) for char, _ in units]
    lattice = []
    for k, (char, times) in enumerate(units):
        text = bytes([char])
        if char >= 128:
            lattice.append([(0.0, text * times, (int(_SYMBOL[char]),) * times)])
        elif 97 <= char <= 122:
            symbol = (char - 96,)
            if times == 1:
                lattice.append([(0.0, text, symbol)])
            else:
                once = DOUBLED if times == 2 else REPEATED
                twice = 0.0 if times == 2 else REPEATED
                lattice.append([(once, text, symbol), (twice, text * 2, symbol * 2)])
        elif _SIGN[char]:
            letters = LOOKS_LIKE[chr(char)]
            lattice.append(
                [(SIGN, c.encode(), (ord(c) - 96,)) for c in letters]
                + [(NO_LETTER, b" ", (0,))]
            )
        else:
            alone = all(
                not 0 <= j < len(units) or filled[j] and not (0 <= i < len(units) and filled[i])
                for j, i in ((k - 1, k - 2), (k + 1, k + 2))
            )
            lattice.append([(0.0, b" ", (0,)), (SPACED if alone else JOINED, b"", ())])
    return lattice


def _stretches(data: np.ndarray, letter: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Start and end of every stretch with more than one reading, in order: tokens that hold a
    letter and a sign, a separator or a repeat between their ends, and chains of single letters.
    """
    filled = ~_SPACE[data]
    first = filled.copy()
    first[1:] &= ~filled[:-1]
    inner = starts[:-1][starts[:-1] < len(data)] if len(data) else starts[:0]
    first[inner] = filled[inner]
    token = np.flatnonzero(first)
    if not len(token):
        return np.zeros((0, 2), np.int64)
    place = np.arange(len(data))
    sign = _SIGN[data]
    begin = np.minimum.reduceat(np.where(letter | sign, place, len(data)), token)
    end = np.maximum.reduceat(np.where(letter | (sign & ~_SOFT[data]), place, -1), token)
    # Bytes after a token up to the next one are blanks, which are neither letter nor sign.
    plain = letter & (data < 128)
    repeat = np.zeros(len(data), bool)
    repeat[1:] = plain[1:] & (data[1:] == data[:-1]) & ~first[1:]
    odd = np.concatenate([[0], np.cumsum((filled & ~letter) | repeat)])
    letters = np.concatenate([[0], np.cumsum(letter)])
    core = begin <= end
    from_, to = np.where(core, begin, 0), np.where(core, end + 1, 0)
    disguised = core & (odd[to] > odd[from_]) & (letters[to] > letters[from_])
    single = core & (to - from_ == 1)
    row = np.searchsorted(starts, token, side="right")
    runs = np.flatnonzero(np.concatenate([[True], (single[1:] != single[:-1])
                                          | (row[1:] != row[:-1])]))
    length = np.diff(np.append(runs, len(token)))
    chains = single[runs] & (length >= CHAIN)
    chains &= np.add.reduceat((letters[to] > letters[from_]).astype(np.int64), runs) > 0
    head, tail = runs[chains], runs[chains] + length[chains] - 1
    found = np.concatenate([
        np.stack([from_[disguised], to[disguised]], axis=1),
        np.stack([from_[head], to[tail]], axis=1),
    ])
    return found[np.argsort(found[:, 0], kind="stable")]


def restored(
    data: np.ndarray, starts: np.ndarray, decoder: Decoder
) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of the restored words of each row, parted by blanks, and where the rows start."""
    if not len(data):
        return data, starts
    letter, low = _letters(data), _LOWER[data]
    plain = np.where(letter, low, 32).astype(np.uint8)
    low = np.where(letter | (data < 128), low, 32).astype(np.uint8).tobytes()
    found = _stretches(data, letter, starts)
    parts, longer, before = [], [], 0
    for begin, end in found.tolist():
        text = decoder.restore(low[begin:end])
        parts += [plain[before:begin].tobytes(), text]
        longer.append(len(text) - (end - begin))
        before = end
    parts.append(plain[before:].tobytes())
    shift = np.concatenate([[0], np.cumsum(np.array(longer, np.int64))])
    return (
        np.frombuffer(b"".join(parts), np.uint8),
        starts + shift[np.searchsorted(found[:, 0], starts, side="left")],
    )


def restore_texts(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """``doc_id`` and ``restored``, the words of ``text`` with disguises read as what they stand
    for, lower-case and parted by blanks; NULL and texts without letters give an empty text.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        for batch in batches:
            data, starts = restored(*text_buffers(batch.column(1)), decoder)
            texts = [b" ".join(data[a:b].tobytes().split()).decode("utf-8", "replace")
                     for a, b in zip(starts[:-1], starts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string())], ["doc_id", "restored"]
            )

    session_of(docs)
    return docs.select("doc_id", "text").mapInArrow(read, "doc_id long, restored string")


def _words(model: np.ndarray):
    """Rows (row, doc_id, text) to (row, doc_id, words): the distinct restored words, hashed."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(model)
        for batch in batches:
            data, starts = text_buffers(batch.column(2))
            for first, last in blocks(starts, _BLOCK):
                part = data[starts[first] : starts[last]]
                part, at = restored(part, starts[first : last + 1] - starts[first], decoder)
                hashes, at = word_hashes(part, at)
                row = np.repeat(np.arange(last - first, dtype=np.uint64), np.diff(at))
                pairs = np.unique(row << np.uint64(32) | hashes >> np.uint64(32))
                ends = np.searchsorted(pairs, np.arange(last - first + 1, dtype=np.uint64)
                                       << np.uint64(32))
                words = pairs.astype(np.uint32).view(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(1).slice(first, last - first),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(words)),
                    ],
                    ["row", "doc_id", "words"],
                )

    return read


def _small(words: DataFrame) -> DataFrame:
    """A stored table of words, broadcast if its rows are few enough for every task to hold."""
    return F.broadcast(words) if words.count() <= BROADCAST_WORDS else words


def _strong_words(marked: DataFrame, share: float, prior: float) -> DataFrame:
    """``word``, ``evidence``, ``ratio`` of the words that pass the tests of strength."""
    with_, without = F.col("toxic") + SHRINK * share, F.col("clean") + SHRINK * (1 - share)
    rows, odds = F.col("toxic") + F.col("clean"), F.log(with_ / without) - prior

    def surprise(times: Column, expected: float) -> Column:
        return F.when(times > 0, times * F.log(times / (rows * expected))).otherwise(0.0)

    ratio = 2 * (surprise(F.col("toxic"), share) + surprise(F.col("clean"), 1 - share))
    return (
        marked.select(F.explode("words").alias("word"), "toxic")
        .groupBy("word")
        .agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))
        .select("word", odds.alias("evidence"), ratio.alias("ratio"))
        .filter((F.col("evidence") >= STRONG) & (F.col("ratio") >= SURE))
    )


def _evidence(marked: DataFrame) -> tuple[DataFrame, float]:
    """``word``, ``evidence`` of the words that count, from ``row``, ``words``, ``toxic`` (0 or 1),
    and the log odds of toxicity of all rows.
    """
    toxic, rows = marked.agg(F.sum("toxic"), F.count("*")).first()
    share = ((toxic or 0) + 0.1) / (rows + 1)
    prior = float(np.log(share / (1 - share)))
    strong = store(_strong_words(marked, share, prior), "toxic_words")
    held = store(
        marked.filter("toxic = 1").select("row", F.explode("words").alias("word"))
        .join(_small(strong.select("word", "ratio")), "word"),
        "toxic_held",
    )
    # The two strongest of a document; without another one, the document is company of its own.
    order = F.struct("ratio", "word")
    best = held.groupBy("row").agg(F.max(order).alias("best"))
    second = (
        held.join(best, "row").filter(F.col("word") != F.col("best.word"))
        .groupBy("row").agg(F.max(order).alias("second"))
    )
    pairs = held.select("row", "word").join(store(best, "toxic_best"), "row").join(
        store(second, "toxic_second"), "row", "left"
    )
    other = F.when(F.col("word") == F.col("best.word"), F.col("second.word")).otherwise(
        F.col("best.word")
    ).cast("long")
    alike = (
        pairs.select("word", F.coalesce(other, F.col("row") + 2**32).alias("other"))
        .groupBy("word", "other").agg(F.count("*").alias("times"))
        .groupBy("word").agg((F.max("times") / F.sum("times")).alias("same"))
        .filter((F.col("same") <= SAME_COMPANY))
    )
    counted = strong.join(alike, "word").select("word", "evidence")
    return store(counted, "toxic_evidence"), prior


def held_out() -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``held_out``, ``score`` (0
    to 1, higher if toxicity is likelier) and ``predicted`` (1 from a score of 0.3).

    ``labels`` (``doc_id``, ``toxic``) of documents that are not held out are learned from; values
    other than 0 and 1 say nothing, and a document labelled more than once is toxic if any label
    says so. NULL, empty texts and texts without a word that counts have the share of toxic
    documents among labelled ones without any (a tenth without labels). Rows of equal ``doc_id`` are
    judged each by its own text; a NULL ``doc_id`` has no label. Whole texts count, of any length;
    a token is decoded as a whole. No rows give no rows; other columns are not read.

    Words are told apart by 32 bits of a hash: a document meets the weight of another word with a
    probability of its distinct words times the weighted ones in 2^32.
    """
    session_of(docs)
    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), "text")
    words = _words(character_model(docs))
    read = store(rows.mapInArrow(words, "row long, doc_id long, words array<int>"), "toxic_read")
    known = (
        labels.filter(F.col("toxic").isin(0, 1))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("long").alias("toxic"))
        .filter(~held_out())
    )
    # Merged at any size: labels grow with the documents.
    marked = read.join(known.hint("merge"), "doc_id").select("row", "words", "toxic")
    marked = store(marked, "toxic_marked")
    evidence, prior = _evidence(marked)
    found = (
        read.select("row", F.explode("words").alias("word"))
        .join(_small(evidence), "word")
        .groupBy("row")
        .agg(F.sum("evidence").alias("evidence"))
    )
    found = store(found, "toxic_found")
    plain = marked.select("row", "toxic").join(found, "row", "left_anti")
    toxic, labelled = plain.agg(F.sum("toxic"), F.count("*")).first()
    score = F.coalesce(
        1 / (1 + F.exp(-(F.col("evidence") + prior))), F.lit(((toxic or 0) + 0.1) / (labelled + 1))
    )
    return (
        read.select("row", "doc_id")
        .join(found, "row", "left")
        .select("doc_id", held_out().alias("held_out"), score.alias("score"),
                (score >= TOXIC_FROM).cast("int").alias("predicted"))
    )
