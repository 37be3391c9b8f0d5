"""Byte-level BPE: exact merges without merging, and decoding from an offset table.

Encoding walks a piece of text with the longest token at each place (an Aho-Corasick automaton
over all tokens) and keeps a token only if it is compatible with the one before: two neighbouring
tokens are compatible if merging their bytes by rank would leave just these two. A sequence of
tokens of which all neighbours are compatible is the one that merging gives, so where the longest
token doesn't fit, the next shorter one is tried, and a place that no token leads on from is
marked, given up and never tried again; the work is linear in the length of the piece.

Compatibility follows from the merge tables alone. Only the right edge of the first token and the
left edge of the second matter: the pieces on either side of the boundary, from single bytes up to
the whole tokens, each of which lasts until the merge that takes it in. Results are remembered in a
table of pairs, as are the ids of frequent pieces.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import blocks, session_of

# Fixed value: how a text is cut into pieces, with white space as Unicode defines it.
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Entries of each table of a Python worker; a full one starts anew.
REMEMBERED = 300_000
_LONGEST = 48
_BLOCK = 1 << 20
_NEVER = 1 << 60


def byte_of_sign() -> dict[str, int]:
    """The visible character that stands for each byte in a byte-level vocabulary: printable ones
    (0x21-0x7E, 0xA1-0xFF without 0xAD) for themselves, the others from U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(other)}


class ByteBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        byte, vocabulary = byte_of_sign(), content["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        size = max([*vocabulary.values(), *self.special.values()]) + 1
        self.tokens = [b""] * size
        for sign, id_ in vocabulary.items():
            self.tokens[id_] = bytes(byte[c] for c in sign)
        #: Rank of a merge by its two tokens; the merge that makes a token, or None for a byte.
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[tuple[int, int, int] | None] = [None] * size
        for rank, merge in enumerate(content["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair = vocabulary[left], vocabulary[right]
            self.rank[pair] = rank
            self.made[vocabulary[left + right]] = (*pair, rank)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for id_, token in enumerate(self.tokens):
            made = self.made[id_]
            if token and (made is None or self._compatible(made[0], made[1], made[2])):
                self.automaton.add_word(token.decode("latin-1"), id_)
        #: The longest shorter token that a token starts with, -1 for single bytes.
        self.shorter = [-1] * size
        for text, id_ in self.automaton.items():
            for n in range(len(text) - 1, 0, -1):
                if (start := self.automaton.get(text[:n], None)) is not None:
                    self.shorter[id_] = start
                    break
        self.automaton.make_automaton()
        for text, id_ in self.special.items():
            self.tokens[id_] = text.encode()
        lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.lengths, self.starts = lengths, np.cumsum(lengths) - lengths
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.pattern = regex.compile(PIECES)
        self.unsafe = regex.compile(r"\p{White_Space} |[\x1c-\x1f]")
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.known_pieces: dict[str, bytes] = {}
        self.known_words: dict[str, bytes] = {}

    def _compatible(self, one: int, two: int, limit: int = _NEVER) -> bool:
        """Whether no merge across the boundary comes before rank ``limit`` and before the merges
        that take in the pieces at the boundary. Of equal ranks the merge further left is first.
        """
        left, until_left = one, limit
        while True:
            right, until_right = two, limit
            while True:
                rank = self.rank.get((left, right), _NEVER)
                if rank < until_left and rank <= until_right and rank < limit:
                    return False
                if (made := self.made[right]) is None:
                    break
                right, until_right = made[0], made[2]
            if (made := self.made[left]) is None:
                return True
            left, until_left = made[1], made[2]

    def _merge_free(self, text: str) -> list[int]:
        """Ids of one piece, given as one character per byte."""
        end, found, place, dead = len(text), [], 0, set()
        pairs, longest = self.pairs, self.automaton.iter_long
        token = next(longest(text))[1]
        while True:
            after = place + len(self.tokens[token])
            fits = after not in dead
            if fits and found:
                pair = found[-1], token
                fits = pairs.get(pair)
                if fits is None:
                    if len(pairs) > REMEMBERED:
                        pairs.clear()
                    fits = pairs[pair] = self._compatible(*pair)
            if fits:
                found.append(token)
                place = after
                if place == end:
                    return found
                token = next(longest(text, place))[1]
            elif self.shorter[token] >= 0:
                token = self.shorter[token]
            else:
                dead.add(place)
                token = found.pop()
                place -= len(self.tokens[token])

    def _piece(self, piece: str) -> bytes:
        if (ids := self.known_pieces.get(piece)) is None:
            signs = piece.encode().decode("latin-1")
            ids = np.array(self._merge_free(signs), "<i4").tobytes()
            if len(piece) <= _LONGEST:
                if len(self.known_pieces) > REMEMBERED:
                    self.known_pieces.clear()
                self.known_pieces[piece] = ids
        return ids

    def _plain(self, text: str) -> list[bytes]:
        """A text without control strings. Where a space never follows white space, a piece
        never reaches across the place before a space, and the words between are remembered.
        """
        if self.unsafe.search(text):
            return [self._piece(p) for p in self.pattern.findall(text)]
        first, *words = text.split(" ")
        head = [self._piece(p) for p in self.pattern.findall(first)]
        if len(self.known_words) > REMEMBERED:
            self.known_words.clear()
        known = self.known_words
        ids = list(map(known.get, words))
        if None in ids:
            for k, word in enumerate(words):
                if ids[k] is None:
                    found = known.get(word)
                    if found is None:
                        parts = self.pattern.findall(" " + word)
                        found = b"".join([self._piece(p) for p in parts])
                        if len(word) <= _LONGEST:
                            known[word] = found
                    ids[k] = found
        return head + ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        parts = self.cut.split(text) if self.special and "<|" in text else [text]
        found = []
        for part in parts:
            if part in self.special:
                found.append(np.array([self.special[part]], "<i4").tobytes())
            elif part:
                found += self._plain(part)
        return b"".join(found)

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[str]:
        """The texts of rows of ids; what is no UTF-8 becomes replacement characters."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ids) else 0
        at = np.arange(total) + np.repeat(self.starts[ids] - ends + lengths, lengths)
        data = self.blob[at].tobytes()
        places = np.concatenate([[0], ends])[starts]
        spans = zip(places[:-1], places[1:], strict=True)
        return [data[a:b].decode("utf-8", "replace") for a, b in spans]


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """The worker's tables for a file; they last as long as the worker."""
    return ByteBpe(path)


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id`` and ``ids`` (``array<int>``) of each row's whole ``text``.

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers library, the same on all
    executors; control strings of the file in a text become their own ids. NULL and empty texts
    have no ids. No rows give no rows. Other columns are not read.
    """
    session_of(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer)
        for batch in batches:
            texts = batch.column(1)
            found = [bpe.encode(texts[k].as_py() or "") for k in range(len(texts))]
            ends = np.concatenate([[0], np.cumsum([len(f) // 4 for f in found])]).astype(np.int32)
            ids = pa.array(np.frombuffer(b"".join(found), "<i4"), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), ids)], ["doc_id", "ids"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``encoded`` (``doc_id``, ``ids``) with ``text``; NULL ids are none."""
    session_of(encoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer)
        for batch in batches:
            lists = batch.column(1)
            if lists.null_count:
                lists = lists.fill_null([])
            starts = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.to_numpy()
            texts = []
            for first, last in blocks(starts, _BLOCK // 4):
                ids = values[starts[first] : starts[last]]
                texts += bpe.decode(ids, starts[first : last + 1] - starts[first])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(
        run, "doc_id long, ids array<int>, text string"
    )


def digest(decoded: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` (ids joined by commas), ``decoded_sha256``."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
