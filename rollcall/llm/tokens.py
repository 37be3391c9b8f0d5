"""Token ids of many texts from a word-level BPE file, each word encoded once while remembered.

Words between spaces are encoded independently of each other by such a tokenizer (its normaliser
and pre-tokenizer never look across white space), so a task remembers the ids of words and only
new ones reach the tokenizers library. Texts that may hold a control string go there whole.
"""

from __future__ import annotations

import os
from codecs import charmap_decode
from functools import lru_cache
from struct import Struct

import numpy as np

#: Words remembered per Python worker; beyond that it starts anew.
REMEMBERED = 400_000
_LONGEST = 48
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_PACKED = [Struct(f"<{n}I") for n in range(65)]


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.model = self.whole.model
        self.known: dict[str, bytes] = {"": b""}
        self.visible = self._mapped(bytes(range(0x100)))

    @staticmethod
    def _mapped(data: bytes) -> str:
        """Bytes as the visible characters that stand for them in a byte-level vocabulary: those
        from 0xA1 on, without 0xAD, for themselves, other high bytes from U+0100 on, after 33
        control and blank ones. Below 0x7F, only those of letters are asked for.
        """
        high = [b for b in range(0x7F, 0xA1)] + [0xAD]
        return "".join(chr(b) if b not in high else chr(0x100 + 33 + high.index(b)) for b in data)

    def _encode(self, word: str, simple: bool) -> bytes:
        if simple and word.isalpha():  # one piece of plain letters: only the merges are left
            if not word.isascii():
                word = charmap_decode(word.encode(), "strict", self.visible)[0]
            ids = [token.id for token in self.model.tokenize(word)]
        else:
            ids = self.whole.encode(word, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes() if len(ids) > 64 else _PACKED[len(ids)].pack(*ids)

    def _learn(self, word: str, simple: bool) -> bytes:
        known = self.known
        base = word.rstrip(_PUNCTUATION) if simple else word
        if base != word and base.isalpha():  # letters, then other signs: two pieces
            end = word[len(base) :]
            if (ids := known.get(end)) is None:
                ids = self._learn(end, simple)
            if (first := known.get(base)) is None:
                return self._learn(base, simple) + ids
            ids = first + ids  # letters met before: this form of them is likely to come again
            if len(word) <= _LONGEST:
                known[word] = ids
            return ids
        ids = self._encode(word, simple)
        if len(word) <= _LONGEST:
            known[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        if "<|" in text:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        try:
            text.encode("latin-1")
            simple = True  # in this range lower-casing is by character and nothing is composed
            text = text.lower()
        except UnicodeEncodeError:
            simple = False
        if len(self.known) > REMEMBERED:
            self.known = {"": b""}
        words = text.replace("\n", " ").replace("\r", " ").replace("\t", " ").split(" ")
        found = list(map(self.known.get, words))
        if None in found:
            learn = self._learn
            pairs = zip(words, found, strict=True)
            found = [learn(word, simple) if ids is None else ids for word, ids in pairs]
        return b"".join(found)


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder for a file; what it remembers lasts as long as the worker."""
    return WordEncoder(path)
