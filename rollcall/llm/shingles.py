"""Sets of hashed word shingles, computed for many texts at once from their UTF-8 bytes."""

from __future__ import annotations

import numpy as np

from rollcall.llm.common import mix, pieces

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_NEAR = 64
#: Hash of a byte at each of the first places of a word; a word's hash is their sum, mixed.
_PLACED = mix(np.arange(_NEAR * 256, dtype=np.uint64))
_STEP = np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, and where each
    row's words start among them (one entry more than rows).
    """
    rows = len(starts) - 1
    filled = ~_SPACE[data]
    first = filled.copy()
    first[1:] &= ~filled[:-1]
    inner = starts[:-1][starts[:-1] < len(data)] if len(data) else starts[:0]
    first[inner] = filled[inner]
    at = np.flatnonzero(first)
    counts = np.bincount(np.searchsorted(starts, at, side="right") - 1, minlength=rows)
    ends = np.concatenate([[0], np.cumsum(counts)])
    if not len(at):
        return np.zeros(0, np.uint64), ends
    letters = _LOWER[data[filled]].astype(np.int64)
    begin = np.concatenate([np.flatnonzero(first[filled]), [len(letters)]])
    place = pieces(begin)
    if place.max() < _NEAR:
        placed = _PLACED[place * 256 + letters]
    else:
        placed = mix((place * 256 + letters).astype(np.uint64))
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(placed, begin[:-1])
        return mix(sums + np.diff(begin).astype(np.uint64)), ends


def shingle_sets(
    data: np.ndarray, starts: np.ndarray, size: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row, ascending, and where each row's set starts.

    A row of fewer than ``size`` words has one shingle, all its words; one without words none.
    """
    words, at = word_hashes(data, starts)
    counts = np.diff(at)
    with np.errstate(over="ignore"):
        full = np.full(max(len(words) - size + 1, 0), np.uint64(size))
        for k in range(size):
            full = full * _STEP + mix(words[k : len(words) - size + 1 + k])
        full = mix(full)
        sets = []
        for row, n in enumerate(counts):
            if n >= size:
                found = np.sort(full[at[row] : at[row] + n - size + 1])
                if n > size:
                    found = found[np.concatenate([[True], found[1:] != found[:-1]])]
            elif n:
                short = np.full(1, np.uint64(n))
                for word in words[at[row] : at[row + 1]]:
                    short = short * _STEP + mix(np.array([word]))
                found = mix(short)
            else:
                found = full[:0]
            sets.append(found)
    sizes = np.array([len(s) for s in sets], np.int64)
    joined = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return joined, np.concatenate([[0], np.cumsum(sizes)])


def set_keys(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys per set that depend on all its members, 0 for empty sets."""
    sizes = np.diff(starts)
    keys = [np.zeros(len(sizes), np.uint64) for _ in range(2)]
    some = np.flatnonzero(sizes)
    if len(some):
        with np.errstate(over="ignore"):
            for key, salt in zip(keys, (1, 2), strict=True):
                salted = mix(hashes + mix(np.array([salt], np.uint64)))
                key[some] = np.add.reduceat(salted, starts[:-1][some])
    return keys[0], keys[1]


def super_minhash(hashes: np.ndarray, starts: np.ndarray, slots: int) -> np.ndarray:
    """SuperMinHash signature of each set, ``slots`` 64-bit values; of empty sets all ones.

    In round j every element offers j plus a fraction at the j-th place of its own random
    permutation of the slots, so a slot's value is settled once it is below the next round's
    offers. A set of many elements settles all slots in a round or two and leaves.
    """
    rows = len(starts) - 1
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    signature = np.full((rows, slots), empty)
    flat = signature.reshape(-1)
    row = np.repeat(np.arange(rows), np.diff(starts))
    element, picks = hashes, []
    for j in range(slots):
        if not len(element):
            break
        drawn = mix(element ^ mix(np.array([j + 1], np.uint64)))
        pick = (drawn & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j) >> np.uint64(32)
        pick = (pick + np.uint64(j)).astype(np.int16)
        # Place j of a shuffle by swaps: an earlier swap at t with this place moved t's value here.
        slot = pick.copy()
        for t in range(j - 1, -1, -1):
            np.putmask(slot, slot == picks[t], t)
        picks.append(pick)
        offer = np.uint64(j) << np.uint64(32) | drawn >> np.uint64(32)
        np.minimum.at(flat, row * slots + slot, offer)
        live = row[np.concatenate([[True], row[1:] != row[:-1]])]
        open_rows = np.zeros(rows, bool)
        open_rows[live] = (signature[live] >> np.uint64(32)).max(axis=1) > j
        open_ = open_rows[row]
        if not open_.all():
            element, row = element[open_], row[open_]
            picks = [p[open_] for p in picks]
    return signature


def band_hashes(signature: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash per ``width`` neighbouring slots, different for each band."""
    rows, slots = signature.shape
    parts = signature.reshape(rows, slots // width, width)
    with np.errstate(over="ignore"):
        hashed = np.broadcast_to(np.arange(slots // width, dtype=np.uint64), parts.shape[:2])
        for k in range(width):
            hashed = mix(hashed * _STEP + parts[:, :, k])
    return hashed
