"""Byte n-gram tables within words, and counting 64-bit keys in bounded memory.

A word is a string of UTF-8 bytes with spaces before it and one space, its end, after
it; spaces never occur inside. A context is the up to four bytes before a byte, so the
probability of a word is a product over its bytes and its end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from chartdex.llm.words import Words, bytes_of

ORDER = 5
_SPACE = 0x20


def word_grams(w: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed ``ORDER``-byte grams of chosen words, one per byte and end, and where each word's begin."""
    data, begin = bytes_of(w, which)
    size = np.diff(begin)
    place = begin[:-1] + np.arange(len(size)) * ORDER  # each word has ORDER - 1 spaces before it and one after
    flat = np.full(len(data) + ORDER * len(size), _SPACE, dtype=np.int64)
    flat[np.arange(len(data)) + np.repeat(place - begin[:-1] + ORDER - 1, size)] = data
    codes = flat[: len(flat) - ORDER + 1].copy()
    for k in range(1, ORDER):
        codes <<= 8
        codes |= flat[k : len(flat) - ORDER + 1 + k]
    first = begin[:-1] + np.arange(len(size))  # word i has size[i] + 1 grams
    index = np.arange(first[-1] + size[-1] + 1 if len(size) else 0) + np.repeat(place - first, size + 1)
    return codes[index], first


def suffix(codes: np.ndarray, k: int) -> np.ndarray:
    """The last k bytes of packed grams."""
    return codes & ((1 << (8 * k)) - 1)


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, sorted, with their counts (rows) added up."""
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
    return codes[first], np.add.reduceat(counts, first, axis=0) if len(codes) else counts


class KeyCounter:
    """Adds up count rows by key; hands over what it holds when that grows large."""

    def __init__(self, columns: int, limit: int = 1 << 21):
        self.columns, self.limit = columns, limit
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)
        if self.held < self.limit:
            return None
        keys, counts = self.take()
        if len(keys) > self.limit // 2:
            return keys, counts
        self.keys, self.counts, self.held = [keys], [counts], len(keys)
        return None

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.int64), np.zeros((0, self.columns), np.int64)
        out = summed(np.concatenate(self.keys), np.concatenate(self.counts))
        self.keys, self.counts, self.held = [], [], 0
        return out


@dataclass
class Level:
    """Order k: sorted grams with their interpolated probability, sorted contexts with what they pass on."""

    grams: np.ndarray
    prob: np.ndarray
    contexts: np.ndarray
    passed: np.ndarray


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of each key in a sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def probability(levels: list[Level], codes: np.ndarray, k: int | None = None) -> np.ndarray:
    """Interpolated probability of the last byte of each gram; ``levels[k - 1]`` is order k."""
    k = len(levels) if k is None else k
    if k == 0:
        return np.full(len(codes), 1 / 256)
    level, codes = levels[k - 1], suffix(codes, k)
    at, there = find(level.grams, codes)
    if not len(level.grams):
        return probability(levels, codes, k - 1)
    out = level.prob[at]
    if not there.all():
        rest = codes[~there]
        spot, known = find(level.contexts, rest >> 8)
        passed = np.where(known, level.passed[spot], 1.0) if len(level.contexts) else 1.0
        out = out.copy()
        out[~there] = passed * probability(levels, rest, k - 1)
    return out
