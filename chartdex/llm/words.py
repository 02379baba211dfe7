"""Words of UTF-8 texts as numpy arrays, for the operators that run Python in tasks.

Everything works on the bytes of many texts at once, in chunks of bounded size, so no
Python object is made per word. Separators and A-Z are ASCII, which UTF-8 keeps apart
from all other characters; a text longer than a chunk is cut between two words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes handled at once; the arrays made for them take about 60 times as much.
CHUNK = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: tuple[np.ndarray, np.ndarray] | None = None


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if _powers is None or len(_powers[0]) < n:
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.cumprod(steps))
        _powers = tables[0], tables[1]
    return _powers


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of one chunk: text number, 64-bit hash, and their bytes in ``data[start:end]``."""

    text: np.ndarray
    hash: np.ndarray
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray


def _find(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the words in ``data``; ``breaks``: where texts begin."""
    inside = ~_IS_SPACE[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    breaks = breaks[(breaks > 0) & (breaks < len(data))]
    starts[breaks] = inside[breaks]
    ends[breaks - 1] = inside[breaks - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial of the bytes of each word modulo 2**64, with its length, spread."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    raw = (sums[end] - sums[start]) * down[start]
    return mix64(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words_of(texts: pa.Array, lower: bool, chunk: int = CHUNK) -> Iterator[Words]:
    """The words of a string array (null: none), in chunks and in order."""
    texts = texts.cast(pa.large_string())
    if len(texts) == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if texts.null_count:  # a null may cover bytes
        texts = texts.fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if offsets[-1] == offsets[0]:
        return
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + chunk, "right")) - 1
        if last > first:
            yield from _words_between(data, offsets, first, last, int(offsets[first]), int(offsets[last]), lower)
            first = last
            continue
        at, stop = int(offsets[first]), int(offsets[first + 1])  # one text over the chunk size
        while at < stop:
            to = min(stop, at + chunk)
            while to < stop:  # go on to the end of a word
                gap = np.flatnonzero(_IS_SPACE[data[to : min(stop, to + chunk)]])
                if len(gap):
                    to += int(gap[0])
                    break
                to = min(stop, to + chunk)
            yield from _words_between(data, offsets, first, first + 1, at, to, lower)
            at = to
        first += 1


def _words_between(data, offsets, first, last, at, to, lower) -> Iterator[Words]:
    part = data[at:to]
    if lower:
        part = _LOWER[part]
    begins = offsets[first:last] - at
    start, end = _find(part, begins)
    if len(start):
        text = np.searchsorted(begins, start, "right") - 1 + first
        yield Words(text, _hashes(part, start, end), part, start, end)


def words_by_text(texts: pa.Array, lower: bool) -> Iterator[tuple[int, np.ndarray]]:
    """(text number, word hashes in order) for every text that has words."""
    number, parts = -1, []
    for w in words_of(texts, lower):
        cuts = np.flatnonzero(np.diff(w.text)) + 1
        for own, hashes in zip(w.text[np.r_[0, cuts]], np.split(w.hash, cuts)):
            if own != number:
                if parts:
                    yield number, parts[0] if len(parts) == 1 else np.concatenate(parts)
                number, parts = int(own), []
            parts.append(hashes)
    if parts:
        yield number, parts[0] if len(parts) == 1 else np.concatenate(parts)


def bytes_of(w: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of chosen words one after the other, and where each of them begins."""
    size = w.end[which] - w.start[which]
    begin = np.r_[0, np.cumsum(size)]
    index = np.arange(begin[-1]) - np.repeat(begin[:-1] - w.start[which], size)
    return w.data[index], begin
