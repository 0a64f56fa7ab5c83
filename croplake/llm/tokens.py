"""Words and shingles of a whole Arrow batch at a time, as 64-bit hashes, without a Python loop over words.

Byte ``c`` at place ``j`` counts ``value[c] * base**j`` modulo 2**64; the hash of a word is the difference of two
running sums, shifted back to place 0 and mixed. Values are random 64-bit numbers, so that equal hashes of
different words are a matter of chance alone (about 2**-60 a pair).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text bytes handled at once; a longer text is handled alone.
SLICE_BYTES = 1 << 18

_random = np.random.default_rng(913_071)
_BASE = int(_random.integers(1 << 62, dtype=np.uint64)) * 2 + 1
_BACK = pow(_BASE, -1, 1 << 64)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)[_LOWER]
_PLACES = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: White space is the six ASCII characters; for ``LETTERS`` all ASCII but letters and digits separates.
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LETTERS = np.zeros(256, bool)
LETTERS[:128] = True
LETTERS[48:58] = LETTERS[65:91] = LETTERS[97:123] = False


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for k, base in enumerate((_BASE, _BACK)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, starts of the rows and the end, UTF-8 bytes) for runs of rows of a string array without nulls."""
    wide = pa.types.is_large_string(texts.type)
    starts = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + SLICE_BYTES, "right")) - 1)
        yield first, starts[first : last + 1] - starts[first], data[starts[first] : starts[last]]
        first = last


def words(starts: np.ndarray, data: np.ndarray, apart: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """(row of each word, its hash), in text order; A-Z count as a-z."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = ~apart[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    begin = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
    end = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False]))))
    up, down = _power(len(data))
    total = np.cumsum(_VALUES[data] * up, dtype=np.uint64)
    before = np.where(begin > 0, total[begin - 1], np.uint64(0))
    raw = (total[end] - before) * down[begin]
    return np.searchsorted(starts, begin, "right") - 1, mix(raw + (end - begin).astype(np.uint64) * _PLACES[63])


def grams(rows: np.ndarray, hashes: np.ndarray, offsets: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every word taken with those ``offsets`` words on, within one row; order counts."""
    n = len(rows) - offsets[-1]
    if n <= 0:
        return rows[:0], hashes[:0]
    out = np.zeros(n, np.uint64)
    for at in offsets:
        out += hashes[at : at + n] * _PLACES[at]
    same = rows[:n] == rows[offsets[-1] :]
    return rows[:n][same], mix(out[same] + _PLACES[40 + len(offsets)])


def shingles(starts: np.ndarray, data: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """For each row the ordered array of its distinct shingles of ``k`` words; of fewer words, the one of them all."""
    count = len(starts) - 1
    rows, hashes = words(starts, data)
    at, of = grams(rows, hashes, tuple(range(k)))
    ends = np.searchsorted(at, np.arange(count + 1))
    bounds = np.searchsorted(rows, np.arange(count + 1))
    for i in range(count):
        n = bounds[i + 1] - bounds[i]
        if n >= k:
            found = np.sort(of[ends[i] : ends[i + 1]])
            yield found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif n:
            yield grams(rows[bounds[i] : bounds[i + 1]], hashes[bounds[i] : bounds[i + 1]], tuple(range(n)))[1]
        else:
            yield hashes[:0]


def sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """:func:`shingles` of each row of a batch."""
    for _, starts, data in slices(texts):
        yield from shingles(starts, data, k)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
