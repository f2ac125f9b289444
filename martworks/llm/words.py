"""Words of whole texts and their 64-bit hashes, by numpy over UTF-8 bytes.

A word is a run of bytes other than space and \\t..\\r; A-Z count as a-z. The hash of a
word is a polynomial over its bytes modulo 2^64, taken from prefix sums, then mixed.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_table(base: int, n: int) -> np.ndarray:
    table = np.ones(n, np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        table[done : done + step] = table[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return table


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        _powers[:] = [_power_table(_BASE, size), _power_table(_INVERSE, size)]
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finisher that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def lowered(data: np.ndarray) -> np.ndarray:
    low = data.copy()
    low[(data - np.uint8(65)) < 26] += np.uint8(32)
    return low


def word_bounds(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of the words, and the index of each row's first word (n + 1)."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    gap = (data == 32) | ((data - np.uint8(9)) < 5)
    opens, closes = np.empty(n, bool), np.empty(n, bool)
    opens[0], opens[1:] = True, gap[:-1]
    closes[-1], closes[:-1] = True, gap[1:]
    filled = offsets[:-1] < offsets[1:]
    opens[offsets[:-1][filled]] = True
    closes[offsets[1:][filled] - 1] = True
    starts = np.flatnonzero(opens & ~gap)
    ends = np.flatnonzero(closes & ~gap) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = powers(len(low) + 1)
    sums = np.zeros(len(low) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[: len(low)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """(hash of each word, index of each row's first word, starts, ends, lowered bytes)."""
    starts, ends, first = word_bounds(data, offsets)
    low = lowered(data)
    return span_hashes(low, starts, ends), first, starts, ends, low
