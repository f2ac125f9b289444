"""Hashed character n-grams of whole texts, by numpy over code points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK_CHARS = 1 << 19
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def text_chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``limit`` characters each, one text at least."""
    at, n = 0, 0
    for i, text in enumerate(texts):
        if i > at and n + len(text) > limit:
            yield at, i
            at, n = i, 0
        n += len(text)
    if at < len(texts):
        yield at, len(texts)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points in a row, and the offsets of the texts (n + 1)."""
    raw = "".join(texts).encode("utf-32-le", "surrogatepass")
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return np.frombuffer(raw, np.uint32), offsets


def hashed(codes: np.ndarray, offsets: np.ndarray, orders: range, bits: int):
    """For each order n: (bucket of each n-gram inside a text, first n-gram of each text).

    The second has n + 1 entries and makes rows of a sparse matrix of the buckets.
    """
    value = codes.astype(np.uint64) + np.uint64(1)
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, orders.stop):
        if len(codes) < n:
            break
        h = h[: len(codes) - n + 1] * _STEP + value[n - 1 :]
        if n not in orders:
            continue
        ok = np.ones(len(h), bool)
        for back in range(1, n):
            cut = offsets[1:-1] - back
            ok[cut[(cut >= 0) & (cut < len(h))]] = False
        mixed = (h ^ (h >> np.uint64(31))) * _SPREAD + np.uint64(n)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _STEP
        bucket = (mixed >> np.uint64(64 - bits)).astype(np.int64)
        counts = np.maximum(np.diff(offsets) - n + 1, 0)
        first = np.zeros(len(offsets), np.int64)
        np.cumsum(counts, out=first[1:])
        yield bucket[ok], first


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` in each range of ``first``; zero where it is empty."""
    out = np.zeros((len(first) - 1, values.shape[1]))
    filled = np.flatnonzero(first[:-1] < first[1:])
    if len(filled):
        out[filled] = np.add.reduceat(values, first[filled], axis=0, dtype=np.float64)
    return out
