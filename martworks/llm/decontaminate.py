"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are compared as lower-case letters and digits with one space for everything between
them. A benchmark item is cut into patterns of ``SEGMENT`` characters, half overlapping (a
shorter item is one pattern), and into patterns of ``EXCERPT`` characters every ``STRIDE``;
each may be found with ``budget`` edits. An unedited excerpt of an item of
``EXCERPT + STRIDE - 1`` characters or more holds a whole pattern and is found for certain,
wherever it starts; a shorter one is found if it holds a pattern.
For every pattern and band of diagonals the q-grams that it shares with a document are
counted; bands have twice the width of the edit budget and overlap by half. A pattern of
length L within e edits shares at least L - q + 1 - q e of them in some band; bands below
that are left out without loss, the rest is verified by alignment in the band, which
gives the edits and the place.

Documents are read once and nothing is shuffled. The index of the benchmark is broadcast
in parts of about ``INDEX_CHARS`` characters (some 180 bytes a character in a worker); a larger
benchmark takes one pass over the documents for each part, and the filter stages what one pass
leaves before the next.

Defined cases: null or empty texts and items match nothing; items with fewer than
``SHORTEST`` characters after normalization are no evidence and match nothing; repeated
rows are answered each; a null id is carried; items without an id, or with one that is no
whole number, are reported with a null id unless an item with an id has the same text; empty
tables give no rows. Long texts are
read whole. Further columns are never looked at, and the filter keeps them as they are.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martworks.llm.common import frugal, staged, text_of
from martworks.llm.ngrams import code_points, text_chunks

Q = 8
SEGMENT = 100
EXCERPT = 50
STRIDE = 10
EDIT_SHARE = 0.1
LEAST_SHARED = 4
SHORTEST = 24
INDEX_CHARS = 1_000_000
ENTRIES_AT_ONCE = 1 << 18
_FILTER_BITS = 21

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)


def _lower(text: str) -> str:
    low = text.lower()
    if len(low) == len(text):
        return low
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def normalize(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points, their places in the texts joined by one character, text starts).

    Code 0 stands before the first text and after each one; no text holds it otherwise.
    """
    codes, _ = code_points(["\0".join(["", *map(_lower, texts), ""])])
    ends = np.cumsum([0, *[len(t) + 1 for t in texts]])
    keep = _letters()[np.minimum(codes, 0x10FFFF)]
    gap = ~keep
    first_gap = gap.copy()
    first_gap[1:] &= ~gap[:-1]
    first_gap[ends] = True
    edge = np.zeros(len(codes), bool)
    edge[ends] = True
    # a gap right after or before the edge of a text is no space
    first_gap[1:][edge[:-1] & gap[1:] & ~edge[1:]] = False
    at = np.flatnonzero(keep | first_gap)
    out = np.where(keep[at], codes[at], np.where(edge[at], 0, 32)).astype(np.uint32)
    spare = (out[:-1] == 32) & (out[1:] == 0)
    if spare.any():
        stays = np.append(~spare, True)
        out, at = out[stays], at[stays]
    return out, at - 1, np.flatnonzero(out == 0)


def qgrams(codes: np.ndarray) -> np.ndarray:
    h = np.zeros(max(0, len(codes) - Q + 1), np.uint64)
    for i in range(Q):
        h = h * _STEP + codes[i : i + len(h)]
    h = (h ^ (h >> np.uint64(32))) * _SPREAD
    return h ^ (h >> np.uint64(29))


def budget(length: int) -> int:
    """Edits that a pattern may have; over ``LEAST_SHARED`` q-grams must outlast them."""
    return min(int(length * EDIT_SHARE), (length - Q - LEAST_SHARED) // Q)


class Index:
    """Patterns of some benchmark items and where each of their q-grams is."""

    def __init__(self, items: list[tuple[object, str]]):
        self.item, self.codes = [], []
        for item_id, text in items:
            codes = normalize([text or ""])[0][1:-1]
            if len(codes) < SHORTEST:
                continue
            for size, step in ((SEGMENT, SEGMENT // 2), (EXCERPT, STRIDE)):
                if size == EXCERPT and len(codes) <= EXCERPT:
                    continue
                last = max(0, len(codes) - size)
                for a in [*range(0, last, step), last]:
                    self.item.append(item_id)
                    self.codes.append(codes[a : a + size])
        length = np.array([len(c) for c in self.codes], np.int64)
        self.length = length
        self.edits = np.array([budget(n) for n in length.tolist()], np.int64)
        self.needed = length - Q + 1 - Q * self.edits
        self.width = np.maximum(self.edits, 4)
        grams = [qgrams(c) for c in self.codes]
        self.blocks, a = [], 0
        while a < len(grams):
            b, n = a, 0
            while b < len(grams) and (b == a or n + len(grams[b]) <= ENTRIES_AT_ONCE):
                n += len(grams[b])
                b += 1
            self.blocks.append(self._block(grams[a:b], a))
            a = b

    @staticmethod
    def _block(grams: list[np.ndarray], base: int):
        key = np.concatenate(grams)
        pattern = np.repeat(np.arange(base, base + len(grams)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams])
        order = np.argsort(key, kind="stable")
        known, first = np.unique(key[order], return_index=True)
        seen = np.zeros(1 << _FILTER_BITS, bool)
        seen[(known >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        return seen, known, np.append(first, len(key)), pattern[order], place[order]


def _distances(pattern, text, first, width, anchored):
    """Edit distances of patterns to places in their texts, within a band.

    ``pattern`` is (n, L), ``text`` one array; cell k of row i is the text up to place
    ``first + i + k``. Gives the last row (n, width). ``anchored``: the cell of row 0 where
    each alignment starts, else any.
    """
    n, length = pattern.shape
    cells = np.arange(width)
    far = length + width
    row = np.zeros((n, width), np.int32)
    if anchored is not None:
        row += np.abs(cells[None, :] - anchored[:, None])
        row[cells[None, :] < anchored[:, None]] = far
    for i in range(1, length + 1):
        at = first[:, None] + (i - 1) + cells[None, :]
        char = text[np.clip(at, 0, len(text) - 1)]
        char[(at < 0) | (at >= len(text))] = 0
        new = row + (char != pattern[:, i - 1 : i])
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
        row = np.minimum.accumulate(new - cells, axis=1) + cells
    return row


def _found(index: Index, texts: list[str]):
    """(text, pattern, edits, start, end) of each verified place; places in the raw texts."""
    codes, raw, starts = normalize(texts)
    if len(codes) < Q or not index.codes:
        return
    grams = qgrams(codes)
    short = (grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)
    for seen, known, first, pattern, place in index.blocks:
        at = np.flatnonzero(seen[short])
        slot = np.searchsorted(known, grams[at])
        slot[slot == len(known)] = 0
        hit = known[slot] == grams[at]
        at, slot = at[hit], slot[hit]
        times = first[slot + 1] - first[slot]
        total = int(times.sum())
        if not total:
            continue
        before = np.cumsum(times) - times
        entry = np.arange(total) + np.repeat(first[slot] - before, times)
        of = np.searchsorted(starts, at, side="right") - 1
        p = pattern[entry]
        diagonal = np.repeat(at, times) - place[entry]
        band = (diagonal + SEGMENT) // index.width[p]
        # hits of a text, a pattern and a half band next to each other
        bands = len(codes) + SEGMENT
        key = (np.repeat(of, times) * len(index.codes) + p) * bands + band
        key, n = np.unique(key, return_counts=True)
        of, p = np.divmod(key // bands, len(index.codes))
        band = key % bands
        follows = np.diff(key) == 1
        joined = n.copy()
        joined[:-1][follows] += n[1:][follows]
        # a band is two half bands; the one that starts before an occupied half may count too
        keep = np.flatnonzero(joined >= index.needed[p])
        alone = np.zeros(len(n), bool)
        alone[0] = True
        alone[1:] = ~follows
        left = np.flatnonzero(alone & (n >= index.needed[p]))
        of = np.append(of[keep], of[left])
        low = np.append(band[keep], band[left] - 1)
        p = np.append(p[keep], p[left])
        yield from _verified(index, codes, raw, starts, of, p, low)


def _verified(index, codes, raw, starts, of, p, band):
    for length in np.unique(index.length[p]).tolist():
        same = index.length[p] == length
        edits, step = budget(length), max(budget(length), 4)
        width = 2 * step + 2 * edits + 1
        for lo in range(0, int(same.sum()), 4096):
            o, q, b = (x[same][lo : lo + 4096] for x in (of, p, band))
            chars = np.stack([index.codes[x] for x in q])
            first = b * step - SEGMENT - edits
            row = _distances(chars, codes, first, width, None)
            cell = row.argmin(axis=1)
            cost = row[np.arange(len(q)), cell]
            ok = np.flatnonzero(cost <= edits)
            if not len(ok):
                continue
            o, q, cost = o[ok], q[ok], cost[ok]
            end = first[ok] + length + cell[ok]
            # backwards from the end, for the start
            back = codes[::-1]
            middle = np.full(len(ok), edits, np.int64)
            row = _distances(
                chars[ok][:, ::-1], back, len(codes) - end - edits, 2 * edits + 1, middle
            )
            begin = end - (length - edits + row.argmin(axis=1))
            for i in range(len(ok)):
                a = int(np.clip(begin[i], starts[o[i]] + 1, starts[o[i] + 1] - 1))
                z = int(np.clip(end[i], a + 1, starts[o[i] + 1]))
                origin = int(raw[starts[o[i]]]) + 1
                yield (
                    int(o[i]),
                    int(q[i]),
                    int(cost[i]),
                    int(raw[a]) - origin,
                    int(raw[z - 1]) + 1 - origin,
                )


def hits(index: Index, texts: list[str]) -> dict[tuple[int, int], list]:
    """For each (text, position of the item's first pattern): [patterns, edits, start, end].

    ``patterns`` counts those found, ``edits`` is the least of them; the place is from the
    first character of the first to the last of the last one.
    """
    out = {}
    for of, p, cost, a, z in _found(index, texts):
        got = out.setdefault((of, index.item[p]), [set(), cost, a, z])
        got[0].add(p)
        got[1:] = [min(got[1], cost), min(got[2], a), max(got[3], z)]
    return {k: [len(v[0]), *v[1:]] for k, v in out.items()}


@frugal
def _matches(batches, index: Broadcast):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        ids = batch.column("doc_id").to_pylist()
        rows = []
        for lo, hi in text_chunks(texts):
            found = hits(index.value, texts[lo:hi]).items()
            for (of, item), got in sorted(found, key=lambda x: (x[0][0], x[0][1] or 0)):
                rows.append((ids[lo + of], item, *got))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        columns = list(zip(*rows)) or [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds)],
            ["doc_id", "item_id", "n_patterns", "edits", "start_char", "end_char"],
        )


@frugal
def _without(batches, index: Broadcast, column: str):
    for batch in batches:
        texts = [t or "" for t in batch.column(column).to_pylist()]
        keep = np.ones(len(texts), bool)
        for lo, hi in text_chunks(texts):
            for of, _ in hits(index.value, texts[lo:hi]):
                keep[lo + of] = False
        yield batch.filter(pa.array(keep))


def indexes(benchmark: DataFrame) -> list[Broadcast]:
    """The benchmark's indexes, each of about ``INDEX_CHARS`` characters at most."""
    items = benchmark.select(
        benchmark["item_id"].try_cast("long").alias("item_id"), text_of(benchmark)
    )
    # an item without id stands for its text where no other has the same
    items = items.groupBy("text").agg(F.collect_set("item_id").alias("ids"))
    items = items.select(F.explode_outer("ids").alias("item_id"), "text")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = math.ceil(chars / INDEX_CHARS)
    context = benchmark.sparkSession.sparkContext
    out = []
    for part in range(parts):
        of = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part
        rows = items.where(of).orderBy("item_id", "text").collect()
        out.append(context.broadcast(Index([(r["item_id"], r["text"]) for r in rows])))
    return out


_SCHEMA = (
    "doc_id long, item_id long, n_patterns int, edits int, start_char long, end_char long"
)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item found in it, with the place."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs))
    out = docs.sparkSession.createDataFrame([], _SCHEMA)
    for index in indexes(benchmark):
        out = out.union(rows.mapInArrow(functools.partial(_matches, index=index), _SCHEMA))
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, all columns as they are."""
    parts = indexes(benchmark)
    for n, index in enumerate(parts, 1):
        docs = docs.mapInArrow(
            functools.partial(_without, index=index, column="text"), docs.schema
        )
        if n < len(parts):
            # one index in a worker at a time
            docs = staged(docs, "decontaminated")
            index.unpersist()
    return docs
