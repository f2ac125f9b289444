"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

A document is its token ids and one separator. A longer one is cut into whole sequences,
the rest of it is its first piece. Pieces are packed by length: how many there are of each
length (``capacity`` numbers) is all that the plan needs. The plan fills a sequence
greedily with the longest lengths that fit, then replaces its smallest member by two
unpacked ones where that fills it more tightly, and repeats the same filling as often as
the counts allow. Each piece then takes the slot of its rank among the pieces of its
length. The rank comes from counts of (length, share) and the rank inside a share, with
about the square root of all pieces as the number of shares, so a length that a third of
all documents have is dealt over many tasks.

Defined cases: null text is packed as empty (the separator alone); repeated rows are
packed each; a null doc_id is carried; an empty table gives no rows; other columns are
never read.
"""

from __future__ import annotations

import array
import base64
import functools
import math
import zlib
from bisect import bisect_right
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martworks.llm.common import frugal, staged, text_of
from martworks.llm.units import BYTE_LEVEL, Memory

CAPACITY = 2048
SEPARATOR = 0
VOCABULARY = "byte_bpe_50k"


class Encoder:
    """The ids that ``tokenizers`` gives, as little-endian 32-bit bytes.

    The rank file holds the same vocabulary and merges; distinct units go through it once.
    Texts with a special string inside go through ``tokenizers`` as a whole.
    """

    def __init__(self, json_path: str, rank_path: str):
        self.full = Tokenizer.from_file(json_path)
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        with open(rank_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.ranks = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.known = Memory(self._merge)

    def _merge(self, units: list[str]) -> list[bytes]:
        encode = self.ranks.encode_ordinary
        return [array.array("I", encode(u)).tobytes() for u in units]

    def ids(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            got = self.full.encode(text, add_special_tokens=False).ids
            return array.array("I", got).tobytes()
        head, *rest = BYTE_LEVEL.split(text)
        units = [head, *[" " + x for x in rest]] if head else [" " + x for x in rest]
        return b"".join(self.known.look_up(units))


@functools.lru_cache(maxsize=4)
def encoder(json_path: str, rank_path: str) -> Encoder:
    return Encoder(json_path, rank_path)


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter."""
    first = length % capacity or min(length, capacity)
    starts = [0, *range(first, length, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], length])]


@frugal
def _pieces(batches, json_path: str, rank_path: str, capacity: int):
    ids_of = encoder(json_path, rank_path).ids
    end = array.array("I", [SEPARATOR]).tobytes()
    for batch in batches:
        rows = []
        for doc_id, text in zip(
            batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        ):
            raw = memoryview(ids_of(text) + end)
            for k, (a, n) in enumerate(cut(len(raw) // 4, capacity)):
                rows.append((doc_id, k, a, n, zlib.crc32(raw[4 * a : 4 * (a + n)])))
        columns = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(c, kind)
                for c, kind in zip(
                    columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                )
            ],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )


def _longest_first(left: np.ndarray, capacity: int) -> tuple[dict[int, int], int]:
    """A greedy filling (length to copies) and the gap that stays."""
    used, gap, top = {}, capacity, capacity
    while gap:
        sizes = np.flatnonzero(left[: min(gap, top) + 1])
        if not len(sizes):
            break
        size = int(sizes[-1])
        used[size] = min(int(left[size]), gap // size)
        gap -= size * used[size]
        top = size - 1
    return used, gap


def _best_two(left: np.ndarray, room: int, above: int) -> tuple[int, int] | None:
    """The two lengths left whose sum is the largest within ``room``, if over ``above``."""
    sizes = np.flatnonzero(left[: room + 1])
    if not len(sizes):
        return None
    at = np.searchsorted(sizes, room - sizes, side="right") - 1
    # each pair once, with the partner not larger; a length twice needs two of it
    at = np.minimum(at, np.arange(len(sizes)))
    twice = (at == np.arange(len(sizes))) & (left[sizes] < 2)
    at = np.where(twice, at - 1, at)
    sums = np.where(at >= 0, sizes + sizes[at], -1)
    best = int(np.argmax(sums))
    if sums[best] <= above:
        return None
    return int(sizes[best]), int(sizes[at[best]])


def plan_fillings(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Fillings (length to copies) and how many sequences each is used for."""
    left = np.zeros(capacity + 1, np.int64)
    for size, n in counts.items():
        left[size] = n
    out = []
    while left.any():
        used, gap = _longest_first(left, capacity)
        if gap and sum(used.values()) > 1:
            rest = left.copy()
            for size, n in used.items():
                rest[size] -= n
            smallest = min(used)
            if pair := _best_two(rest, gap + smallest, smallest):
                used[smallest] -= 1
                for size in pair:
                    used[size] = used.get(size, 0) + 1
                used = {size: n for size, n in used.items() if n}
        times = min(int(left[size]) // n for size, n in used.items())
        for size, n in used.items():
            left[size] -= n * times
        out.append((used, times))
    return out


def slots(fillings: list[tuple[dict[int, int], int]]) -> dict[int, list[tuple[int, ...]]]:
    """For each length: (first rank, first sequence, sequences, offset of the first copy).

    At most one entry for each filling and distinct length in it.
    """
    at, taken, sequence = defaultdict(list), defaultdict(int), 0
    for used, times in fillings:
        offset = 0
        for size in sorted(used, reverse=True):
            at[size].append((taken[size], sequence, times, offset))
            taken[size] += used[size] * times
            offset += size * used[size]
        sequence += times
    return dict(at)


@frugal
def _place(batches, places: dict[int, list[tuple[int, ...]]]):
    firsts = {size: [x[0] for x in entries] for size, entries in places.items()}
    for batch in batches:
        sequence, offset = [], []
        for size, rank in zip(
            batch.column("length").to_pylist(), batch.column("rank").to_pylist()
        ):
            first, start, times, base = places[size][bisect_right(firsts[size], rank) - 1]
            copy, of = divmod(rank - first, times)
            sequence.append(start + of)
            offset.append(base + copy * size)
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(n) for n in names],
                pa.array(sequence, pa.int64()),
                pa.array(offset, pa.int64()),
            ],
            [*names, "sequence_id", "offset"],
        )


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    json_path: str | None = None,
    rank_path: str | None = None,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece."""
    json_path = json_path or public_tokenizers.path(f"{VOCABULARY}.json")
    rank_path = rank_path or public_tokenizers.path(f"{VOCABULARY}.tiktoken")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs))
    pieces = staged(
        rows.mapInArrow(
            functools.partial(
                _pieces, json_path=json_path, rank_path=rank_path, capacity=capacity
            ),
            "doc_id long, piece int, start long, length long, ids_crc32 long",
        ),
        "pieces",
    )
    counts = {r["length"]: r["n"] for r in _counts(pieces).collect()}
    places = slots(plan_fillings(counts, capacity))
    shares = max(1, math.isqrt(sum(counts.values())))
    share = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shares))
    pieces = pieces.withColumn("share", share)
    before = (
        pieces.groupBy("length", "share")
        .agg(F.count("*").alias("n"))
        .withColumn(
            "before",
            F.sum("n").over(Window.partitionBy("length").orderBy("share")) - F.col("n"),
        )
        .drop("n")
    )
    inside = F.row_number().over(
        Window.partitionBy("length", "share").orderBy("doc_id", "piece", "ids_crc32")
    )
    ranked = (
        pieces.withColumn("inside", inside)
        .join(before, ["length", "share"])
        .withColumn("rank", F.col("before") + F.col("inside") - 1)
        .drop("before", "inside", "share")
    )
    return ranked.mapInArrow(
        functools.partial(_place, places=places),
        "doc_id long, piece int, start long, length long, ids_crc32 long,"
        " sequence_id long, offset long",
    )


def _counts(pieces: DataFrame) -> DataFrame:
    """Pieces of each length: ``capacity`` rows at most."""
    return pieces.groupBy("length").agg(F.count("*").alias("n"))
