"""Ranked lexical search over bit-sliced Bloom signatures.

Index: a document sets, for each of its terms and for each of the counts 2, 4 and 8 that a
term reaches, ``HASHES`` bits of a signature whose width follows the number of such entries.
Up to ``BLOCK_DOCS`` documents of one width make a block, stored by bit: slice j is the bitmap
of the documents that have bit j. Beside the blocks stand the documents each term occurs in,
as counts of the tasks. The index knows no query.

Search: the slices of a term's bits, and-ed, give a bitmap that holds every document with
the term (and some without). For each item the bitmaps of its terms are summed with the
terms' weights, once for each count, and the sums, each times what that count can add to a
score in a document of that length, bound the document's score from above. First the
``k`` highest bounds of each item are scored exactly; the k-th score found is a threshold. Then
every document whose bound reaches the threshold (at equality: with an id no larger than that
document's) is scored on its whole text, and the best k stay. Weights, bounds and scores are integers,
so nothing is excluded by rounding. Items are taken in parts of ``PART_TERMS`` terms, a pass
over the index each, so what is broadcast is bounded.

Defined cases: null, empty and termless texts match nothing and are not counted; a null doc_id
loses ties; repeated documents are documents of their own (ties by place); each row of items is
an item, whatever its id; items without terms, or whose terms no document holds, give no rows;
with an empty table there are no rows; other columns are never read.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martworks.llm.common import frugal, staged, text_of, utf8_batch

K = 10
HASHES = 5
#: Bits of a signature for each entry, before rounding up to a power of two.
ENTRY_BITS = 14
LEAST_BITS, MOST_BITS = 64, 1 << 24
#: Term counts that are entries of their own.
COUNTS = (1, 2, 3, 4, 5, 6, 8, 11, 16, 32)
BLOCK_DOCS = 2048
BLOCK_BYTES = 1 << 20
PART_TERMS = 50_000
#: Document counts that a task gathers before it hands them on.
HELD_TERMS = 200_000
#: Up to so many rows of candidates or terms are broadcast.
BROADCAST_ROWS = 200_000

_NO_ID = np.iinfo(np.int64).max
_INDEX = (
    "docs long, terms long, bits int, uid binary, ids binary, sizes binary, most binary, "
    "slices binary, term binary, df long"
)
_EMPTY_BLOCK = {"docs": 0, "terms": 0, "bits": 0, "uid": None, "ids": None, "sizes": None,
                "most": None, "slices": None}


def _fold() -> bytes:
    """Letters, digits and all bytes beyond ASCII stay, A-Z lower-cased; the rest parts terms."""
    return bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


_FOLD = _fold()


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _mixed(hashes: np.ndarray, entry: int) -> np.ndarray:
    """Another 64 bits for the same term at another of COUNTS."""
    x = hashes + np.uint64((0x9E3779B97F4A7C15 * (entry + 1)) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The HASHES bits of each hash, one after the other."""
    at, step = hashes, (hashes >> np.uint64(32)) | np.uint64(1)
    for _ in range(HASHES):
        yield (at & np.uint64(bits - 1)).astype(np.int64)
        at = at + step


class _Gathered:
    """Documents of one width that wait for their block."""

    def __init__(self, bits: int):
        self.bits = bits
        self.full = max(8, min(BLOCK_DOCS, BLOCK_BYTES * 8 // bits))
        self.uid, self.ids, self.sizes, self.most = [], [], [], []
        self.hashes, self.times = [], []

    def add(self, uid, doc_id, size, hashes, times) -> bool:
        self.uid.append(uid)
        self.ids.append(_NO_ID if doc_id is None else doc_id)
        self.sizes.append(size)
        self.most.append(int(times.max()))
        self.hashes.append(hashes)
        self.times.append(times)
        return len(self.uid) >= self.full

    def block(self) -> dict:
        docs = len(self.uid)
        slices = np.zeros((self.bits, -(-docs // 8)), np.uint8)
        for bit in range(8):
            if bit >= docs:
                break
            column = [len(h) for h in self.hashes[bit::8]]
            column = np.repeat(np.arange(len(column)), column)
            hashes, times = np.concatenate(self.hashes[bit::8]), np.concatenate(self.times[bit::8])
            for entry, least in enumerate(COUNTS):
                own = times >= least
                if not own.any():
                    break
                # a place that comes twice is set twice: one bit of the byte at a time
                for places in _places(_mixed(hashes[own], entry), self.bits):
                    slices[places, column[own]] |= np.uint8(1 << bit)
        pack = lambda values: np.array(values, np.int64).tobytes()
        return {
            "docs": docs, "terms": sum(self.sizes), "bits": self.bits, "uid": pack(self.uid),
            "ids": pack(self.ids), "sizes": pack(self.sizes), "most": pack(self.most),
            "slices": slices.tobytes(), "term": None, "df": 0,
        }


def _width(times: np.ndarray) -> int:
    """Bits of the signature of a document with these term counts."""
    entries = int(np.searchsorted(COUNTS, times, side="right").sum())
    return min(max(LEAST_BITS, 1 << (entries * ENTRY_BITS - 1).bit_length()), MOST_BITS)


@frugal
def _signatures(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    waiting: dict[int, _Gathered] = {}
    held: Counter = Counter()
    hashed: dict[bytes, int] = {}

    def counts() -> Iterator[pa.RecordBatch]:
        pairs = list(held.items())
        held.clear()
        for at in range(0, len(pairs), 10_000):
            part = [_EMPTY_BLOCK | {"term": t, "df": n} for t, n in pairs[at : at + 10_000]]
            yield pa.RecordBatch.from_pylist(part, schema)

    def block(gathered: _Gathered) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([gathered.block()], schema)

    for batch in batches:
        raw, off = utf8_batch(batch.column("text"))
        uids, ids = batch.column("uid").to_pylist(), batch.column("doc_id").to_pylist()
        for i, (uid, doc_id) in enumerate(zip(uids, ids)):
            tokens = terms_of(raw[off[i] : off[i + 1]].tobytes())
            if not tokens:
                continue
            own = Counter(tokens)
            held.update(own.keys())
            for term in own:
                if term not in hashed:
                    hashed[term] = xxhash.xxh3_64_intdigest(term)
            hashes = np.fromiter(map(hashed.__getitem__, own), np.uint64, len(own))
            times = np.fromiter(own.values(), np.int32, len(own))
            bits = _width(times)
            if bits not in waiting:
                waiting[bits] = _Gathered(bits)
            if waiting[bits].add(uid, doc_id, len(tokens), hashes, times):
                yield block(waiting.pop(bits))
            if len(held) > HELD_TERMS:
                yield from counts()
            if len(hashed) > HELD_TERMS:
                hashed.clear()
    for gathered in waiting.values():
        yield block(gathered)
    yield from counts()


def _arrow(fields: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    pairs = [f.split() for f in fields.split(", ")]
    return pa.schema([(name, kinds[kind]) for name, kind in pairs])


def build_index(docs: DataFrame) -> DataFrame:
    """Blocks and document counts of (uid, doc_id, text)."""
    make = functools.partial(_signatures, schema=_arrow(_INDEX))
    return staged(docs.mapInArrow(make, _INDEX), "lexical-index")


# -- items ---------------------------------------------------------------------------------


@frugal
def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, off = utf8_batch(batch.column("text"))
        out: dict[str, list] = {"qid": [], "term": [], "times": []}
        for i, qid in enumerate(batch.column("qid").to_pylist()):
            for term, n in Counter(terms_of(raw[off[i] : off[i + 1]].tobytes())).items():
                out["qid"].append(qid)
                out["term"].append(term)
                out["times"].append(n)
        yield pa.RecordBatch.from_pydict(out, _arrow("qid long, term binary, times long"))


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _weighted(terms: DataFrame, index: DataFrame, docs: int) -> DataFrame:
    """(qid, term, weight) of the terms that some document holds."""
    wanted = terms.select("term").distinct()
    counts = index.where("term is not null").select("term", "df").join(_few(wanted), "term")
    counts = counts.groupBy("term").agg(F.sum("df").alias("df"))
    ratio = F.lit(2.0 * docs + 2) / (F.lit(2.0) * F.col("df") + 1)
    weight = F.col("times") * F.floor(F.lit(1000.0) * F.log(ratio))
    return terms.join(counts, "term").select("qid", "term", weight.cast("long").alias("weight"))


class Part:
    """The items of one pass: distinct terms, and for each item its terms and weights."""

    def __init__(self, rows: list, docs: int, length: int):
        self.docs, self.length = docs, length
        self.terms = sorted({bytes(r["term"]) for r in rows})
        number = {t: i for i, t in enumerate(self.terms)}
        self.hashes = np.array([xxhash.xxh3_64_intdigest(t) for t in self.terms], np.uint64)
        self.items: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        by_item: dict[int, list] = {}
        for r in rows:
            by_item.setdefault(r["qid"], []).append((number[bytes(r["term"])], r["weight"]))
        for qid, pairs in sorted(by_item.items()):
            at, weights = zip(*pairs)
            self.items[qid] = (np.array(at), np.array(weights, np.int64))

    def norm(self, size: int) -> int:
        return 25 + 75 * size * self.docs // self.length


def _gain(tf: int, norm: int) -> int:
    return 1_000_000_000 * tf // (1000 * tf + 8 * norm)


# -- bounds --------------------------------------------------------------------------------


def _bounds(block: dict, part: Part) -> Iterator[tuple[int, np.ndarray]]:
    """(item, upper bounds of the scores of the block's documents), where any is above 0."""
    docs, bits = block["docs"], block["bits"]
    slices = np.frombuffer(block["slices"], np.uint8).reshape(bits, -1)
    maps = []
    for entry in range(len(COUNTS)):
        found = maps[-1].copy() if maps else None
        for places in _places(_mixed(part.hashes, entry), bits):
            found = slices[places] if found is None else found & slices[places]
        maps.append(found)
    there = [m.any(axis=1) for m in maps]
    if not there[0].any():
        return
    norms = [part.norm(n) for n in np.frombuffer(block["sizes"], np.int64).tolist()]
    most = np.frombuffer(block["most"], np.int64).tolist()
    # what a count can add: from the highest count of the entry before to its own highest
    tops = [*[c - 1 for c in COUNTS[1:]], None]
    steps, before = [], np.zeros(docs, np.int64)
    for top in tops:
        gains = [_gain(t if top is None else min(t, top), m) for t, m in zip(most, norms)]
        now = np.maximum(np.array(gains, np.int64), before)
        steps.append(now - before)
        before = now
    for qid, (at, weights) in part.items.items():
        total = None
        for step, found, some in zip(steps, maps, there):
            own = some[at]
            if not own.any():
                break
            bitmap = np.unpackbits(found[at[own]], axis=1, count=docs, bitorder="little")
            summed = weights[own].astype(np.float64) @ bitmap.astype(np.float64)
            added = summed.astype(np.int64) * step
            total = added if total is None else total + added
        if total is not None:
            yield qid, total


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


@frugal
def _highest(batches: Iterator[pa.RecordBatch], part: Part, k: int) -> Iterator[pa.RecordBatch]:
    """The k documents of the task's blocks with the highest bounds, for each item."""
    best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for block in _blocks(batches):
        uid = np.frombuffer(block["uid"], np.int64)
        for qid, bound in _bounds(block, part):
            own = np.argpartition(-bound, k - 1)[:k] if len(bound) > k else np.arange(len(bound))
            own = own[bound[own] > 0]
            bounds, uids = bound[own], uid[own]
            if qid in best:
                bounds = np.concatenate([best[qid][0], bounds])
                uids = np.concatenate([best[qid][1], uids])
                keep = np.argsort(-bounds, kind="stable")[:k]
                bounds, uids = bounds[keep], uids[keep]
            best[qid] = (bounds, uids)
    for qid, (bounds, uids) in best.items():
        yield pa.RecordBatch.from_pydict(
            {"qid": [qid] * len(uids), "uid": uids, "bound": bounds},
            _arrow("qid long, uid long, bound long"),
        )


@frugal
def _open(
    batches: Iterator[pa.RecordBatch], part: Part, least: dict[int, tuple[int, int]]
) -> Iterator[pa.RecordBatch]:
    """(item, document) wherever the bound doesn't exclude the document."""
    schema = _arrow("qid long, uid long")
    for block in _blocks(batches):
        uid = np.frombuffer(block["uid"], np.int64)
        ids = np.frombuffer(block["ids"], np.int64)
        for qid, bound in _bounds(block, part):
            score, doc_id = least.get(qid, (1, _NO_ID))
            own = uid[(bound > score) | ((bound == score) & (ids <= doc_id))]
            if len(own):
                yield pa.RecordBatch.from_pydict({"qid": [qid] * len(own), "uid": own}, schema)


# -- exact scores --------------------------------------------------------------------------


@frugal
def _scores(batches: Iterator[pa.RecordBatch], part: Part) -> Iterator[pa.RecordBatch]:
    schema = _arrow("qid long, uid long, doc_id long, score long")
    number = {t: i for i, t in enumerate(part.terms)}
    for batch in batches:
        raw, off = utf8_batch(batch.column("text"))
        out: list[tuple] = []
        columns = [batch.column(c).to_pylist() for c in ("uid", "doc_id", "qids")]
        for i, (uid, doc_id, qids) in enumerate(zip(*columns)):
            tokens = terms_of(raw[off[i] : off[i + 1]].tobytes())
            norm = part.norm(len(tokens))
            own = Counter(t for t in tokens if t in number)
            gain = np.zeros(len(number), np.int64)
            for term, tf in own.items():
                gain[number[term]] = _gain(tf, norm)
            for qid in qids:
                at, weights = part.items[qid]
                out.append((qid, uid, doc_id, int(gain[at] @ weights)))
        names = schema.names
        yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema)


def _scored(docs: DataFrame, pairs: DataFrame, part: Part) -> DataFrame:
    """(qid, uid, doc_id, score) of staged pairs (qid, uid), each document read once."""
    wanted = pairs.groupBy("uid").agg(F.collect_set("qid").alias("qids"))
    chosen = docs.join(_few(wanted), "uid").select("uid", "doc_id", "text", "qids")
    score = functools.partial(_scores, part=part)
    kinds = "qid long, uid long, doc_id long, score long"
    return chosen.mapInArrow(score, kinds).where("score > 0")


def _first(pairs: DataFrame, k: int, *order) -> DataFrame:
    ranked = Window.partitionBy("qid").orderBy(*order)
    return pairs.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best documents for each item."""
    best = (F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("uid"))
    uid = F.monotonically_increasing_id()
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(docs))
    docs = staged(docs.withColumn("uid", uid), "lexical-docs")
    index = build_index(docs)
    count, length = index.agg(F.sum("docs"), F.sum("terms")).first()

    items = items.select(F.col("item_id").alias("item_id"), text_of(items))
    items = staged(items.withColumn("qid", uid), "lexical-items")
    terms = items.select("qid", "text").mapInArrow(
        _item_terms, "qid long, term binary, times long"
    )
    terms = staged(_weighted(staged(terms, "lexical-terms"), index, count or 0), "lexical-weights")
    parts = -(-terms.count() // PART_TERMS)

    blocks = index.where("docs > 0").drop("term", "df", "terms")
    found = docs.sparkSession.createDataFrame([], "qid long, uid long, doc_id long, score long")
    for p in range(parts):
        # an item's terms stay together: the identifiers of items count up within a file
        own = terms.where(F.pmod("qid", F.lit(parts)) == p).collect()
        part = Part(own, count, length)
        top = functools.partial(_highest, part=part, k=k)
        seeds = blocks.mapInArrow(top, "qid long, uid long, bound long")
        seeds = staged(_first(seeds, k, F.desc("bound"), F.asc("uid")), "lexical-seeds")
        kth = _first(_scored(docs, seeds, part), k, *best).where(F.col("rank") == k)
        least = {
            r["qid"]: (r["score"], _NO_ID if r["doc_id"] is None else r["doc_id"])
            for r in kth.collect()
        }
        left = functools.partial(_open, part=part, least=least)
        pairs = staged(blocks.mapInArrow(left, "qid long, uid long"), "lexical-open")
        found = found.unionAll(_first(_scored(docs, pairs, part), k, *best).drop("rank"))
    ranked = _first(found, k, *best).join(items.select("qid", "item_id"), "qid")
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
