"""Exact top-k inner products by norm-bucketed retrieval.

Vectors become integers, floor(256 x). They are grouped by dimension and length class
(a quarter of a power of two), large classes dealt over blocks of about ``BLOCK_BYTES``
by a hash of the row. Queries are dealt over blocks as well. A first pass compares all
queries with the ``SEEDS`` blocks of the longest vectors; the k-th best score there is a
lower bound for the query. From it each block gives a local cosine threshold: bound over
(length of the query times longest vector of the block). A block where it is above 1 for
every query of a query block is never joined with it. Inside a block each query is pruned
by coordinates where its threshold is at least ``COORDINATE_FROM`` (a vector that reaches
it must have its largest coordinates within known limits) and by length below that; what is
left is verified by exact integer products. A query and a block give at most k rows.

Defined cases: vectors that are null, or hold null or non-finite components, take no part;
only vectors of equal dimension are compared; a null vec_id is no query, as a candidate it
loses ties; rows with the same vec_id are different candidates, and each asks if it is a
query; ties go to the smaller vec_id; products beyond 64 bits are given as the nearest
64-bit number; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martworks.llm.common import staged

K = 5
EVERY = 50
SEEDS = 2
BLOCK_BYTES = 1 << 20
FOCUS = 4
COORDINATE_FROM = 0.3
DEALT = 16

_NO_ID = np.iinfo(np.int64).max
_BLOCK = "dims int, cls int, part long, n int, top double, uid binary, ids binary, vecs binary"


def _vectors(embeddings: DataFrame) -> DataFrame:
    """(uid, vec_id, dims, cls, vec) of the vectors that take part."""
    x = F.col("embedding")
    finite = F.forall(x, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < float("inf")))
    rows = embeddings.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("vec_id").cast("long").alias("vec_id"),
        x,
    ).where(x.isNotNull() & finite)
    vec = F.transform(x, lambda c: F.floor(F.lit(256.0) * c.cast("double")))
    rows = rows.select("uid", "vec_id", vec.alias("vec"))
    square = F.aggregate(
        "vec", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")
    )
    cls = F.floor(2 * F.log2(square + 1)).cast("int")
    return rows.select("uid", "vec_id", "vec", F.size("vec").alias("dims"), cls.alias("cls"))


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    """One block: its rows by falling length, as arrays."""
    vecs = np.array(rows["vec"].tolist(), np.int64).reshape(len(rows), -1)
    size = np.sqrt((vecs.astype(float) ** 2).sum(axis=1))
    order = np.argsort(-size, kind="stable")
    ids = rows["vec_id"].astype("Int64").fillna(_NO_ID).to_numpy(np.int64)
    out = {c: [rows[c].iloc[0]] for c in ("dims", "cls", "part")}
    out |= {
        "n": [len(rows)],
        "top": [float(size.max())],
        "uid": [rows["uid"].to_numpy(np.int64)[order].tobytes()],
        "ids": [ids[order].tobytes()],
        "vecs": [vecs[order].tobytes()],
    }
    if "bound" in rows:
        bound = rows["bound"].to_numpy(float)[order]
        out["bounds"] = [bound.tobytes()]
        # the length that a vector needs at least to reach some query's bound
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.where(bound > 0, bound / size[order], 0)
        out["need"] = [float(np.nan_to_num(need, nan=0.0).min()) * (1 - 1e-9)]
    return pd.DataFrame(out)


def _blocks(vectors: DataFrame, extra: str = "") -> DataFrame:
    rows = F.greatest(F.lit(16), F.lit(BLOCK_BYTES // 8) / F.greatest("dims", F.lit(1)))
    parts = vectors.groupBy("dims", "cls").agg(F.count("*").alias("m"))
    parts = parts.select("dims", "cls", F.ceil(F.col("m") / rows).alias("parts"))
    dealt = vectors.join(parts, ["dims", "cls"]).withColumn(
        "part", F.pmod(F.xxhash64("uid"), F.col("parts"))
    )
    return dealt.drop("parts").groupBy("dims", "cls", "part").applyInPandas(_pack, _BLOCK + extra)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows; beyond 64 bits the nearest 64-bit number."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    most = float(np.abs(a.astype(float)).max()) * float(np.abs(b.astype(float)).max()) * a.shape[1]
    if most < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if most < 2**62:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, np.iinfo(np.int64).min, np.iinfo(np.int64).max).astype(np.int64)


def _best(score, ids, uid, own, k):
    """Positions of the k best: highest score, then smallest id; never the own row."""
    ok = np.flatnonzero(uid != own)
    if len(ok) > k:
        last = np.partition(score[ok], len(ok) - k)[len(ok) - k]
        ok = ok[score[ok] >= last]
    return ok[np.lexsort((uid[ok], ids[ok], -score[ok]))[:k]]


def _by_coordinates(unit, q_unit, t):
    """Rows of unit vectors that may have a cosine of ``t`` or more with ``q_unit``."""
    focus = np.argsort(-np.abs(q_unit))[:FOCUS]
    keep = np.ones(len(unit), bool)
    for f in focus:
        c = q_unit[f]
        reach = np.sqrt(max(0.0, 1 - c * c) * max(0.0, 1 - t * t)) + 1e-9
        keep &= (unit[:, f] >= c * t - reach) if c > 0 else (unit[:, f] <= c * t + reach)
    return keep


def _compare(q, c, bounds, k):
    """(query row, candidate row, score) of the best of one query and candidate block."""
    (q_uid, _, q_vec), (c_uid, c_ids, c_vec) = q, c
    size = np.sqrt((c_vec.astype(float) ** 2).sum(axis=1))
    q_size = np.sqrt((q_vec.astype(float) ** 2).sum(axis=1))
    need = np.where(bounds > 0, bounds / np.maximum(q_size, 1e-300), -1.0) * (1 - 1e-9)
    # the rows are sorted by falling length: those long enough come first
    enough = np.searchsorted(-size, -need, side="right")
    enough[need < 0] = len(size)
    local = need / max(float(size.max(initial=0.0)), 1e-300)
    unit = c_vec / np.maximum(size, 1e-300)[:, None]
    by_length = np.flatnonzero((enough > 0) & (local < COORDINATE_FROM))
    if len(by_length):
        score = _products(q_vec[by_length], c_vec[: enough[by_length].max()])
        for row, i in zip(score, by_length):
            row = row[: enough[i]]
            at = _best(row, c_ids[: enough[i]], c_uid[: enough[i]], q_uid[i], k)
            yield from ((i, j, row[j]) for j in at if row[j] >= bounds[i])
    for i in np.flatnonzero((enough > 0) & (local >= COORDINATE_FROM)):
        keep = _by_coordinates(unit[: enough[i]], q_vec[i] / q_size[i], min(1.0, local[i]))
        left = np.flatnonzero(keep)
        row = _products(q_vec[i : i + 1], c_vec[left])[0]
        at = _best(row, c_ids[left], c_uid[left], q_uid[i], k)
        yield from ((i, left[j], row[j]) for j in at if row[j] >= bounds[i])


def _arrays(batch, prefix: str, i: int):
    uid, ids = (
        np.frombuffer(batch.column(prefix + c)[i].as_py(), np.int64) for c in ("uid", "ids")
    )
    vecs = np.frombuffer(batch.column(prefix + "vecs")[i].as_py(), np.int64)
    return uid, ids, vecs.reshape(len(uid), -1)


def _search(batches, k: int, bounded: bool):
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            q, c = _arrays(batch, "q_", i), _arrays(batch, "c_", i)
            bounds = np.full(len(q[0]), -np.inf)
            if bounded:
                bounds = np.frombuffer(batch.column("q_bounds")[i].as_py(), float)
            for a, b, score in _compare(q, c, bounds, k):
                none = c[1][b] == _NO_ID
                rows.append(
                    (int(q[0][a]), int(q[1][a]), int(c[0][b]), None if none else int(c[1][b]), int(score))
                )
        columns = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in columns],
            ["query_uid", "query_id", "uid", "vec_id", "score"],
        )


_FOUND = "query_uid long, query_id long, uid long, vec_id long, score long"


def _joined(queries: DataFrame, blocks: DataFrame, pairs: DataFrame) -> DataFrame:
    """Query and candidate blocks of ``pairs`` (q_part, q_cls, dims, cls, part) side by side."""
    asks = queries.select(
        "dims",
        F.col("cls").alias("q_cls"),
        F.col("part").alias("q_part"),
        *[F.col(c).alias("q_" + c) for c in queries.columns if c in ("uid", "ids", "vecs", "bounds")],
    )
    has = blocks.select(
        "dims", "cls", "part", *[F.col(c).alias("c_" + c) for c in ("uid", "ids", "vecs")]
    )
    return pairs.join(asks, ["dims", "q_cls", "q_part"]).join(has, ["dims", "cls", "part"])


def search(
    embeddings: DataFrame, k: int = K, every: int = EVERY
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each query.

    Queries are the rows whose vec_id is divisible by ``every``.
    """
    vectors = staged(_vectors(embeddings), "vectors")
    blocks = staged(_blocks(vectors), "blocks")
    asking = vectors.where(F.col("vec_id") % every == 0).withColumn("cls", F.lit(0))
    first = staged(_blocks(asking), "queries")

    order = Window.partitionBy("dims").orderBy(F.desc("cls"), "part")
    seeds = blocks.select("dims", "cls", "part").withColumn("place", F.row_number().over(order))
    seeds = seeds.where(F.col("place") <= SEEDS).drop("place")
    named = first.select("dims", F.col("cls").alias("q_cls"), F.col("part").alias("q_part"))
    found = _joined(first, blocks, named.join(seeds, "dims")).mapInArrow(
        functools.partial(_search, k=k, bounded=False), _FOUND
    )
    bound = found.groupBy("query_uid").agg(F.sort_array(F.collect_list("score"), False).alias("s"))
    bound = bound.select(
        F.col("query_uid").alias("uid"), F.get("s", F.lit(k - 1)).cast("double").alias("bound")
    )
    bounded = asking.join(bound, "uid", "left").withColumn(
        "bound", F.coalesce("bound", F.lit(float("-inf")))
    )
    queries = staged(
        _blocks(bounded, ", bounds binary, need double"), "bounded"
    )

    # the numbers of blocks only; dealt out, since few dimensions hold all of them
    deal = F.explode(F.sequence(F.lit(0), F.lit(DEALT - 1)))
    asks = queries.select(
        "dims", F.col("cls").alias("q_cls"), F.col("part").alias("q_part"), "need"
    ).withColumn("dealt", deal)
    has = blocks.select("dims", "cls", "part", "top").withColumn(
        "dealt", F.pmod(F.xxhash64("cls", "part"), F.lit(DEALT)).cast("int")
    )
    pairs = asks.join(has, ["dims", "dealt"]).where("top >= need")
    pairs = pairs.select("dims", "q_cls", "q_part", "cls", "part")
    found = _joined(queries, blocks, pairs).mapInArrow(
        functools.partial(_search, k=k, bounded=True), _FOUND
    )
    best = Window.partitionBy("query_uid").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), "uid"
    )
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
