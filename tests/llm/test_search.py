import random

import numpy as np
import pytest

from martworks.llm import topk_search
from martworks.llm.topk_search import search
from tests.conftest import SF_MID


def by_hand(rows, k=5, every=50):
    """Sorted (query_id, rank, vec_id, score)."""
    fine = [
        (i, [int(np.floor(256 * float(x))) for x in v])
        for i, v in rows
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for a, (i, v) in enumerate(fine):
        if i is None or i % every:
            continue
        scores = [
            (-min(sum(x * y for x, y in zip(v, w)), 2**63 - 1), j if j is not None else 1 << 62, j)
            for b, (j, w) in enumerate(fine)
            if b != a and len(w) == len(v)
        ]
        for rank, (score, _, j) in enumerate(sorted(scores, key=lambda s: s[:2])[:k], 1):
            out.append((i, rank, j, -score))
    return sorted(out, key=str)


def found(frame):
    return sorted(map(tuple, search(frame).select("query_id", "rank", "vec_id", "score").collect()), key=str)


def test_table(spark):
    frame = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    assert found(frame) == by_hand(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_uneven_lengths_and_ties(spark, seed, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK_BYTES", 2048)
    draw = random.Random(seed)
    rows = []
    for i in range(700):
        size = 10 ** draw.uniform(-2, 2)
        rows.append((i, [round(draw.gauss(0, size), 2) for _ in range(6)]))
    rows += [(700 + i, [0.5] * 6) for i in range(80)] + [(900, [0.0] * 6), (950, [-0.5] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(frame) == by_hand(rows)


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 2.0], "a"), (0, [1.0, 2.0], "a"), (50, [3.0, -1.0], "b"), (1, None, "c"),
        (2, [None, 1.0], "d"), (3, [nan, 1.0], "e"), (4, [inf, 1.0], "f"), (None, [1.0, 2.0], "g"),
        (5, [1.0, 2.0], "h"), (6, [1.0, 2.0, 3.0], "i"), (100, [1.0, 1.0, 1.0], "j"), (150, [], "k"),
        (7, [1e15, 1e15], "l"), (200, [1.0], "m"),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = found(frame)
    assert got == by_hand([r[:2] for r in rows])
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert search(empty).count() == 0
