import math
import random
from collections import Counter

import numpy as np
import pytest

from martworks.llm import lexical_search
from martworks.llm.lexical_search import Part, _bounds, _Gathered, search, terms_of


def by_hand(docs, items, k=10):
    """Sorted (item_id, rank, doc_id, score) of rows (doc_id, text) and (item_id, text)."""
    held = [(i, Counter(terms_of((t or "").encode()))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in items:
        asked = Counter(terms_of((text or "").encode()))
        scored = []
        for place, (doc_id, own) in enumerate(held):
            m = 25 + 75 * sum(own.values()) * n // length
            score = 0
            for term, times in asked.items():
                if tf := own[term]:
                    weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    score += times * weight * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score:
                scored.append((-score, doc_id is None, doc_id or 0, place, doc_id))
        for rank, (score, *_, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=str)


def found(spark, docs, items, k=10):
    frames = [
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    ]
    got = search(*frames, k=k)
    assert got.dtypes == [
        ("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint"),
    ]
    return sorted(map(tuple, got.collect()), key=str)


def _corpus(seed, docs=300, words=120):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    sizes = [draw.choice([1, 3, 20, 80, 600]) for _ in range(docs)]
    texts = [" ".join(draw.choices(vocabulary, weights, k=n)) for n in sizes]
    items = [" ".join(draw.choices(vocabulary, weights, k=draw.randint(1, 12))) for _ in range(12)]
    return list(enumerate(texts)), list(enumerate(items))


@pytest.mark.parametrize("seed", range(3))
def test_equals_scoring_every_document(spark, seed):
    docs, items = _corpus(seed)
    assert found(spark, docs, items) == by_hand(docs, items)


def test_small_blocks_and_several_passes(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "PART_TERMS", 7)
    docs, items = _corpus(9)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    got = sorted(map(tuple, search(frame, asked, 3).collect()), key=str)
    assert got == by_hand(docs, items, 3)


def test_ties_and_a_large_group_of_copies(spark):
    docs = [(i, "red green blue") for i in range(200, 0, -1)] + [(500, "red"), (None, "red green blue")]
    items = [(1, "red blue"), (2, "green green"), (3, "nothing here"), (4, "red")]
    assert found(spark, docs, items) == by_hand(docs, items)


def test_edge_rows(spark, edge_docs, no_docs):
    items = [(1, "quick brown fox"), (1, "quick brown fox"), (None, "MILL word5"), (2, None),
             (3, ""), (4, "東京 straße"), (5, "x" * 50_000), (6, "12345 !!! one")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    got = sorted(map(tuple, search(edge_docs, asked).collect()), key=str)
    assert got == by_hand(docs, items)
    assert search(no_docs, asked).count() == 0
    assert search(edge_docs, asked.limit(0)).count() == 0


def test_terms():
    assert terms_of("A-b_C3 Größe ΑΒ\t1.5 İ".encode()) == [
        b"a", b"b", b"c3", "größe ΑΒ".encode(), b"1", b"5", "İ".encode(),
    ]


def test_bounds_hold_and_repeat_counts_are_tight():
    """No bound is below a score; without collisions a counted tf up to 6 is exact."""
    draw = random.Random(3)
    words = [f"t{i}" for i in range(60)]
    texts = [Counter(draw.choices(words, k=draw.choice([2, 10, 50, 300]))) for _ in range(400)]
    docs, length = len(texts), sum(sum(c.values()) for c in texts)
    rows = [{"qid": q, "term": w.encode(), "weight": draw.randint(1, 9000)}
            for q in range(5) for w in draw.sample(words, 8)]
    part = Part(rows, docs, length)
    for bits in (64, 1 << 16):
        block = _Gathered(bits)
        for i, own in enumerate(texts):
            hashes = np.array([lexical_search.xxhash.xxh3_64_intdigest(t) for t in own], np.uint64)
            block.add(i, i, sum(own.values()), hashes, np.array(list(own.values()), np.int32))
        bounds = dict(_bounds(block.block(), part))
        for qid in range(5):
            weights = {r["term"].decode(): r["weight"] for r in rows if r["qid"] == qid}
            for i, own in enumerate(texts):
                m = part.norm(sum(own.values()))
                score = sum(w * lexical_search._gain(own[t], m) for t, w in weights.items() if own[t])
                assert bounds[qid][i] >= score
                if bits > 64 and all(own[t] <= 5 for t in weights):
                    assert bounds[qid][i] == score
