import random

import pytest

from martworks.llm import minhash_dedup
from martworks.llm.components import components as graph_components
from martworks.llm.minhash_dedup import keep_one_of_each, minhash_components
from tests.conftest import SF_MID
from tests.llm import reference
from tests.llm.conftest import EDGE_ROWS, PROSE


def variants(n, words_of=140, seed=1):
    """Copies of one text with more and more words changed, and texts with one passage."""
    draw = random.Random(seed)
    base = [f"w{draw.randint(0, 500)}" for _ in range(words_of)]
    passage = [f"p{i}" for i in range(60)]
    out = {}
    for i in range(n):
        w = list(base)
        for _ in range(i % 13):
            w[draw.randrange(len(w))] = f"new{draw.randint(0, 9999)}"
        out[i] = " ".join(w)
    for i in range(n, 2 * n):
        own = [f"w{draw.randint(0, 9999)}" for _ in range(draw.randint(5, 150))]
        out[i] = " ".join(own[:20] + passage + own[20:])
    return out


@pytest.mark.parametrize("width,num", [(3, 85), (5, 80)])
def test_components_of_variants(make_docs, width, num):
    texts = variants(90)
    want, sizes = reference.components(texts, width, num, 100)
    rows = minhash_components(make_docs(texts), width, num, 100).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == want
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_small_sketches_still_find_links(make_docs):
    texts = variants(40, words_of=400, seed=4)
    want, _ = reference.components(texts, 3, 85, 100)
    rows = minhash_components(make_docs(texts), 3, 85, 100, k=96).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == want


def test_rounds_over_long_lists(make_docs, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "HUBS_IN_LIST", 3)
    texts = variants(60, seed=9)
    want, _ = reference.components(texts, 3, 85, 100)
    rows = minhash_components(make_docs(texts), 3, 85, 100).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == want


def test_components_of_a_table(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want, sizes = reference.components(texts, 3, 85, 100)
    rows = minhash_components(docs, 3, 85, 100).collect()
    assert {r["doc_id"]: (r["component_id"], r["n_shingles"]) for r in rows} == {
        i: (want[i], sizes[i]) for i in want
    }


def test_edge_rows(edge_docs, no_docs):
    rows = minhash_components(edge_docs, 3, 85, 100).collect()
    assert len(rows) == len(EDGE_ROWS)
    of = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] is not None}
    assert of[1] == of[2] == of[10] == 1 and of[3] == 1
    assert of[4] == 4 and of[5] == 5 and of[6] == 6
    nulls = sorted((r["component_id"], r["n_shingles"]) for r in rows if r["doc_id"] is None and r["n_shingles"])
    assert nulls and nulls[0][0] == 1
    assert minhash_components(no_docs, 3, 85, 100).count() == 0


def test_one_of_each_stays(edge_docs, no_docs):
    kept = keep_one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids.count(9) == 1 and 1 in ids and 2 not in ids and 10 not in ids
    # wordless texts are near nothing
    assert {4, 5, 6} <= set(ids)
    assert [r["text"] for r in kept.where("doc_id = 1").collect()] == [PROSE]
    assert keep_one_of_each(no_docs).count() == 0


def test_one_row_stays_for_each_component_whatever_its_ids(spark):
    a, b = PROSE + " " + PROSE[::-1], " ".join(f"other{i} word{i * 7}" for i in range(40))
    rows = [(3, a, 1), (7, a + " more", 2), (7, b, 3), (7, b + " more", 4), (8, b + " more", 5),
            (None, a, 6), (None, "a text with a null id of its own words here", 7),
            (9, "", 8), (9, None, 9), (9, b + " again", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h1 int")
    kept = sorted(r["h1"] for r in keep_one_of_each(docs).collect())
    assert kept[0] == 1 and 2 not in kept and 5 not in kept and 6 not in kept and 10 not in kept
    assert len({3, 4} & set(kept)) == 1
    assert {7, 8, 9} <= set(kept) and len(kept) == 5


def test_graph_components(spark):
    draw = random.Random(2)
    pairs = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(200)]
    pairs += [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 5000 + i) for i in range(1, 50)]
    root = {x: x for p in pairs for x in p}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    edges = spark.createDataFrame(pairs, "a long, b long")
    got = {r["node"]: r["root"] for r in graph_components(edges).collect()}
    assert got == {x: find(x) for x in got}
    assert set(got) >= {x for a, b in pairs if a != b for x in (a, b)}
    assert graph_components(spark.createDataFrame([], "a long, b long")).count() == 0
