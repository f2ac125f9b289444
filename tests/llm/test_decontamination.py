import random

import pytest

from martworks.llm import decontaminate
from martworks.llm.decontaminate import Index, contaminated, decontaminated, hits, normalize
from tests.conftest import SF_MID
from tests.llm import reference
from tests.llm.conftest import EDGE_ROWS, PROSE


def plain(text):
    return "".join(map(chr, normalize([text])[0][1:-1]))


def test_normalize():
    assert plain("  Ab--c,\n\nD1! ") == "ab c d1"
    assert plain("") == plain(" ?") == ""
    codes, raw, starts = normalize(["A b", "", "c"])
    assert len(starts) == 4
    assert "".join(map(chr, codes)) == "\0a b\0\0c\0"


def edited(draw, text, share):
    out = list(text)
    for _ in range(int(len(text) * share)):
        j, kind = draw.randrange(len(out)), draw.random()
        if kind < 0.4:
            out[j] = draw.choice("qwxz")
        elif kind < 0.7:
            del out[j]
        else:
            out.insert(j, draw.choice("qwxz"))
    return "".join(out)


def test_against_full_alignment():
    """Every pattern within its budget is found, and nothing else."""
    draw = random.Random(7)
    vocabulary = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 8))) for _ in range(300)]
    say = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    items = [(i, say(draw.randint(4, 40))) for i in range(12)]
    index = Index(items)
    texts = []
    for _ in range(40):
        i, item = draw.choice(items)
        texts.append(say(draw.randint(0, 20)) + " " + edited(draw, item, draw.uniform(0, 0.2)) + " " + say(5))
    got = hits(index, texts)
    for t, text in enumerate(texts):
        flat = plain(text)
        for item_id, _ in items:
            patterns = [
                ("".join(map(chr, c)), e)
                for c, e, i in zip(index.codes, index.edits.tolist(), index.item)
                if i == item_id
            ]
            distances = [reference.edit_distance_inside(c, flat) for c, _ in patterns]
            n = sum(d <= e for d, (_, e) in zip(distances, patterns))
            assert got.get((t, item_id), [0])[0] == n, (t, item_id)
            if n:
                assert got[t, item_id][1] == min(d for d, (_, e) in zip(distances, patterns) if d <= e)


def test_excerpts_at_every_offset():
    draw = random.Random(3)
    say = lambda n: " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 8))) for _ in range(n))
    item = say(60)[:273].strip()
    index = Index([(1, item)])
    for n in (59, 80, 110):
        texts = [f"{say(12)} {item[a : a + n]} {say(12)}" for a in range(len(item) - n + 1)]
        # a space at the edge of an excerpt is one in the text as well
        assert {of for of, _ in hits(index, texts)} == set(range(len(texts))), n
    assert not hits(index, [say(40) for _ in range(50)])


def test_places():
    index = Index([(1, PROSE)])
    text = "Before. " + PROSE.upper().replace(" ", "  ") + " After."
    (n, edits, a, z), = hits(index, ["", text]).values()
    assert edits == 0 and n == len(index.codes)
    assert plain(text[a:z]) == plain(PROSE)


def test_table(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    bench = spark.read.parquet(f"{SF_MID}/benchmark.parquet")
    texts = {r["doc_id"]: plain(r["text"]) for r in docs.collect()}
    items = {r["item_id"]: plain(r["text"]) for r in bench.collect()}
    exact = {(d, i) for d, t in texts.items() for i, x in items.items() if f" {x} " in f" {t} "}
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, bench).collect()}
    assert exact and exact <= got
    # what is more than exact is within a few edits
    assert len(got - exact) <= 0.05 * len(exact) + 2
    left = {r["doc_id"] for r in decontaminated(docs, bench).select("doc_id").collect()}
    assert left == set(texts) - {d for d, _ in got}


def test_parts_of_a_large_benchmark(spark, make_docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "INDEX_CHARS", 200)
    draw = random.Random(1)
    say = lambda n: " ".join("".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    items = [(i, say(20)) for i in range(9)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = make_docs({i: say(10) + " " + t + " " + say(10) for i, t in items} | {100: say(50)})
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(docs, bench).collect()} == {(i, i) for i in range(9)}
    assert [r["doc_id"] for r in decontaminated(docs, bench).collect()] == [100]


def test_edge_rows(spark, edge_docs, no_docs):
    items = [(1, PROSE), (2, None), (3, ""), (4, "short"), (None, PROSE), (1, PROSE)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = contaminated(edge_docs, bench).collect()
    assert sorted((r["doc_id"] for r in rows), key=str) == [1, 10, 2, 3, None]
    kept = decontaminated(edge_docs, bench)
    assert kept.schema == edge_docs.schema
    assert kept.count() == len(EDGE_ROWS) - 5
    none = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(edge_docs, none).count() == 0
    assert decontaminated(edge_docs, none).count() == len(EDGE_ROWS)
    assert contaminated(no_docs, bench).count() == decontaminated(no_docs, bench).count() == 0


def test_items_without_an_id(spark, make_docs):
    docs = make_docs({1: "Before. " + PROSE + " After.", 2: "nothing of it is here at all, only a calm day"})
    for kind, item_id in (("long", None), ("string", "a7")):
        bench = spark.createDataFrame([(item_id, PROSE)], f"item_id {kind}, text string")
        assert [(r["doc_id"], r["item_id"]) for r in contaminated(docs, bench).collect()] == [(1, None)]
        assert [r["doc_id"] for r in decontaminated(docs, bench).collect()] == [2]
