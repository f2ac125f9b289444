import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from martworks.llm import packing
from martworks.llm.packing import cut, pack, plan_fillings, slots
from martworks.llm.token_counts import count_tokens, counter
from tests.conftest import SF_MID
from tests.llm.conftest import EDGE_ROWS

PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def odd_texts(n=1500):
    draw = random.Random(5)
    signs = " \n\tab'é▁1. 　s<|>"
    made = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 40))) for _ in range(n)]
    return made + [
        "<s> </s><0x0A>", "a<|endoftext|> b\n <|endoftext|>", "x" * 4000, " " * 3000, "a\x00b \x85",
        "a  b   c ", "\n\n a\n  b", "it's we'll DON'T  're",
    ]


def test_counts_of_odd_texts():
    texts = odd_texts()
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert counter(PIECES).count(texts) == [len(x) for x in model.encode(texts)]


def test_proven_units_are_one_token():
    c = counter(PIECES)
    proven = [u for u in c.proven if u != " "]
    assert len(proven) > 10_000
    assert all(len(x) == 1 for x in c.model.encode([u[1:] for u in proven]))


def test_counts_of_edge_rows(spark, edge_docs, no_docs):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = count_tokens(edge_docs).collect()
    want = []
    for doc_id, text, *_ in EDGE_ROWS:
        n = len(model.encode(text or ""))
        want.append((doc_id, len((text or "").encode()), n, n > 4096))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert count_tokens(no_docs).count() == 0


def test_counts_of_a_table(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r["n_tokens"] for r in count_tokens(docs).collect()}
    assert got == {i: len(model.encode(t or "")) for i, t in texts.items()}


def test_ids_of_odd_texts(tokenizer):
    texts = odd_texts()
    own = packing.encoder(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )
    for text in texts:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert own.ids(text) == np.array(want, "<u4").tobytes(), text


@pytest.mark.parametrize("length", [1, 5, 2047, 2048, 2049, 4096, 10_000])
def test_cut(length):
    pieces = cut(length, 2048)
    assert sum(n for _, n in pieces) == length
    assert all(n == 2048 for _, n in pieces[1:])
    assert [a for a, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]


def test_plan_places_every_piece_once():
    draw = random.Random(3)
    counts = {size: draw.randint(1, 9) for size in draw.sample(range(1, 101), 60)}
    fillings = plan_fillings(counts, 100)
    used = {}
    for filling, times in fillings:
        assert sum(size * n for size, n in filling.items()) <= 100
        for size, n in filling.items():
            used[size] = used.get(size, 0) + n * times
    assert used == counts
    total = sum(size * n for size, n in counts.items())
    assert sum(t for _, t in fillings) <= -(-total // 100) * 1.03 + 1
    for size, entries in slots(fillings).items():
        assert entries[0][0] == 0


def check_packing(rows, texts, tokenizer, capacity=2048):
    """A packing of ``texts`` (list of (id, text)): every token once, gapless, few sequences."""
    want = []
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        raw = np.array(ids, "<u4").tobytes()
        for k, (a, n) in enumerate(cut(len(ids), capacity)):
            want.append((doc_id, k, a, n, zlib.crc32(raw[4 * a : 4 * (a + n)])))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    in_sequence = {}
    for r in rows:
        in_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in in_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(w[3] for w in want) // capacity)
    assert len(in_sequence) <= least * 1.02 + 1


def test_pack_edge_rows(edge_docs, no_docs, tokenizer):
    check_packing(pack(edge_docs).collect(), [(r[0], r[1]) for r in EDGE_ROWS], tokenizer)
    assert pack(no_docs).count() == 0


def test_pack_a_table(spark, tokenizer):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check_packing(pack(docs).collect(), texts, tokenizer)
