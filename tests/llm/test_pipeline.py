import re

import pytest
from tokenizers import Tokenizer

import public_tokenizers

import __spark_entry__ as entry
import corpus_pipeline
from martworks.llm import toxicity
from martworks.llm.common import read_table, staged
from tests.conftest import SF_SMALL
from tests.llm import reference
from tests.llm.test_counts_and_packing import check_packing
from tests.llm.test_decontamination import plain


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage was given and gave."""
    docs, out = read_table(spark, SF_SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, docs, SF_SMALL), name)
        out.append((name, docs, after))
        docs = after
    return out


def test_stages(stages):
    assert [s[0] for s in stages] == ["toxicity", "near_dedup", "decontamination", "pii", "pack"]
    for name, before, after in stages[:-1]:
        assert after.schema.simpleString() == before.schema.simpleString(), name
        if name != "pii":
            assert after.exceptAll(before).count() == 0, name


def test_toxicity_stage(spark, stages):
    _, before, after = stages[0]
    labels = read_table(spark, SF_SMALL, "labels")
    scored = toxicity.score_documents(before, labels).where("predicted = 0")
    assert {r["doc_id"] for r in scored.collect()} == {r["doc_id"] for r in after.collect()}


def test_near_dedup_stage(stages):
    _, before, after = stages[1]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    roots, _ = reference.components(texts, 5, 80, 100)
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(set(roots.values()))


def test_decontamination_stage(spark, stages):
    _, before, after = stages[2]
    items = [plain(r["text"]) for r in read_table(spark, SF_SMALL, "benchmark").collect()]
    kept = {r["doc_id"] for r in after.collect()}
    dirty = {r["doc_id"] for r in before.collect() if any(x in plain(r["text"]) for x in items)}
    assert not dirty & kept
    assert len(kept) >= before.count() - len(dirty) - 1


def test_pii_stage(stages):
    _, before, after = stages[3]
    texts = {r["doc_id"]: r["text"] for r in before.collect()}
    for r in after.collect():
        assert r["n_chars"] == len(r["text"])
        for mail in re.findall(r"[\w.]+@[\w.]+\w", texts[r["doc_id"]]):
            assert mail not in r["text"]
    assert after.count() == before.count()


def test_pack_stage(stages):
    _, before, after = stages[4]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    check_packing(after.collect(), [(r["doc_id"], r["text"]) for r in before.collect()], tokenizer)


def test_run_is_registered(spark, stages):
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    rows = corpus_pipeline.run(spark, SF_SMALL)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, rows.select(names).collect())) == sorted(
        map(tuple, stages[-1][2].select(names).collect())
    )


def test_stages_on_edge_rows(spark, edge_docs, no_docs):
    for frame in (edge_docs, no_docs):
        docs = frame
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = staged(stage(spark, docs, SF_SMALL), name)
            assert docs.columns == frame.columns
        assert (corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count() > 0) == (frame is edge_docs)


def test_every_operator_has_a_query():
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in entry.queries()) == 1
