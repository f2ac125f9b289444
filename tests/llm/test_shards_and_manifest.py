import hashlib
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from martworks.llm import merkle, sharding
from martworks.llm.merkle import document_manifest, fold, proof_digest
from martworks.llm.sharding import read_shards, shard_documents, write_shards
from tests.conftest import SF_MID

# -- shards --------------------------------------------------------------------------------


def _rows(frame, shards=24):
    """Rows by shard in slot order, after the laws are checked."""
    by: dict[int, list] = {}
    for r in frame.collect():
        by.setdefault(r["shard"], []).append(r)
    for rows in by.values():
        rows.sort(key=lambda r: r["slot"])
        assert [r["slot"] for r in rows] == list(range(len(rows)))
    counts = [len(by.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(by) <= set(range(shards))
    return by


def test_documents_table(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = shard_documents(docs, stored=True)
    by = _rows(got)
    rows = [r for own in by.values() for r in own]
    want = {
        (r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode()))
        for r in docs.collect()
    }
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == want
    assert len(rows) == docs.count()
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}
    assert dict(got.dtypes) == {
        "doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string",
        "shard": "int", "slot": "bigint", "grown_shard": "int",
    }


def test_files_in_name_order_are_the_slots_in_order(spark, tmp_path):
    path = str(tmp_path / "s")
    table = spark.range(5000).withColumn("text", F.repeat(F.lit("x"), 100))
    write_shards(table, path, shards=7, bucket_bytes=40_000)
    for shard in range(7):
        files = sorted((tmp_path / "s" / f"shard={shard}").glob("part-*.parquet"))
        assert len(files) > 1
        slots = [r["slot"] for f in files for r in spark.read.parquet(str(f)).collect()]
        assert slots == list(range(len(slots)))
    _rows(read_shards(spark, path, table.schema), 7)


def test_seed_decides_the_order_and_files_alone_do(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(3000).repartition(3).write.parquet(source)
    orders = []
    for n, (seed, split) in enumerate([(1, "128m"), (1, "2k"), (2, "128m")]):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        table = spark.read.parquet(source)
        made = write_shards(table, str(tmp_path / f"o{n}"), 5, seed, 4000, stored=True)
        orders.append([r["record"]["id"] for r in made.orderBy("shard", "slot").collect()])
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert orders[0] == orders[1] != orders[2]
    assert sorted(orders[0]) == sorted(orders[2]) == list(range(3000))


def test_order_is_even(spark, tmp_path):
    """Each fifth of the table is spread over all places, pairs of neighbours part."""
    table = spark.range(10_000)
    made = write_shards(table, str(tmp_path / "o"), 10, bucket_bytes=8000)
    order = [r["record"]["id"] for r in made.orderBy("shard", "slot").collect()]
    for a in range(0, 10_000, 2000):
        counts = Counter(x // 2000 for x in order[a : a + 2000])
        assert all(300 < counts[c] < 500 for c in range(5))
    assert sum(abs(a - b) == 1 for a, b in zip(order, order[1:])) < 12


def test_identical_rows_are_spread(spark, tmp_path):
    table = spark.range(6000).select(F.lit(1).alias("doc_id"), F.lit("same text").alias("text"))
    made = write_shards(table, str(tmp_path / "o"), 4, bucket_bytes=10_000)
    assert _rows(made, 4) and made.count() == 6000
    files = list((tmp_path / "o").rglob("part-*.parquet"))
    assert max(spark.read.parquet(str(f)).count() for f in files) < 1000


def test_shard_edge_rows(spark, edge_docs, no_docs, tmp_path):
    got = shard_documents(edge_docs)
    rows = [r for own in _rows(got).values() for r in own]
    want = Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 8) for r in edge_docs.collect()
    )
    assert Counter((r["doc_id"], r["size"]) for r in rows) == want
    assert shard_documents(no_docs).count() == 0
    clash = spark.createDataFrame([(1, 2, 3)], "shard int, slot int, record int")
    made = write_shards(clash, str(tmp_path / "c"), 3)
    assert made.select("record.*").first().asDict() == {"shard": 1, "slot": 2, "record": 3}
    with pytest.raises(ValueError):
        write_shards(clash, str(tmp_path / "d"), 0)


def test_no_python_in_the_plans(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    plan = shard_documents(docs, stored=True)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- manifest ------------------------------------------------------------------------------


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _leaf(row, text):
    return H("".join(map(_field, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text))))


def _tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        at = levels[-1]
        levels.append([H("".join(at[i : i + 3])) for i in range(0, len(at), 3)])
    return levels


def _siblings(levels, i):
    out = []
    for at in levels[:-1]:
        start = i // 3 * 3
        out.append(("".join(at[start:i]), "".join(at[i + 1 : start + 3])))
        i //= 3
    return out


def by_hand(rows):
    groups: dict = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r, _leaf(r, r["text"])))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        groups[s].sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
    trees = {s: _tree([leaf for _, leaf in groups[s]]) for s in sources}
    top = _tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, (r, leaf) in enumerate(groups[s]):
            path = _siblings(trees[s], i) + _siblings(top, k)
            text, number = r["text"], "" if r["doc_id"] is None else str(r["doc_id"])
            if text is not None and zlib.crc32(number.encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = _leaf(r, text)
            for left, right in path:
                node = H(left + node + right)
            proof = H("".join(a + b for a, b in path))
            root = top[-1][0]
            out.append((r["doc_id"], leaf, trees[s][-1][0], root, proof, node, node == root))
    return sorted(out, key=str)


def _found(frame):
    return sorted(map(tuple, document_manifest(frame).collect()), key=str)


def test_manifest_of_the_documents_table(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = _found(docs)
    assert got == by_hand([r.asDict() for r in docs.collect()])
    assert 0 < sum(r[-1] for r in got) < len(got)


@pytest.mark.parametrize("seed", range(3))
def test_uneven_groups(spark, seed, monkeypatch):
    """Groups of 1 to 250 leaves, ids and whole rows that repeat, null groups and ids."""
    monkeypatch.setattr(merkle, "BROADCAST_ROWS", 0 if seed else 200_000)
    draw = random.Random(seed)
    rows = []
    for g, n in enumerate([1, 2, 3, 4, 9, 10, 27, 28, 81, 82, 250]):
        source = [None, "", "ä", "a", "Z", "€"][g] if g < 6 else f"s{g}"
        for _ in range(n):
            doc_id = draw.choice([None, draw.randint(0, 40), draw.randint(0, 10**6)])
            text = draw.choice([None, "", "line\nline", "plain", "x\n" * draw.randint(1, 5)])
            rows.append((doc_id, text, draw.choice(["en", None]), source, draw.choice([None, 7])))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(rows, schema).repartition(6)
    assert _found(frame) == by_hand([r.asDict() for r in frame.collect()])


def test_manifest_edge_rows(spark, edge_docs, no_docs):
    assert _found(edge_docs) == by_hand([r.asDict() for r in edge_docs.collect()])
    assert document_manifest(no_docs).count() == 0
    one = edge_docs.limit(1)
    row = document_manifest(one).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == H("")


def test_only_every_third_level_is_stored(spark):
    leaves = spark.range(1000).select(
        F.lit(0).cast("long").alias("tree"), F.col("id").alias("pos"),
        F.lit(1000).cast("long").alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("digest"),
    )
    forest = merkle.build(leaves)
    # 1000 leaves have 334 + 112 + 38 + 13 + 5 + 2 + 1 nodes above them
    assert [level.select(F.sum(F.size("nodes"))).first()[0] for level in forest.levels] == [
        1000, 38, 2, 1,
    ]
    assert max(r[0] for level in forest.levels for r in level.select(F.size("nodes")).collect()) <= 27


def test_a_proof_that_was_changed_fails(spark):
    steps = [("aa", "bb"), ("", "cc"), ("dd", "")]
    frame = spark.createDataFrame([(steps, H("leaf"))], "path array<struct<left:string,right:string>>, leaf string")
    row = frame.select(fold(F.col("leaf"), F.col("path")).alias("f"), proof_digest(F.col("path")).alias("p")).first()
    assert row["f"] == H("dd" + H(H("aa" + H("leaf") + "bb") + "cc"))
    assert row["p"] == H("aabbccdd")
