"""The rows of a large document stay in the tasks that read them."""

import json
from datetime import datetime

import pytest

from martworks.plans import jobs
from martworks.sources.splitting import json_record_texts, xml_record_texts

AS_OF = datetime(2024, 2, 1)


@pytest.fixture()
def small_blocks(spark):
    for key, value in (("maxPartitionBytes", "4000"), ("openCostInBytes", "1")):
        spark.conf.set(f"spark.sql.files.{key}", value)
    yield
    for key in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{key}")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_an_xml_document_are_not_shuffled(spark, tmp_path, small_blocks):
    foods = [f"<food><name>{n}</name><carb>{'x' * (9000 if n == 7 else 9)}</carb></food>" for n in range(400)]
    path = tmp_path / "one.xml"
    path.write_text("<foods>\n" + "\n".join(foods) + "\n</foods>")
    texts = xml_record_texts(spark, str(path), "food")
    # what is done with the records doesn't read the document again
    assert "Scan text" not in _plan(texts)
    got = texts.orderBy("record").collect()
    assert [r["text"].strip() for r in got] == foods
    assert [r["record"] for r in got] == list(range(1, 401))


def test_rows_of_a_json_document_are_not_shuffled(spark, tmp_path, small_blocks):
    pets = [{"name": str(n), "tags": ["x" * (9000 if n == 7 else 9)]} for n in range(400)]
    path = tmp_path / "one.json"
    path.write_text(json.dumps({"pets": pets}))
    texts = json_record_texts(spark, str(path), "pets")
    assert "Scan text" not in _plan(texts)
    got = texts.orderBy("record").collect()
    assert [json.loads(r["text"]) for r in got] == pets


def test_a_key_that_ends_like_the_field_is_another(spark, tmp_path):
    doc = {"x{pets": [{"name": "a"}], 'x"pets': [{"name": "b"}], "pets": [{"name": "c"}]}
    path = tmp_path / "one.json"
    path.write_text(json.dumps(doc))
    got = json_record_texts(spark, str(path), "pets").collect()
    assert [json.loads(r["text"]) for r in got] == [{"name": "c"}]


@pytest.mark.parametrize("large", [False, True])
def test_a_new_table_takes_the_batch_once(spark, tmp_path, large):
    """With no table to merge into, nothing is looked up in it."""
    (tmp_path / "a.json").write_text(json.dumps({"pets": [{"name": "a", "species": "cat", "birthYear": 1}]}))
    out = jobs.json_job(spark, str(tmp_path), None, AS_OF, large=large)
    assert "LeftAnti" not in _plan(out)
    assert [r["name"] for r in out.collect()] == ["a"]
    folder = tmp_path / "xml"
    folder.mkdir()
    (folder / "a.xml").write_text("<foods><food><name>a</name></food></foods>")
    out = jobs.xml_job(spark, str(folder), AS_OF, large=large)
    assert "LeftAnti" not in _plan(out)
    assert [r["name"] for r in out.collect()] == ["a"]
