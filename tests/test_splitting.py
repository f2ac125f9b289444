"""One large document in several tasks, against the readers of whole files."""

import json
import random

import pytest
from pyspark.sql import types as T

from martworks import schemas
from martworks.sources import readers, splitting
from martworks.sources.splitting import DocumentError, read_large_json, read_large_xml

PET = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("more", T.StructType([T.StructField("a", T.IntegerType()), T.StructField("pets", T.StringType())])),
        T.StructField("n", T.DoubleType()),
    ]
)


@pytest.fixture()
def small_blocks(spark):
    """Files are cut into blocks of a few hundred bytes."""
    for key, value in (("maxPartitionBytes", "300"), ("openCostInBytes", "1")):
        spark.conf.set(f"spark.sql.files.{key}", value)
    yield
    for key in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{key}")


def _text(draw):
    parts = ['"', "\\", "{", "}", "[", "]", ",", ":", "pets", "\n", "é", "🙂", "a b", "\\\\", '\\"', ""]
    return "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))


def _pet(draw):
    return {
        "name": _text(draw),
        "tags": [_text(draw) for _ in range(draw.randint(0, 3))],
        "more": draw.choice([None, {}, {"a": draw.randint(0, 9), "pets": _text(draw)}]),
        "n": draw.choice([1, 2.5, -3e4, None]),
        _text(draw) + "x": [[1, 2], [{"deep": [_text(draw)]}]],
    }


def _rows(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


@pytest.mark.parametrize("seed", range(4))
def test_json_equals_the_whole_file_reader(spark, tmp_path, small_blocks, seed):
    draw = random.Random(seed)
    for n in range(3):
        doc = {
            "before": {"pets": [{"name": "not this"}], _text(draw): _text(draw)},
            "pets": [_pet(draw) for _ in range(draw.choice([0, 1, 40]))],
            "after": [_text(draw), [{"name": "nor this"}]],
        }
        keys = list(doc)
        draw.shuffle(keys)
        body = json.dumps({k: doc[k] for k in keys}, indent=draw.choice([None, 1]), ensure_ascii=draw.random() < 0.5)
        (tmp_path / f"{n}.json").write_text(body)
    path = str(tmp_path)
    got = read_large_json(spark, path, "pets", PET, position_col="at")
    want = readers.read_json_records(spark, path, "pets", PET)
    assert _rows(got.drop("at")) == _rows(want)
    for name in {r["at"]["file"] for r in got.select("at").collect()}:
        places = sorted(r["at"]["pos"] for r in got.where(got["at.file"] == name).select("at").collect())
        assert places == list(range(places[0], places[0] + len(places)))


def test_one_json_file_is_read_by_several_tasks(spark, tmp_path, small_blocks):
    draw = random.Random(9)
    doc = {"pets": [_pet(draw) for _ in range(60)]}
    path = tmp_path / "one.json"
    path.write_text(json.dumps(doc))
    rows = splitting._rows(spark, str(path), '"')
    assert rows.rdd.getNumPartitions() >= 4
    # records keep their order, whatever block they begin in
    got = read_large_json(spark, str(path), "pets", PET, position_col="at").orderBy("at").collect()
    assert [r["name"] for r in got] == [p["name"] for p in doc["pets"]]


@pytest.mark.parametrize(
    "body",
    ['{"pets": [{"name": "a"}', '{"pets": [{"name": "a}]}', '{"pets": [1, 2]}', '{"pets": ["x"]}',
     '{"pets": {"name": "x"}}', '{"pets": [{"name": "a"}, null]}'],
)
def test_json_that_does_not_fit_raises(spark, tmp_path, body):
    (tmp_path / "x.json").write_text(body)
    with pytest.raises(DocumentError):
        read_large_json(spark, str(tmp_path), "pets", PET).collect()


def test_json_without_the_array(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"other": [{"name": "x"}]}')
    (tmp_path / "b.json").write_text('{"pets": []}')
    (tmp_path / "c.json").write_text('{"other": {"pets": [{"name": "x"}]}, "pets": [{"name": "y"}]}')
    got = read_large_json(spark, str(tmp_path), "pets", PET)
    assert [r["name"] for r in got.collect()] == ["y"]


def _food(draw, deep=True):
    name = "".join(draw.choice(["a", " ", "&lt;", "&amp;", "é", "-"]) for _ in range(draw.randint(1, 8)))
    extra = draw.choice(
        ["", "<!-- <food><name>no</name></food> -->", "<seealso><food><name>nested</name></food></seealso>",
         '<calories total="1>2" fat=\'/\'/>', "<![CDATA[a > b]]>", "<food><name>inner</name></food>" if deep else ""]
    )
    return f"<food><name>{name}</name>{extra}<serving units=\"g\">{draw.randint(1, 99)}</serving></food>"


@pytest.mark.parametrize("seed", range(3))
def test_xml_equals_the_whole_file_reader(spark, tmp_path, small_blocks, seed):
    draw = random.Random(seed)
    for n in range(2):
        children = [
            draw.choice([_food(draw), _food(draw), "<drink><food><name>no</name></food></drink>",
                         "<!-- a > comment -->", "<food/>" if n else "<x/>", "<?pi <food?>".replace("<food", "food")])
            for _ in range(50)
        ]
        head = draw.choice(["", '<?xml version="1.0"?>\n', "<!-- first -->\n"])
        (tmp_path / f"{n}.xml").write_text(f"{head}<root>\n" + "\n".join(children) + "\n</root>\n")
    path = str(tmp_path)
    got = read_large_xml(spark, path, "food", schemas.FOOD, position_col="at")
    want = readers.read_xml_records(
        spark, path, "food", schemas.FOOD, direct_children_only=True, position_col="at"
    )
    plain = [c for c in got.columns if c != "at"]
    order = lambda df: [tuple(map(str, r)) for r in df.orderBy("at").select(*plain).collect()]
    assert order(got) == order(want)


def test_one_xml_file_is_read_by_several_tasks(spark, tmp_path, small_blocks):
    draw = random.Random(5)
    path = tmp_path / "one.xml"
    path.write_text("<root>" + "".join(_food(draw, deep=False) for _ in range(80)) + "</root>")
    assert splitting._rows(spark, str(path), "<").rdd.getNumPartitions() >= 4
    assert read_large_xml(spark, str(path), "food", schemas.FOOD).count() == 80


def test_xml_that_does_not_fit_raises(spark, tmp_path):
    for n, body in enumerate(["<root><food><name>x</name></food>", "<root><food><![CDATA[a < b]]></food></root>"]):
        folder = tmp_path / str(n)
        folder.mkdir()
        (folder / "x.xml").write_text(body)
        with pytest.raises(DocumentError):
            read_large_xml(spark, str(folder), "food", schemas.FOOD).collect()
