import json

from pyspark.sql import types as T

from martworks import schemas
from martworks.sources import readers

XML = """<root>
<food><name> spaced </name><name>second</name><serving units="g">29</serving></food>
<other><food><name>nested</name></food></other>
<food><name>b</name></food>
</root>"""


def test_xml_direct_children_first_name_spaces(spark, tmp_path):
    p = tmp_path / "f.xml"
    p.write_text(XML)
    direct = readers.read_xml_records(spark, str(p), "food", schemas.FOOD, direct_children_only=True)
    names = sorted(r["name"][0] for r in direct.collect())
    assert names == [" spaced ", "b"]
    anywhere = readers.read_xml_records(spark, str(p), "food", schemas.FOOD)
    assert anywhere.count() == 3
    row = [r for r in direct.collect() if r["name"][0] == " spaced "][0]
    assert row["serving"]["_units"] == "g" and row["serving"]["_VALUE"] == "29"


def test_json_records_missing_and_empty_array(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"pets": [{"name": "x"}, {"name": "y"}]}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"pets": []}))
    (tmp_path / "c.json").write_text(json.dumps({"nothing": 1}))
    df = readers.read_json_records(spark, str(tmp_path), "pets", schemas.PET)
    assert sorted(r["name"] for r in df.collect()) == ["x", "y"]
    pos = readers.read_json_records(spark, str(tmp_path / "a.json"), "pets", schemas.PET, position_col="p")
    assert [r["p"]["pos"] for r in pos.orderBy("p").collect()] == [0, 1]


def test_collection_drops_id(spark, tmp_path):
    p = tmp_path / "c.jsonl"
    p.write_text('{"_id": "1", "view_id": "v1", "start_time": "2025-02-01T10:00:00Z"}\n')
    df = readers.read_collection(spark, str(p), schemas.RAW_COLLECTIONS["movie_views"])
    assert "_id" not in df.columns and df.first()["view_id"] == "v1"


def test_csv_schema_and_inference(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_text("a,b\n1,2018-12-08\n")
    inferred = readers.read_csv(spark, str(p), infer=True)
    assert dict(inferred.dtypes) == {"a": "int", "b": "date"}
    given = readers.read_csv(spark, str(p), schema=T.StructType([T.StructField("a", T.StringType()),
                                                                 T.StructField("b", T.StringType())]))
    assert given.first()["b"] == "2018-12-08"
