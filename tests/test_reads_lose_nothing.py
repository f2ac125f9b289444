"""Values, fields and documents that a reader must not drop."""

import json
from datetime import datetime

import pytest

from martworks import schemas
from martworks.functions.columns import map_values
from martworks.operators.transform import SchemaError, coerce_numeric
from martworks.plans import jobs
from martworks.sources import readers
from pyspark.sql import functions as F


def test_numeric_text(spark):
    values = ["90", "90.0", "9.99", "5d", " 7 ", "", "1e3", None, "9999999999"]
    df = spark.createDataFrame([(v, v) for v in values], "whole string, real string")
    out = coerce_numeric(coerce_numeric(df, ["whole"], "int"), ["real"])
    assert [r["whole"] for r in out.collect()] == [90, 90, 9, None, 7, None, 1000, None, None]
    assert [r["real"] for r in out.collect()] == [90.0, 90.0, 9.99, None, 7.0, None, 1000.0, None, 9999999999.0]


@pytest.mark.parametrize("n", [1, 64, 65, 200])
def test_map_values_is_one_rule(spark, n):
    mapping = {f"k{i}": f"v{i}" for i in range(n)} | {"none": None}
    df = spark.createDataFrame([("k0",), ("none",), ("other",), (None,)], "c string")
    got = [r[0] for r in df.select(map_values("c", mapping, "default")).collect()]
    assert got == ["v0", "default", "default", "default"]


def _view(**more):
    return {
        "view_id": "v1", "user_id": "u", "movie_id": "m", "movie_title": "t", "genre": "g",
        "start_time": "2025-02-01T10:00:00Z", "end_time": None, "watch_duration_minutes": 90,
        "completed": True, "device": {"type": "tv", "os": "x"}, "interactions": [],
    } | more


def _load(spark, tmp_path, docs):
    path = tmp_path / "views.json"
    path.write_text("\n".join(json.dumps(d) for d in docs))
    raw = jobs.read_collections(spark, {"movie_views": str(path)})
    target = spark.createDataFrame([], schemas.TARGET_TABLES["movie_views"])
    return jobs.replicate_collections(raw, {"movie_views": target}, datetime(2025, 3, 1))["movie_views"]


def test_numbers_of_any_form_and_nested_keys_survive(spark, tmp_path):
    docs = [
        _view(view_id="a", watch_duration_minutes="90"),
        _view(view_id="b", watch_duration_minutes=90.0),
        _view(view_id="c", interactions=[{"type": "pause", "extra": {"deep": 1}}]),
    ]
    rows = {r["view_id"]: r for r in _load(spark, tmp_path, docs).collect()}
    assert {k: r["watch_duration_minutes"] for k, r in rows.items()} == {"a": 90, "b": 90, "c": 90}
    assert json.loads(rows["c"]["interactions"]) == [{"type": "pause", "extra": {"deep": 1}}]


def test_an_undeclared_field_is_reported(spark, tmp_path):
    with pytest.raises(SchemaError, match="surprise"):
        _load(spark, tmp_path, [_view(), _view(view_id="v2", surprise=1)])


def test_a_malformed_document_fails(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"pets": [{"name": "a"}]}')
    (tmp_path / "bad.json").write_text('{"pets": [{"name": ')
    with pytest.raises(Exception):
        readers.read_json_records(spark, str(tmp_path / "*.json"), "pets", schemas.PET).collect()


@pytest.mark.parametrize("direct", [True, False])
def test_a_malformed_xml_document_fails(spark, tmp_path, direct):
    (tmp_path / "a.xml").write_text("<foods><food><name>x</name></food></foods>")
    (tmp_path / "b.xml").write_text("<foods><food><name>y</na")
    rows = readers.read_xml_records(
        spark, str(tmp_path / "*.xml"), "food", schemas.FOOD, direct_children_only=direct
    )
    with pytest.raises(Exception):
        rows.collect()


def test_xml_files_apply_in_the_order_of_their_names(spark, tmp_path):
    food = "<food><name>x</name><mfr>m</mfr><sodium>{}</sodium>{}</food>"
    (tmp_path / "a.xml").write_text("<foods>" + food.format(1, "<carb>0</carb>" * 1) + "<!-- " + "long " * 20_000 + "--></foods>")
    (tmp_path / "b.xml").write_text("<foods>" + food.format(2, "") + "</foods>")
    rows = jobs.xml_job(spark, str(tmp_path / "*.xml"), datetime(2025, 1, 1)).collect()
    assert [r["sodium"] for r in rows] == [2]


def test_fractional_readings_stay(spark, tmp_path):
    path = tmp_path / "t.csv"
    lines = [f"s{i},room,01-01-2024 10:{i:02d},{20 + i / 2},In" for i in range(41)]
    path.write_text("id,room_id/id,noted_date,temp,out/in\n" + "\n".join(lines))
    extremes, clean = jobs.sensor_job(spark, str(path))
    assert {r["temp"] for r in extremes.collect()} >= {40.0, 39.5, 20.0, 20.5}
    assert clean.count() == 37


def test_work_folder_of_a_cluster_has_to_be_named(spark, monkeypatch):
    from martworks import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return self

        def get(self, *_):
            return None

    class Session:
        sparkContext = Context()
        conf = Context()

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())
