"""End-to-end jobs on the golden sensor rows and on synthetic collections."""

import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martworks import schemas
from martworks.operators import merge
from martworks.plans import jobs
from martworks.plans.synth import synth_collections, write_collections

# Golden input: the ten saved sensor rows (top 5 by temp, then bottom 5).
GOLDEN = """id,room_id/id,noted_date,temp,out/in
__export__.temp_log_36405_139a524d,Room Admin,30-09-2018 17:29,51,Out
__export__.temp_log_36382_f6ec793e,Room Admin,30-09-2018 17:13,51,Out
__export__.temp_log_45212_789ddd3b,Room Admin,16-10-2018 08:19,50,Out
__export__.temp_log_43650_d488e3d3,Room Admin,15-10-2018 07:54,50,Out
__export__.temp_log_39798_c98bf35d,Room Admin,10-10-2018 09:40,50,Out
__export__.temp_log_177075_1afebd80,Room Admin,03-12-2018 11:02,21,In
__export__.temp_log_177074_72ce2c39,Room Admin,03-12-2018 11:02,21,In
__export__.temp_log_177088_176a7230,Room Admin,03-12-2018 11:05,22,In
__export__.temp_log_177084_41b19435,Room Admin,03-12-2018 11:05,22,In
__export__.temp_log_177082_f6b9414d,Room Admin,03-12-2018 11:05,22,In
"""


@pytest.fixture()
def golden_csv(tmp_path):
    p = tmp_path / "iot.csv"
    p.write_text(GOLDEN)
    return str(p)


def test_sensor_job_golden(spark, golden_csv, tmp_path):
    extremes, clean = jobs.sensor_job(spark, golden_csv, str(tmp_path / "out"))
    ids = [r["id"] for r in extremes.collect()]
    assert ids == [line.split(",")[0] for line in GOLDEN.strip().splitlines()[1:]]
    rows = clean.collect()
    assert len(rows) == 5
    assert {r["out/in"] for r in rows} == {"In"}
    assert {r["noted_date"] for r in rows} == {date(2018, 12, 3)}
    # M5 / M6 on the cleaned rows
    assert merge.high_watermark(clean, "noted_date", None) == date(2018, 12, 3)
    added = merge.new_rows_since(clean, "noted_date", date(2018, 12, 3)).count()
    assert added == 0
    assert merge.new_rows_since(clean, "noted_date", date(2018, 12, 2)).count() == 5


def test_parse_date_fails_on_bad_value(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text(GOLDEN.splitlines()[0] + "\nx,Room,not-a-date,20,In\n")
    with pytest.raises(Exception):
        jobs.sensor_job(spark, str(p))[1].collect()


def test_one_time_and_incremental_load(spark, golden_csv, tmp_path):
    profile = jobs.one_time_load(spark, golden_csv, str(tmp_path / "pq"), "golden_once",
                                 str(tmp_path / "tbl"))
    cols = [r["column_name"] for r in profile.orderBy("ordinal_position").collect()]
    assert cols == ["id", "room_id_id", "noted_date", "temp", "out_in"]
    assert {r["row_count"] for r in profile.collect()} == {10}
    src = spark.read.csv(golden_csv, header=True, schema=schemas.SENSOR_CSV).withColumn(
        "noted_date", F.to_date(F.to_timestamp("noted_date", "dd-MM-yyyy HH:mm")))
    spark.sql("DROP TABLE IF EXISTS inc_target")
    rep = jobs.incremental_job(spark, src, "inc_target", "noted_date", date(2018, 10, 1), date(2024, 1, 1))
    r = rep.first()
    assert r["new_rows"] == 8 and r["total_rows"] == 8  # three Out rows in October, five In
    rep2 = jobs.incremental_job(spark, src, "inc_target", "noted_date", date(2018, 10, 1), date(2024, 1, 1))
    assert rep2.first()["new_rows"] == 0 and rep2.first()["total_rows"] == 8


def test_json_job_upsert(spark, tmp_path):
    doc = {"pets": [
        {"name": "Purrsloud", "species": "Cat", "favFoods": ["wet food", "dry food"], "birthYear": 2016, "photo": "a"},
        {"name": "Barky", "species": "Dog", "birthYear": 2008, "photo": "b"},
        {"name": "Purrsloud", "species": "Cat", "favFoods": ["fish"], "birthYear": 2016, "photo": "c"},
        {"name": "Nully", "species": "Cat", "favFoods": [], "birthYear": None, "photo": "d"},
        {"name": "Nully", "species": "Cat", "favFoods": [], "birthYear": None, "photo": "e"},
    ]}
    path = tmp_path / "pets.json"
    path.write_text(json.dumps(doc, indent=2))
    out = jobs.json_job(spark, str(path), None, datetime(2024, 1, 1))
    rows = sorted(out.collect(), key=lambda r: (r["name"], r["photo"]))
    assert len(rows) == 4
    purr = [r for r in rows if r["name"] == "Purrsloud"][0]
    assert purr["favfoods"] == "fish" and purr["photo"] == "c"
    barky = [r for r in rows if r["name"] == "Barky"][0]
    assert barky["favfoods"] is None
    again = jobs.json_job(spark, str(path), out, datetime(2024, 1, 2))
    # keyed rows are updated in place; rows with a NULL birthYear never conflict, so they
    # are inserted again, as under a UNIQUE constraint
    assert again.count() == 6
    empty = tmp_path / "empty.json"
    empty.write_text(json.dumps({"other": []}))
    with pytest.raises(ValueError):
        jobs.json_job(spark, str(empty), None, datetime(2024, 1, 1))


NUTRITION = """<?xml version="1.0"?>
<nutrition>
<daily-values><total-fat units="g">65</total-fat></daily-values>
<food>
  <name>Avocado Dip</name><name>Ignored second name</name>
  <mfr> Sunnydale </mfr>
  <serving units="g">29</serving>
  <calories total="110" fat="100"/>
  <total-fat>2.675</total-fat><saturated-fat>x</saturated-fat>
  <cholesterol>12.7</cholesterol><sodium>-12.7</sodium><carb>5d</carb><fiber>nan</fiber><protein>inf</protein>
  <vitamins><a>0</a><c>0</c></vitamins>
  <minerals><ca>0</ca><fe>0</fe></minerals>
</food>
<group><food><name>Nested, not a direct child</name></food></group>
<food><name>Bagels</name><mfr>Gourmet</mfr><serving units="g">104</serving><calories total="300" fat="35"/></food>
<food><name>Bagels</name><mfr>Gourmet</mfr><serving units="g">105</serving><calories total="301" fat="35"/></food>
<food><name>Plain</name><serving>1</serving></food>
<food><name>Plain</name><serving>2</serving></food>
</nutrition>
"""


def test_xml_job(spark, tmp_path):
    path = tmp_path / "nutrition.xml"
    path.write_text(NUTRITION)
    out = jobs.xml_job(spark, str(path), datetime(2024, 1, 1))
    rows = {(r["name"], r["manufacturer"], str(r["serving_value"])): r for r in out.collect()}
    names = sorted(k[0] for k in rows)
    assert names == ["Avocado Dip", "Bagels", "Plain", "Plain"]  # NULL manufacturer twice: both stay
    avo = [r for k, r in rows.items() if k[0] == "Avocado Dip"][0]
    assert avo["manufacturer"] == " Sunnydale "  # spaces kept (X3)
    assert str(avo["total_fat"]) == "2.68" and avo["saturated_fat"] is None
    assert avo["cholesterol"] == 12 and avo["sodium"] == -12
    assert avo["carbohydrates"] is None and avo["fiber"] is None and avo["protein"] is None
    bagel = [r for k, r in rows.items() if k[0] == "Bagels"][0]
    assert bagel["calories_total"] == 301  # last row of a key wins


def test_replicate_and_build_marts(spark, tmp_path):
    raw = synth_collections(spark, scale=2, seed=7)
    paths = write_collections(raw, str(tmp_path / "export"))
    collections = jobs.read_collections(spark, paths)
    as_of = datetime(2025, 3, 1, 6, 0)
    first = jobs.replicate_collections(collections, schemas.empty_targets(spark), as_of)
    counts = {k: v.count() for k, v in first.items()}
    assert counts == {"movie_views": 200, "user_payments": 120, "content_ratings": 160, "search_queries": 100}
    for name, df in first.items():
        assert df.schema == schemas.TARGET_TABLES[name]
    frozen = {k: spark.createDataFrame(v.collect(), v.schema) for k, v in first.items()}
    second = jobs.replicate_collections(collections, frozen, as_of)
    for k in first:
        assert sorted(map(tuple, second[k].collect()), key=repr) == sorted(map(tuple, frozen[k].collect()), key=repr)
    pay = frozen["user_payments"].collect()
    assert {r["payment_method_category"] for r in pay} <= {"card", "digital", "voucher"}
    searches = frozen["search_queries"].collect()
    assert {r["filters_applied"] for r in searches if r["filters_applied"].startswith("{}")} <= {"{}"}
    out = jobs.build_marts(frozen, str(tmp_path / "marts"))
    assert out["mart_user_activity"].count() > 0
    assert out["distinct_users"].first()["unique_users"] > 0
    rates = {r["search_to_view_rate"] for r in out["mart_content_performance"].collect()}
    assert rates <= {100.0, None}


def test_replicate_in_place_twice_same_day(spark, tmp_path):
    raw = synth_collections(spark, scale=1, seed=3)
    paths = write_collections(raw, str(tmp_path / "export"))
    collections = jobs.read_collections(spark, paths)
    targets = {name: str(tmp_path / "tables" / name) for name in collections}
    as_of = datetime(2025, 3, 1, 6, 0)
    jobs.replicate_collections_into(spark, collections, targets, as_of)
    first = {k: sorted(map(tuple, spark.read.parquet(p).collect()), key=repr) for k, p in targets.items()}
    assert len(first["movie_views"]) == 100
    jobs.replicate_collections_into(spark, collections, targets, as_of)
    second = {k: sorted(map(tuple, spark.read.parquet(p).collect()), key=repr) for k, p in targets.items()}
    assert first == second
    # the daily flow: marts over the written tables
    out = jobs.build_marts({k: spark.read.parquet(p) for k, p in targets.items()}, str(tmp_path / "marts"))
    assert out["mart_payment_analysis"].count() > 0 and out["genre_summary"].count() > 0
