"""S1 with quarantine: every line is a good row or a rejected one."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.operators.quality import DataQualityError
from martworks.plans import jobs
from martworks.sources import readers
from martworks.sources.quarantine import read_csv_checked

SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("day", T.DateType()),
    ]
)
LINES = {
    "a.csv": [
        "1,10,1.5,2024-01-01",
        '2,10,"2,5",2024-01-01',
        "3,ten,abc,2024-01-01",
        "4,,,",
        "5,1",
        "6,1,2.5,2024-01-01,more",
        "7,99999999999,1e3,2024-02-30",
    ],
    "b.csv": ["8,8,8.0,2024-08-08", "9,9.5,8.0,2024-08-08"],
}


@pytest.fixture()
def csv_dir(tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    for name, lines in LINES.items():
        (folder / name).write_text("\n".join(["id,n,x,day", *lines]) + "\n")
    return str(folder)


def test_every_line_is_good_or_rejected(spark, csv_dir, tmp_path):
    found = read_csv_checked(spark, csv_dir, SCHEMA, str(tmp_path / "rejects"))
    assert (found.rows, found.rejects) == (9, 6)
    assert found.good.schema == SCHEMA
    assert sorted(r["id"] for r in found.good.collect()) == ["1", "4", "8"]
    rejects = {r["line"]: (r["file"].rsplit("/", 1)[1], r["columns"]) for r in found.rejected.collect()}
    assert rejects == {
        '2,10,"2,5",2024-01-01': ("a.csv", ["x"]),
        "3,ten,abc,2024-01-01": ("a.csv", ["n", "x"]),
        "5,1": ("a.csv", []),
        "6,1,2.5,2024-01-01,more": ("a.csv", []),
        "7,99999999999,1e3,2024-02-30": ("a.csv", ["n", "day"]),
        "9,9.5,8.0,2024-08-08": ("b.csv", ["n"]),
    }
    # a narrower use of the good rows doesn't bring rejected ones back
    assert found.good.select("id").count() == 3


def test_a_rerun_replaces_the_rejects(spark, csv_dir, tmp_path):
    for _ in range(2):
        found = read_csv_checked(spark, csv_dir, SCHEMA, str(tmp_path / "rejects"))
    assert found.rejected.count() == 6


def test_fails_without_a_place_for_rejects_and_beyond_the_limit(spark, csv_dir, tmp_path):
    with pytest.raises(DataQualityError, match="6 of 9 rows"):
        read_csv_checked(spark, csv_dir, SCHEMA)
    with pytest.raises(DataQualityError):
        read_csv_checked(spark, csv_dir, SCHEMA, str(tmp_path / "r"), at_most=5)
    assert read_csv_checked(spark, csv_dir, SCHEMA, str(tmp_path / "r"), at_most=6).rejects == 6


def test_checks_on_typed_rows(spark, csv_dir, tmp_path):
    checks = {"n": F.col("n") != 8, "id": F.col("id") != "8"}
    found = read_csv_checked(spark, csv_dir, SCHEMA, str(tmp_path / "r"), checks, "_arrival")
    row = found.rejected.where(F.col("line").startswith("8,")).first()
    assert sorted(row["columns"]) == ["id", "n"] and found.rejects == 7
    assert found.good.columns == ["id", "n", "x", "day", "_arrival"]
    order = [r["id"] for r in found.good.orderBy("_arrival").collect()]
    assert order == ["1", "4"]


def test_clean_and_empty_files(spark, tmp_path):
    (tmp_path / "clean.csv").write_text("id,n,x,day\n1,1,1,2024-01-01\n")
    (tmp_path / "empty.csv").write_text("id,n,x,day\n")
    clean = read_csv_checked(spark, str(tmp_path / "clean.csv"), SCHEMA)
    assert (clean.rows, clean.rejects, clean.rejected.count()) == (1, 0, 0)
    empty = read_csv_checked(spark, str(tmp_path / "empty.csv"), SCHEMA, str(tmp_path / "r"))
    assert (empty.rows, empty.good.count(), empty.rejected.count()) == (0, 0, 0)


def test_plain_reader_fails_instead_of_filling_null(spark, csv_dir):
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_csv(spark, csv_dir, schema=SCHEMA).collect()


READINGS = "id,room_id/id,noted_date,temp,out/in\n"


def test_sensor_job_loses_no_reading_silently(spark, tmp_path):
    rows = [f"r{i},room,08-12-2018 09:{i:02d},{20 + i},In" for i in range(20)]
    bad = ['b1,room,08-12-2018 09:00,"21,5",In', "b2,room,08-12-2018 09:00,abc,In",
           "b3,room,8 December,21,In"]
    out = "o1,room,not a date,21,Out"
    path = tmp_path / "temp.csv"
    path.write_text(READINGS + "\n".join([*rows, *bad, out]) + "\n")
    with pytest.raises(DataQualityError, match="3 of 24"):
        jobs.sensor_job(spark, str(path))
    _, clean = jobs.sensor_job(spark, str(path), rejects_path=str(tmp_path / "rejects"))
    assert clean.count() == 18
    rejects = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert sorted((r["line"].split(",")[0], tuple(r["columns"])) for r in rejects) == [
        ("b1", ("temp",)), ("b2", ("temp",)), ("b3", ("noted_date",)),
    ]
