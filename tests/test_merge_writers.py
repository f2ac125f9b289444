from datetime import date, datetime

from pyspark.sql import functions as F

from martworks.operators import merge
from martworks.sinks.merge_writers import insert_ignore_into, reload_day_into

SCHEMA = "id string, v int, loaded_at timestamp_ntz"


def _rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_insert_ignore_into_appends_only_new_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1, None), ("b", 1, None)], SCHEMA)
    insert_ignore_into(spark, first, path, ["id"])
    second = spark.createDataFrame([("b", 2, None), ("c", 2, None)], SCHEMA)
    insert_ignore_into(spark, second, path, ["id"])
    insert_ignore_into(spark, second, path, ["id"])  # rerun adds nothing
    got = spark.read.parquet(path)
    assert _rows(got, "id", "v") == [("a", 1), ("b", 1), ("c", 2)]
    want = merge.insert_ignore(first, second, ["id"])
    assert _rows(got, "id", "v") == _rows(want, "id", "v")


def test_reload_day_into_replaces_only_the_day(spark, tmp_path):
    path = str(tmp_path / "t")
    d1 = spark.createDataFrame([("old", 1, datetime(2024, 1, 1, 5))], SCHEMA)
    reload_day_into(spark, d1, path, ["id"], date(2024, 1, 1))
    first_run = spark.createDataFrame(
        [("old", 2, datetime(2024, 1, 2, 5)), ("x", 2, datetime(2024, 1, 2, 5)), ("y", 2, datetime(2024, 1, 2, 5))],
        SCHEMA,
    )
    reload_day_into(spark, first_run, path, ["id"], date(2024, 1, 2))
    rerun = spark.createDataFrame(
        [("old", 3, datetime(2024, 1, 2, 9)), ("x", 3, datetime(2024, 1, 2, 9))], SCHEMA
    )
    reload_day_into(spark, rerun, path, ["id"], date(2024, 1, 2))
    got = spark.read.parquet(path)
    # the day-1 row wins; the rerun replaced the whole day-2 partition (y is gone)
    assert _rows(got, "id", "v", "load_date") == [
        ("old", 1, date(2024, 1, 1)), ("x", 3, date(2024, 1, 2))
    ]
    before = _rows(got, "id", "v", "load_date")
    reload_day_into(spark, rerun, path, ["id"], date(2024, 1, 2))
    assert _rows(spark.read.parquet(path), "id", "v", "load_date") == before
    reload_day_into(spark, rerun.limit(0), path, ["id"], date(2024, 1, 2))
    assert _rows(spark.read.parquet(path), "id", "v", "load_date") == before


def test_reload_day_into_matches_pure_operator(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.createDataFrame(
        [(f"k{i}", i, datetime(2024, 1, 1 + i % 5, 3)) for i in range(40)], SCHEMA
    )
    for d in range(1, 6):
        reload_day_into(spark, base.where(F.dayofmonth("loaded_at") == d), path, ["id"], date(2024, 1, d))
    batch = spark.createDataFrame(
        [(f"k{i}", 100 + i, datetime(2024, 1, 5, 8)) for i in range(0, 60, 3)], SCHEMA
    )
    target = spark.read.parquet(path)
    want = merge.reload_day(target, batch, ["id"], date(2024, 1, 5), load_date_col="load_date")
    want_rows = _rows(want, "id", "v")
    reload_day_into(spark, batch, path, ["id"], date(2024, 1, 5))
    assert _rows(spark.read.parquet(path), "id", "v") == want_rows


def test_reload_day_into_drops_later_days(spark, tmp_path):
    path = str(tmp_path / "t")
    for d in (1, 2, 3):
        rows = spark.createDataFrame([(f"k{d}", d, datetime(2024, 1, d, 5))], SCHEMA)
        reload_day_into(spark, rows, path, ["id"], date(2024, 1, d))
    batch = spark.createDataFrame([("k3", 9, datetime(2024, 1, 2, 7))], SCHEMA)
    reload_day_into(spark, batch, path, ["id"], date(2024, 1, 2))
    assert _rows(spark.read.parquet(path), "id", "v", "load_date") == [
        ("k1", 1, date(2024, 1, 1)), ("k3", 9, date(2024, 1, 2))
    ]


def test_upsert_into_rewrites_only_touched_buckets(spark, tmp_path):
    from martworks.sinks.merge_writers import upsert_into

    path = str(tmp_path / "t")
    schema = "id string, v int, seq int"
    first = spark.createDataFrame([(f"k{i}", i, 1) for i in range(200)], schema)
    upsert_into(spark, first, path, ["id"], ["seq"], buckets=64)
    files_before = {f for f in spark.read.parquet(path).inputFiles()}
    batch = spark.createDataFrame([("k5", 50, 1), ("k5", 55, 2), ("new", 1, 1), (None, 7, 1)], schema)
    upsert_into(spark, batch, path, ["id"], ["seq"], buckets=64)
    got = spark.read.parquet(path)
    want = merge.upsert(first.drop("seq"), batch, ["id"], ["seq"])
    assert _rows(got, "id", "v") == _rows(want, "id", "v")
    files_after = {f for f in got.inputFiles()}
    assert len(files_before & files_after) >= len(files_before) - 3  # at most 3 buckets rewritten
    before = got.count()
    upsert_into(spark, batch, path, ["id"], ["seq"], buckets=64)  # rerun: NULL-key row inserted again
    assert spark.read.parquet(path).count() == before + 1
