"""In-place writers against the pure operators on random days, and their failure cases."""

import random
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martworks.operators import merge
from martworks.operators.transform import SchemaError
from martworks.sinks import merge_writers as mw
from martworks.sinks import writers

COLS = ["id", "v", "note", "loaded_at"]
SCHEMA = "id string, v int, note string, seq int, loaded_at timestamp_ntz"


def _rows(df, cols=("id", "v", "note")):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def _batch(spark, draw, day, nulls=True, n=14):
    keys = [f"k{i}" for i in range(12)] + ([None] if nulls else [])
    rows = [
        (draw.choice(keys), draw.randint(0, 99), draw.choice(["a", "b", None]), i,
         datetime(2024, 1, day, draw.randint(0, 23)))
        for i in range(draw.randint(0, n))
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("seed", range(3))
def test_day_reload_in_place_equals_the_pure_operator(spark, tmp_path, seed):
    draw, path = random.Random(seed), str(tmp_path / "t")
    table = spark.createDataFrame([], "id string, v int, note string, loaded_at timestamp_ntz")
    for day in (1, 2, 2, 3, 2, 4):
        batch = _batch(spark, draw, day, nulls=False)
        want = merge.reload_day(table, batch, ["id"], date(2024, 1, day), order_by=["seq"])
        want_rows = _rows(want)
        mw.reload_day_into(
            spark, batch.select(*COLS, "seq"), path, ["id"], date(2024, 1, day), order_by=["seq"]
        )
        stored = writers.stored_table(spark, path)
        got = [] if stored is None else _rows(stored)
        assert got == want_rows, (seed, day)
        table = spark.createDataFrame([tuple(r) for r in want.collect()], table.schema)


@pytest.mark.parametrize("seed", range(2))
def test_upsert_in_place_equals_the_pure_operator(spark, tmp_path, seed):
    draw, path = random.Random(seed), str(tmp_path / "t")
    schema = spark.createDataFrame([], "id string, v int, note string").schema
    table = spark.createDataFrame([], schema)
    for day in (1, 2, 3):
        batch = _batch(spark, draw, day)
        want = merge.upsert(table, batch, ["id"], ["seq"], update_cols=["v"])
        want_rows = _rows(want)
        before = {r["id"] for r in table.collect()}
        keys = {r["id"] for r in batch.collect()} - {None}
        counts = mw.upsert_into(
            spark, batch, path, ["id"], ["seq"], update_cols=["v"], buckets=5, schema=schema
        )
        assert _rows(spark.read.parquet(path)) == want_rows
        loners = batch.where("id is null").count()
        assert counts == {"inserted": len(keys - before) + loners, "updated": len(keys & before)}
        table = spark.createDataFrame([tuple(r) for r in want.collect()], schema)


@pytest.mark.parametrize("order_by", [None, ["seq"]])
def test_insert_ignore_in_place_equals_the_pure_operator(spark, tmp_path, order_by):
    draw, path = random.Random(5), str(tmp_path / "t")
    table = spark.createDataFrame([], SCHEMA)
    for day in (1, 2, 3):
        batch = _batch(spark, draw, day)
        want = merge.insert_ignore(table, batch, ["id"], order_by)
        want_rows = _rows(want)
        keys = [r["id"] for r in want.collect() if r["id"] is not None]
        assert len(keys) == len(set(keys))
        mw.insert_ignore_into(spark, batch, path, ["id"], order_by)
        assert _rows(spark.read.parquet(path)) == want_rows
        table = spark.createDataFrame([tuple(r) for r in want.collect()], SCHEMA)


def test_a_day_whose_rerun_brings_nothing_new_goes(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([("x", 1, None, 0, datetime(2024, 1, 1, 5))], SCHEMA)
    two = spark.createDataFrame([("y", 1, None, 0, datetime(2024, 1, 2, 5))], SCHEMA)
    mw.reload_day_into(spark, one, path, ["id"], date(2024, 1, 1))
    mw.reload_day_into(spark, two, path, ["id"], date(2024, 1, 2))
    mw.reload_day_into(spark, one, path, ["id"], date(2024, 1, 2))
    assert _rows(spark.read.parquet(path), ["id", "load_date"]) == [("x", date(2024, 1, 1))]


def test_another_number_of_buckets_is_refused(spark, tmp_path):
    rows = spark.createDataFrame([(f"k{i}", i, None, i, None) for i in range(20)], SCHEMA)
    path = str(tmp_path / "t")
    mw.upsert_into(spark, rows, path, ["id"], ["seq"], buckets=7)
    with pytest.raises(mw.LayoutError):
        mw.upsert_into(spark, rows, path, ["id"], ["seq"], buckets=9)
    assert spark.read.parquet(path).count() == 20
    # a table written by hand, without the note of its number
    other = str(tmp_path / "u")
    bucket = mw.key_bucket(["id"], 7)
    rows.withColumn("key_bucket", bucket).write.partitionBy("key_bucket").parquet(other)
    with pytest.raises(mw.LayoutError):
        mw.upsert_into(spark, rows, other, ["id"], ["seq"], buckets=9)
    mw.upsert_into(spark, rows, other, ["id"], ["seq"], buckets=7)
    assert spark.read.parquet(other).count() == 20


def test_first_load_keeps_every_column_and_the_stamp(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, "n", 3, None)], SCHEMA)
    path = str(tmp_path / "t")
    mw.upsert_into(spark, rows, path, ["id"], ["seq"], stamp=("done_at", "2024-05-01 00:00:00"))
    row = spark.read.parquet(path).first()
    assert row["seq"] == 3 and row["done_at"] == datetime(2024, 5, 1)


def test_a_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50_000).selectExpr("cast(id as string) as id", "id as v").write.parquet(path)
    batch = spark.createDataFrame([("5", 1), ("new", 2)], "id string, v long")
    with mw.Staging(spark) as staging:
        staged = staging.table(batch, "b")
        target = spark.read.parquet(path)
        carried = staging.keys(staged, ["id"])
        merged = merge.upsert(target, staged, ["id"], ["v"], known_keys=carried)
        assert merged.count() == 50_001
        for frame, kind in ((merged, "LeftAnti"),):
            frame.collect()
            plan = frame._jdf.queryExecution().executedPlan().toString()
            final = plan.split("== Initial Plan ==")[0]
            assert re.search(rf"BroadcastHashJoin.*{kind}", final)
            # between the scan of the target and the join there is no exchange
            lines = final.splitlines()
            at = next(i for i, x in enumerate(lines) if re.search(rf"BroadcastHashJoin.*{kind}", x))
            below = lines[at + 1 : next(i for i, x in enumerate(lines) if i > at and "FileScan" in x or "Scan parquet" in x and i > at)]
            assert not any("Exchange hashpartitioning" in x for x in below)


def test_only_a_missing_table_counts_as_empty(spark, tmp_path):
    assert writers.stored_table(spark, str(tmp_path / "none")) is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        writers.stored_table(spark, str(tmp_path / "bad"))


def test_a_source_column_the_target_lacks_raises(spark):
    target = spark.createDataFrame([(1, date(2024, 1, 1))], "id int, d date")
    source = target.withColumn("more", F.lit(1))
    with pytest.raises(SchemaError):
        merge.incremental_load(source, target, "d", date(1970, 1, 1))


def test_inclusive_loading_adds_each_key_once(spark):
    target = spark.createDataFrame([(1, date(2024, 1, 1))], "id int, d date")
    source = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 1)), (2, date(2024, 1, 2))], "id int, d date")
    out = merge.incremental_load(source, target, "d", date(1970, 1, 1), inclusive=True, keys=["id"])
    assert sorted(r["id"] for r in out.collect()) == [1, 2]
