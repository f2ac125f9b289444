"""The key table beside a stored table."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martworks.sinks import key_index
from martworks.sinks import merge_writers as mw
from martworks.sinks.key_index import BUCKET, FILE, KeyIndex

SCHEMA = "id long, v string"


def _frame(spark, ids, v="x"):
    return spark.createDataFrame([(i, v) for i in ids], SCHEMA)


def _present(spark, index, path, ids, counts=None):
    target = spark.read.parquet(path)
    found = index.present(target, _frame(spark, ids).select("id").distinct(), counts)
    return sorted(r["id"] for r in found.collect())


def _plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_present_keys_and_no_scan_of_the_target(spark, tmp_path):
    path = str(tmp_path / "with space" / "t")
    _frame(spark, range(1000)).repartition(4).write.parquet(path)
    index = KeyIndex(spark, path, ["id"], 32)
    assert _present(spark, index, path, [5, 999, 1000, 2000]) == [5, 999]
    target = spark.read.parquet(path)
    batch = _frame(spark, [7, 5000]).select("id")
    touched = index.touched(batch)
    assert len(touched) <= 2
    plan = _plan(index.present(target, batch))
    # only the touched buckets of the key table are read, and no file of the target
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert all(f"{BUCKET}" in line for line in filters) and filters
    for bucket in touched:
        assert any(str(bucket) in line for line in filters)
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all(f"ReadSchema: struct<id:bigint,{FILE}" in line for line in scans)
    # a reader of the target sees no key table
    assert spark.read.parquet(path).count() == 1000


def test_only_new_files_are_entered(spark, tmp_path):
    path = str(tmp_path / "t")
    _frame(spark, range(100)).write.parquet(path)
    index = KeyIndex(spark, path, ["id"], 8)
    assert _present(spark, index, path, [1, 150]) == [1]
    entered = spark.read.parquet(index.entries_path).count()
    _frame(spark, range(100, 200)).coalesce(1).write.mode("append").parquet(path)
    assert _present(spark, index, path, [1, 150]) == [1, 150]
    assert spark.read.parquet(index.entries_path).count() == entered + 100
    assert _present(spark, index, path, [1, 150]) == [1, 150]
    assert spark.read.parquet(index.entries_path).count() == entered + 100


def test_rows_that_are_gone_dont_count(spark, tmp_path):
    path = str(tmp_path / "t")
    _frame(spark, range(50)).write.parquet(path)
    index = KeyIndex(spark, path, ["id"], 8)
    assert _present(spark, index, path, [1, 60]) == [1]
    _frame(spark, range(50, 70)).write.mode("append").parquet(path)
    assert _present(spark, index, path, [1, 60]) == [1, 60]
    for part in (tmp_path / "t").glob("part-*"):
        if "60" in str(spark.read.parquet(str(part)).select("id").collect()):
            part.unlink()
    assert _present(spark, index, path, [1, 60]) == [1]


def test_a_run_that_died_between_entries_and_list(spark, tmp_path):
    path = str(tmp_path / "t")
    _frame(spark, range(50)).write.parquet(path)
    index = KeyIndex(spark, path, ["id"], 8)
    index.refresh(spark.read.parquet(path))
    # the list of entered files is lost: they are entered again, the answer stays
    fs, where = key_index._fs(spark, index.files_path)
    fs.delete(where, True)
    assert _present(spark, index, path, [3, 4, 99]) == [3, 4]
    assert index.compact(spark.read.parquet(path), least=1)
    assert spark.read.parquet(index.entries_path).count() == 50


def test_compaction_keeps_the_answers(spark, tmp_path):
    path = str(tmp_path / "t")
    index = KeyIndex(spark, path, ["id"], 4)
    for start in range(0, 60, 10):
        _frame(spark, range(start, start + 10)).coalesce(1).write.mode("append").parquet(path)
        index.refresh(spark.read.parquet(path))
    before = list((tmp_path / "t").rglob(f"{BUCKET}=*/part-*.parquet"))
    assert index.compact(spark.read.parquet(path), least=3)
    after = list((tmp_path / "t").rglob(f"{BUCKET}=*/part-*.parquet"))
    assert len(after) < len(before)
    assert _present(spark, index, path, [0, 59, 60]) == [0, 59]
    assert spark.read.parquet(index.entries_path).select(FILE).distinct().count() == 6


def test_null_keys_and_several_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, "a"), (1, None), (None, "a"), (2, "b")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    index = KeyIndex(spark, path, ["id", "v"], 8)
    batch = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b")], SCHEMA)
    found = index.present(spark.read.parquet(path), batch)
    assert sorted(map(tuple, found.collect())) == [(1, "a"), (2, "b")]
    assert spark.read.parquet(index.entries_path).count() == 2


def test_only_some_files_count(spark, tmp_path):
    path = str(tmp_path / "t")
    days = _frame(spark, range(40)).withColumn("load_date", F.expr("date_add(date'2024-01-01', cast(id % 4 as int))"))
    days.write.partitionBy("load_date").parquet(path)
    index = KeyIndex(spark, path, ["id"], 8)
    first = lambda name: name.startswith("load_date=2024-01-01/")
    assert _present(spark, index, path, range(8), first) == [0, 4]
    assert _present(spark, index, path, range(8)) == list(range(8))


@pytest.mark.parametrize("seed", range(2))
def test_random_loads_with_other_writers(spark, tmp_path, seed, monkeypatch):
    """Merges, plain appends and dropped days in any order against a set of keys."""
    monkeypatch.setattr(key_index, "COMPACT_FROM", 2)
    draw, path = random.Random(seed), str(tmp_path / "t")
    held: dict[int, int] = {}  # key -> day that it was loaded
    for step in range(7):
        day = draw.randint(1, 4)
        ids = draw.sample(range(30), draw.randint(1, 12))
        loaded = datetime(2024, 1, day, 3)
        batch = spark.createDataFrame([(i, loaded) for i in ids], "id long, loaded_at timestamp_ntz")
        if held and draw.random() < 0.3:  # rows that come another way
            more = batch.where(~F.col("id").isin(list(held)))
            more = more.withColumn("load_date", F.lit(date(2024, 1, day)))
            more.write.mode("append").partitionBy("load_date").parquet(path)
            held.update({i: day for i in ids if i not in held})
        else:
            mw.reload_day_into(spark, batch, path, ["id"], date(2024, 1, day), key_buckets=4)
            held = {i: d for i, d in held.items() if d < day}
            held.update({i: day for i in ids if i not in held})
        stored = spark.read.parquet(path).select("id", F.dayofmonth("load_date").alias("d"))
        assert {r["id"]: r["d"] for r in stored.collect()} == held, step
        assert stored.count() == len(held)
