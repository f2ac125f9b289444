from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martworks.operators import merge, transform

T_SCHEMA = "k string, k2 int, a int, b string, loaded_at timestamp_ntz"
B_SCHEMA = "k string, k2 int, a int, b string, seq int"


def _rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_dedupe_first_keeps_first_by_order_and_all_null_keys(spark):
    df = spark.createDataFrame(
        [("x", 1, 1, "late", 2), ("x", 1, 2, "early", 1), (None, 1, 3, "n1", 5), (None, 1, 4, "n2", 6)],
        B_SCHEMA,
    )
    out = merge.dedupe_first(df, ["k", "k2"], ["seq"])
    assert _rows(out, "k", "b") == sorted([("x", "early"), (None, "n1"), (None, "n2")], key=repr)


def test_upsert_last_wins_null_keys_never_conflict(spark):
    target = spark.createDataFrame(
        [("a", 1, 10, "keep-me", datetime(2024, 1, 1)), ("b", 2, 20, "old", datetime(2024, 1, 1)),
         (None, 3, 30, "tnull", datetime(2024, 1, 1))],
        T_SCHEMA,
    )
    batch = spark.createDataFrame(
        [("b", 2, 21, "new1", 1), ("b", 2, 22, "new2", 2), ("c", 3, 31, "ins", 1),
         (None, 3, 40, "bnull1", 1), (None, 3, 41, "bnull2", 2)],
        B_SCHEMA,
    )
    out = merge.upsert(target, batch, ["k", "k2"], order_by=["seq"], update_cols=["a"],
                       stamp=("loaded_at", "2024-02-01 00:00:00"))
    rows = {(r["k"], r["a"]): r for r in out.collect()}
    assert len(rows) == 6
    assert rows[("b", 22)]["b"] == "old"  # b not in update_cols: target value kept
    assert rows[("b", 22)]["loaded_at"] == datetime(2024, 2, 1)
    assert rows[("a", 10)]["loaded_at"] == datetime(2024, 1, 1)
    assert rows[("c", 31)]["b"] == "ins"
    assert {(None, 30), (None, 40), (None, 41)} <= set(rows)


def test_upsert_same_batch_twice_changes_nothing(spark):
    target = spark.createDataFrame([("a", 1, 10, "x", datetime(2024, 1, 1))], T_SCHEMA)
    batch = spark.createDataFrame([("a", 1, 11, "y", 1), ("b", 1, 12, "z", 1)], B_SCHEMA)
    once = merge.upsert(target, batch, ["k", "k2"], ["seq"], stamp=("loaded_at", "2024-02-01"))
    twice = merge.upsert(once, batch, ["k", "k2"], ["seq"], stamp=("loaded_at", "2024-02-01"))
    assert _rows(once) == _rows(twice)


def test_insert_ignore_never_changes_a_target_row(spark):
    target = spark.createDataFrame([("a", 1, 10, "x", datetime(2024, 1, 1))], T_SCHEMA)
    batch = spark.createDataFrame(
        [("a", 1, 99, "changed", datetime(2024, 2, 1)), ("b", 1, 1, "new", datetime(2024, 2, 1))],
        T_SCHEMA,
    )
    out = merge.insert_ignore(target, batch, ["k", "k2"])
    assert _rows(out, "k", "a") == sorted([("a", 10), ("b", 1)], key=repr)


def _events(spark, rows):
    return spark.createDataFrame(rows, "id string, v int, loaded_at timestamp_ntz")


def test_reload_day_rules(spark):
    target = _events(spark, [
        ("old", 1, datetime(2024, 1, 1)),       # earlier day: wins over the batch
        ("today", 1, datetime(2024, 1, 20, 1)),  # loaded today: replaced
        ("nul", 1, None),                        # NULL load time: kept
    ])
    batch = _events(spark, [
        ("old", 2, datetime(2024, 1, 20, 6)), ("today", 2, datetime(2024, 1, 20, 6)),
        ("fresh", 2, datetime(2024, 1, 20, 6)),
    ])
    once = merge.reload_day(target, batch, ["id"], date(2024, 1, 20))
    assert _rows(once, "id", "v") == sorted([("fresh", 2), ("nul", 1), ("old", 1), ("today", 2)], key=repr)
    twice = merge.reload_day(once, batch, ["id"], date(2024, 1, 20))
    assert _rows(once) == _rows(twice)
    empty = batch.limit(0)
    assert _rows(merge.reload_day(target, empty, ["id"], date(2024, 1, 20))) == _rows(target)


def test_high_watermark_defaults(spark):
    df = _events(spark, [("a", 1, datetime(2024, 1, 3))])
    assert merge.high_watermark(df, "loaded_at", "d") == datetime(2024, 1, 3)
    assert merge.high_watermark(df.limit(0), "loaded_at", "d") == "d"
    assert merge.high_watermark(df, "missing", "d") == "d"
    assert merge.high_watermark(None, "loaded_at", "d") == "d"


def test_incremental_load_strict_and_idempotent(spark):
    source = spark.createDataFrame(
        [("a", date(2024, 1, 1)), ("b", date(2024, 1, 2)), ("c", date(2024, 1, 2)), ("d", date(2024, 1, 3))],
        "ID string, `Noted Date` date",
    )
    target = transform.normalize_columns(source).where("noted_date <= '2024-01-02'").where("id != 'c'")
    once = merge.incremental_load(source, target, "noted_date", date(1970, 1, 1))
    # strict '>' skips the late row 'c' of the last loaded day
    assert _rows(once, "id") == [("a",), ("b",), ("d",)]
    twice = merge.incremental_load(source, once, "noted_date", date(1970, 1, 1))
    assert _rows(once) == _rows(twice)
    inclusive = merge.incremental_load(source, target, "noted_date", date(1970, 1, 1),
                                       inclusive=True, keys=["id"])
    assert _rows(inclusive, "id") == [("a",), ("b",), ("c",), ("d",)]


def test_normalize_columns_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(transform.SchemaError):
        transform.normalize_columns(df)


def test_reload_day_prunes_load_day_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(f"k{d}", d, datetime(2024, 1, d, 5)) for d in range(1, 21)]
    t = _events(spark, rows).withColumn("load_date", F.to_date("loaded_at"))
    t.write.partitionBy("load_date").parquet(path)
    target = spark.read.parquet(path)
    batch = _events(spark, [("k19", 9, datetime(2024, 1, 19, 6)), ("new", 9, datetime(2024, 1, 19, 6))])
    out = merge.reload_day(target, batch, ["id"], date(2024, 1, 19), load_date_col="load_date")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(load_date" in plan
    got = {r["id"]: r["v"] for r in out.collect()}
    assert got["k19"] == 9 and got["new"] == 9 and "k20" not in got and got["k18"] == 18


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    # a third of the rows share one key; many rows have a NULL key
    rows = [("hot", 1, i, "x", i) for i in range(300)] + [(f"k{i}", 1, i, "y", i) for i in range(300)]
    rows += [(None, 1, i, "n", i) for i in range(300)]
    batch = spark.createDataFrame(rows, B_SCHEMA)
    out = merge.dedupe_first(batch, ["k", "k2"], ["seq"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    # one row per task and key goes into the exchange
    final, exchange, partial = (plan.index(x) for x in ("row_number(), 1, Final", "Exchange", "row_number(), 1, Partial"))
    assert final < exchange < partial
    got = out.collect()
    assert len(got) == 1 + 300 + 300
    assert [r["a"] for r in got if r["k"] == "hot"] == [0]
    target = spark.createDataFrame([("hot", 1, -1, "t", datetime(2024, 1, 1))], T_SCHEMA)
    merged = merge.insert_ignore(target, batch.drop("seq").withColumn("loaded_at", F.lit(None).cast("timestamp_ntz")),
                                 ["k", "k2"], order_by=["a"])
    assert merged.count() == 1 + 300 + 300
    assert [r["a"] for r in merged.collect() if r["k"] == "hot"] == [-1]


def test_merge_counts(spark):
    target = spark.createDataFrame([("a", 1, 1, "x", None), ("b", 1, 1, "x", None)], T_SCHEMA)
    batch = spark.createDataFrame(
        [("a", 1, 2, "y", 1), ("a", 1, 3, "y", 2), ("c", 1, 2, "y", 1), (None, 1, 2, "y", 1), (None, 1, 2, "y", 1)],
        B_SCHEMA,
    )
    row = merge.merge_counts(target, batch, ["k", "k2"]).first()
    assert (row["inserted"], row["updated"]) == (3, 1)
