from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.operators import quality, transform
from martworks.sinks import writers


def test_conform_casts_defaults_and_rejects_undeclared(spark):
    schema = T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("reports_count", T.IntegerType()),
        T.StructField("moderation_flag", T.BooleanType()),
        T.StructField("rating", T.IntegerType()),
    ])
    df = spark.createDataFrame([("a", None, "4"), ("b", 2, None)], "id string, reports_count int, rating string")
    out = transform.conform(df, schema, {"reports_count": 0, "moderation_flag": False})
    rows = {r["id"]: r for r in out.collect()}
    assert rows["a"]["reports_count"] == 0 and rows["b"]["reports_count"] == 2
    assert rows["a"]["moderation_flag"] is False and rows["a"]["rating"] == 4
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in schema]
    with pytest.raises(transform.SchemaError):
        transform.conform(df.withColumn("extra", F.lit(1)), schema)


def test_flatten_struct_and_missing_struct(spark):
    df = spark.createDataFrame([({"type": "tv", "os": "x", "browser": None},), (None,)],
                               "device struct<type:string,os:string,browser:string>")
    out = transform.flatten_struct(df, "device", ["type", "os"])
    assert out.columns == ["device_type", "device_os"]
    assert [tuple(r) for r in out.collect()] == [("tv", "x"), (None, None)]
    assert transform.flatten_struct(df.drop("device"), "device", ["type"]).columns == []


def test_coerce_timestamp_bad_is_null(spark):
    df = spark.createDataFrame([("2025-02-01T10:00:00Z",), ("nope",), ("2025-02-01 10:00:00.5",)], "t string")
    got = [r["t"] for r in transform.coerce_timestamp(df, ["t", "absent"]).collect()]
    assert got == [datetime(2025, 2, 1, 10), None, datetime(2025, 2, 1, 10, 0, 0, 500000)]


def test_filter_equals_is_case_sensitive_and_drops_null(spark):
    df = spark.createDataFrame([("In",), ("in",), (None,)], "flag string")
    assert transform.filter_equals(df, "flag", "In").count() == 1


def test_add_missing_column_only_when_absent(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert transform.add_missing_column(df, "a", "string", "x").dtypes == [("a", "int")]
    assert transform.add_missing_column(df, "b", "int", 0).first()["b"] == 0


def test_infer_target_schema_mapping(spark):
    df = spark.createDataFrame([], "`Room Id` string, n int, big bigint, x double, d date, t timestamp, m decimal(10,2), f boolean")
    assert transform.infer_target_schema(df) == [
        ("room_id", "VARCHAR(255)"), ("n", "INTEGER"), ("big", "BIGINT"), ("x", "FLOAT"),
        ("d", "DATE"), ("t", "TIMESTAMP"), ("m", "DECIMAL(10,2)"), ("f", "BOOLEAN"),
    ]
    assert transform.target_ddl(df, "t1").startswith("CREATE TABLE t1 (room_id VARCHAR(255), n INTEGER")


def test_gates_raise(spark):
    empty = spark.createDataFrame([], "a int")
    full = spark.createDataFrame([(1,), (None,)], "a int")
    with pytest.raises(quality.DataQualityError, match="Source table views is empty"):
        quality.require_nonempty({"full": full, "views": empty})
    with pytest.raises(quality.DataQualityError):
        quality.require_records(empty)
    with pytest.raises(quality.DataQualityError):
        quality.require_not_null(full, ["a"])
    assert quality.require_records(full) is full


def test_row_counts_and_profile(spark):
    a = spark.createDataFrame([(1,), (2,)], "x int")
    b = spark.createDataFrame([], "y string, z int")
    counts = {r["table_name"]: r["row_count"] for r in quality.row_counts({"a": a, "b": b}).collect()}
    assert counts == {"a": 2, "b": 0}
    prof = quality.table_profile(b).collect()
    assert [(r["column_name"], r["ordinal_position"], r["row_count"]) for r in prof] == [("y", 1, 0), ("z", 2, 0)]


def test_replace_table_reads_itself(spark):
    spark.sql("DROP TABLE IF EXISTS swap_t")
    writers.full_refresh(spark.createDataFrame([(1,)], "v int"), "swap_t")
    grown = spark.table("swap_t").unionByName(spark.table("swap_t").select((F.col("v") + 1).alias("v")))
    writers.replace_table(spark, grown, "swap_t")
    assert sorted(r["v"] for r in spark.table("swap_t").collect()) == [1, 2]
    spark.sql("DROP TABLE swap_t")


def test_append_table_matches_columns_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.append_table(spark.createDataFrame([(1, "a")], "n int, s string"), path, spark)
    writers.append_table(spark.createDataFrame([("b", 2)], "s string, n int"), path, spark)
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "b")]
    spark.sql("DROP TABLE IF EXISTS app_t")
    writers.append_table(spark.createDataFrame([(1, "a")], "n int, s string"), "app_t")
    writers.append_table(spark.createDataFrame([("b", 2)], "s string, n int"), "app_t")
    assert sorted(tuple(r) for r in spark.table("app_t").collect()) == [(1, "a"), (2, "b")]


def test_parse_date_one_or_two_digits(spark):
    df = spark.createDataFrame([("03-12-2018 11:02",), ("3-2-2018 1:05",)], "d string")
    got = [r["d"].isoformat() for r in transform.parse_date(df, "d").collect()]
    assert got == ["2018-12-03", "2018-02-03"]


def test_jdbc_column_types(spark):
    df = spark.createDataFrame([], "`Room Id` string, temp int, big bigint, d date, x array<int>")
    assert transform.jdbc_column_types(df) == "room_id VARCHAR(255), temp INTEGER, big BIGINT, d DATE"
