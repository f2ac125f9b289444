"""Counts and extremes from file statistics (M5, V1, V3)."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from martworks.operators import merge, quality
from martworks.plans import jobs
from martworks.sinks import writers
from martworks.sources import footers


@pytest.fixture()
def stored(spark, tmp_path):
    path = str(tmp_path / "t")
    days = spark.range(1000).select(
        "id", F.expr("date_add(date'2024-01-01', cast(id % 90 as int))").alias("day"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("at"), F.col("id").cast("string").alias("name"),
    )
    days.repartition(4).write.parquet(path)
    return path


def test_only_footers_are_read(spark, stored):
    plan = footers.pushed_plan(spark, stored, ["day", "id"])
    assert "PushedAggregation: [COUNT(*), MIN(day), MAX(day), MIN(id), MAX(id)]" in plan
    # outside the block the session is as it was
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_equal_to_the_scan(spark, stored, tmp_path):
    df = spark.read.parquet(stored)
    for col in ("day", "id", "at", "name"):
        assert footers.stored_watermark(spark, stored, col, None) == merge.high_watermark(df, col, None)
    report = footers.stored_report(spark, stored, "day", 7)
    want = quality.load_report(df, "day").drop("new_rows").first()
    assert tuple(report.first()) == (*want, 7)
    assert report.schema["min_date"].dataType == df.schema["day"].dataType
    counts = footers.stored_counts(spark, {"t": stored, "none": str(tmp_path / "none")})
    assert sorted(map(tuple, counts.collect())) == [("none", 0), ("t", 1000)]


def test_missing_tables_columns_and_rows(spark, stored, tmp_path):
    assert footers.stored_watermark(spark, str(tmp_path / "no"), "day", 1) == 1
    assert footers.stored_watermark(spark, stored, "no", 2) == 2
    empty = str(tmp_path / "empty")
    spark.read.parquet(stored).limit(0).write.parquet(empty)
    assert footers.stored_watermark(spark, empty, "day", 3) == 3
    assert tuple(footers.stored_report(spark, empty, "day").first()) == (0, None, None, 0)
    nulls = str(tmp_path / "nulls")
    spark.range(3).select(F.lit(None).cast("date").alias("day")).write.parquet(nulls)
    assert footers.stored_watermark(spark, nulls, "day", 4) == 4


def test_incremental_job_by_statistics_and_by_scan(spark, tmp_path):
    table = "mw_footer_job"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    rows = spark.createDataFrame([(1, date(2024, 1, 1)), (2, date(2024, 1, 2))], "id int, day date")
    more = rows.union(spark.createDataFrame([(3, date(2024, 1, 3))], rows.schema))
    writers.full_refresh(rows, table, str(tmp_path / "t"))
    assert footers.table_files(spark, table, "day")
    report = jobs.incremental_job(spark, more, table, "day", date(1970, 1, 1), date(2024, 2, 1))
    assert tuple(report.first()) == (3, date(2024, 1, 1), date(2024, 1, 3), 1)
    # a column with a default for the old files: their statistics don't have it
    later = more.withColumn("seen", F.lit(date(2024, 5, 1)))
    jobs.incremental_job(spark, later, table, "seen", date(1970, 1, 1), date(2024, 2, 1))
    assert footers.table_files(spark, table, "seen") is None
    assert merge.high_watermark(spark.table(table), "seen", None) == date(2024, 5, 1)
    assert spark.table(table).where(F.col("seen") == date(2024, 2, 1)).count() == 3
    spark.sql(f"DROP TABLE {table}")
