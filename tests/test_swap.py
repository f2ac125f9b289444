"""Catalog tables replaced in one metadata step."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from martworks.plans import jobs
from martworks.sinks import writers


@pytest.fixture()
def table(spark):
    name = "mw_swap_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def _versions(base):
    return sorted(d for d in os.listdir(base) if d.startswith(writers.VERSION))


def test_readers_see_the_old_rows_or_the_new_ones(spark, table, tmp_path):
    base = str(tmp_path / "t")
    writers.publish_table(spark.range(1000), table, base)
    seen, errors, stop = set(), [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.add(tuple(spark.table(table).agg(F.count("*"), F.sum("id")).first()))
            except Exception as error:  # noqa: BLE001
                errors.append(str(error)[:300])

    reader = threading.Thread(target=read)
    reader.start()
    whole = {(1000, sum(range(1000)))}
    for n in range(1, 5):
        # the new version is made of the old one
        grown = spark.table(table).union(spark.range(1000 * n, 1000 * (n + 1)))
        writers.full_refresh(grown, table, base)
        whole.add((1000 * (n + 1), sum(range(1000 * (n + 1)))))
    stop.set()
    reader.join()
    assert not errors and seen and seen <= whole
    assert spark.table(table).count() == 5000
    # the current version and the one it replaced
    assert len(_versions(base)) == 2


def test_a_failed_load_leaves_the_table(spark, table, tmp_path):
    base = str(tmp_path / "t")
    writers.publish_table(spark.range(10), table, base)
    bad = spark.range(1000).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        writers.full_refresh(bad, table, base)
    assert spark.table(table).count() == 10
    # a run that died between writing and switching: its folder goes with the next load
    spark.range(99).write.parquet(f"{base}/{writers.VERSION}orphan")
    assert spark.table(table).count() == 10
    writers.full_refresh(spark.range(20), table, base)
    writers.full_refresh(spark.range(30), table, base)
    assert spark.table(table).count() == 30
    assert f"{writers.VERSION}orphan" not in _versions(base) and len(_versions(base)) == 2


def test_managed_tables_and_changed_columns(spark, table):
    writers.full_refresh(spark.range(3), table)
    first = writers._location(spark, table)
    for n in (4, 5):
        writers.replace_table(spark, spark.table(table).union(spark.range(1)), table)
        assert spark.table(table).count() == n
    assert writers._location(spark, table) != first
    renamed = spark.table(table).withColumnRenamed("id", "other")
    writers.replace_table(spark, renamed, table)
    assert spark.table(table).columns == ["other"] and spark.table(table).count() == 5


def test_a_new_table_without_folder_is_refused(spark):
    with pytest.raises(ValueError):
        writers.publish_table(spark.range(1), "mw_no_such_table")


def test_marts_as_published_tables(spark, tmp_path):
    views = spark.range(100).select(
        F.col("id").alias("view_id"), (F.col("id") % 7).alias("user_id"),
        (F.col("id") % 11).alias("movie_id"), F.lit("t").alias("movie_title"),
        (F.col("id") % 3).cast("string").alias("genre"), F.lit(5).alias("watch_duration_minutes"),
        F.lit(True).alias("completed"), F.lit(None).cast("timestamp_ntz").alias("start_time"),
    )
    for rows in (views, views.where("view_id < 50")):
        made = jobs.build_marts(
            {"movie_views": rows}, str(tmp_path), ["mart_user_activity"], publish="mw_pub_"
        )
        stored = spark.table("mw_pub_mart_user_activity")
        assert stored.agg(F.sum("total_views")).first()[0] == rows.count()
        assert made["favourite_genre_summary"].count() > 0
    spark.sql("DROP TABLE mw_pub_mart_user_activity")
