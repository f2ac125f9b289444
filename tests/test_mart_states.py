"""P7 from mergeable states by load day."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martworks.plans import mart_states, marts
from martworks.sinks.merge_writers import reload_day_into

VIEWS = (
    "view_id string, user_id string, movie_id string, movie_title string, genre string, "
    "watch_duration_minutes int, completed boolean, start_time timestamp_ntz"
)
RATINGS = "rating_id string, movie_id string, rating int"
SEARCHES = "search_id string, clicked_movie_id string"
PAYMENTS = (
    "payment_id string, user_id string, payment_date timestamp_ntz, amount decimal(10,2), "
    "payment_method string, subscription_plan string, status string"
)


def _rows(df):
    def plain(v):
        return round(v, 6) if isinstance(v, float) else v

    return sorted((tuple(map(plain, r)) for r in df.collect()), key=repr)


def _draw(spark, draw, day, n=60):
    some = lambda *values: draw.choice(values)
    at = lambda: datetime(2024, 1, day, draw.randint(0, 23))
    views = [
        (f"v{day}-{i}", some("u1", "u1", "u1", "u2", "u3", None), some("m1", "m2", "m3", None),
         some("A", "B"), some("drama", "action", None), some(5, 10, None), some(True, False, None), at())
        for i in range(n)
    ]
    ratings = [(f"r{day}-{i}", some("m1", "m2", None), some(1, 5, None)) for i in range(n // 3)]
    searches = [(f"s{day}-{i}", some("m1", "m3", None)) for i in range(n // 3)]
    payments = [
        (f"p{day}-{i}", some("u1", "u2", None), at(), some(Decimal("9.99"), Decimal("0.01"), None),
         some("card", "cash", None), some("basic", "plus"), some("completed", "failed"))
        for i in range(n // 2)
    ]
    return {
        "movie_views": (views, VIEWS, "view_id"),
        "content_ratings": (ratings, RATINGS, "rating_id"),
        "search_queries": (searches, SEARCHES, "search_id"),
        "user_payments": (payments, PAYMENTS, "payment_id"),
    }


@pytest.mark.parametrize("seed", range(2))
def test_equal_to_the_marts_of_all_rows(spark, tmp_path, seed):
    """Days in order, a day loaded again with other rows, and a step back to an earlier day."""
    draw = random.Random(seed)
    paths = {}
    for day in (1, 2, 3, 3, 2):
        for name, (rows, schema, key) in _draw(spark, draw, day).items():
            paths[name] = str(tmp_path / name)
            batch = spark.createDataFrame(rows, schema)
            reload_day_into(spark, batch, paths[name], [key], date(2024, 1, day), key_buckets=4)
        made = mart_states.refresh_marts(
            spark, paths, str(tmp_path / "states"), str(tmp_path / "marts"), date(2024, 1, day)
        )
        whole = {n: spark.read.parquet(p).drop("load_date") for n, p in paths.items()}
        want = {
            "mart_user_activity": marts.mart_user_activity(whole["movie_views"]),
            "mart_content_performance": marts.mart_content_performance(
                whole["movie_views"], whole["content_ratings"], whole["search_queries"]
            ),
            "mart_payment_analysis": marts.mart_payment_analysis(whole["user_payments"]),
        }
        for name, mart in want.items():
            assert [(f.name, f.dataType) for f in made[name].schema] == [
                (f.name, f.dataType) for f in mart.schema
            ], name
            assert _rows(made[name]) == _rows(mart), (name, day)


def test_one_day_is_read(spark, tmp_path):
    path = str(tmp_path / "movie_views")
    for day in (1, 2):
        rows, schema, key = _draw(spark, random.Random(day), day)["movie_views"]
        reload_day_into(spark, spark.createDataFrame(rows, schema), path, [key], date(2024, 1, day))
    parts = marts.activity_parts(mart_states.day_rows(spark, path, date(2024, 1, 2)))
    parts.collect()
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load_date" in plan and "= 2024-01-02" in plan
    assert parts.agg(F.sum(F.when(F.col("_set") == 6, F.col("_rows")))).first()[0] == 60


def test_an_empty_day_has_no_state(spark, tmp_path):
    path = str(tmp_path / "movie_views")
    rows, schema, key = _draw(spark, random.Random(1), 1)["movie_views"]
    reload_day_into(spark, spark.createDataFrame(rows, schema), path, [key], date(2024, 1, 2))
    args = (spark, {"movie_views": path}, str(tmp_path / "s"), str(tmp_path / "m"))
    assert mart_states.refresh_marts(*args, date(2024, 1, 1))["mart_user_activity"].count() == 0
    assert mart_states.refresh_marts(*args, date(2024, 1, 2))["mart_user_activity"].count() == 4


def test_activity_is_one_scan_and_spreads_a_hot_user(spark, tmp_path):
    path = str(tmp_path / "views")
    spark.range(30_000).select(
        F.col("id").alias("view_id"), F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(
            F.col("id").cast("string")).alias("user_id"),
        (F.col("id") % 500).alias("movie_id"), (F.col("id") % 7).cast("string").alias("genre"),
        F.lit(1).alias("watch_duration_minutes"), F.lit(True).alias("completed"),
        F.lit(None).cast("timestamp_ntz").alias("start_time"),
    ).repartition(6).write.parquet(path)
    mart = marts.mart_user_activity(spark.read.parquet(path))
    hot = mart.where("user_id = 'hot'").first()
    assert (hot["total_views"], hot["unique_movies_watched"]) == (20_000, 500)
    assert hot["favorite_genre"] == "1" and hot["completion_rate"] == 100.0
    mart.collect()
    final = mart._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "Join" not in final
    # rows are first combined by user and view, movie or genre
    assert "hashpartitioning(user_id" in final and "spark_grouping_id" in final
