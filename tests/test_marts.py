import random

import pytest
from pyspark.sql import functions as F

from martworks.functions.aggs import count_distinct, count_distinct_if, safe_pct
from martworks.operators.joins import left_join_facts
from martworks.plans import marts
from martworks.plans.marts import _CONTENT_KEYS

V = "view_id string, user_id string, movie_id string, movie_title string, genre string, watch_duration_minutes int, completed boolean, start_time timestamp_ntz"
R = "rating_id string, movie_id string, rating int"
S = "search_id string, clicked_movie_id string"


def _random_case(spark, seed):
    rnd = random.Random(seed)
    movies = [None, "m1", "m2", "m3", "m4"]
    views = [
        (rnd.choice([f"v{i}", f"v{i}", None]), rnd.choice(["u1", "u2", None]), rnd.choice(movies),
         rnd.choice(["T1", "T2"]), rnd.choice(["G1", "G2", None]), rnd.choice([60, 90, None]),
         rnd.choice([True, False, None]), None)
        for i in range(rnd.randint(1, 25))
    ]
    ratings = [(rnd.choice([f"r{i}", None, "r0"]), rnd.choice(movies), rnd.choice([3, 4, 5, None]))
               for i in range(rnd.randint(0, 12))]
    searches = [(rnd.choice([f"s{i}", None]), rnd.choice(movies)) for i in range(rnd.randint(0, 12))]
    return (spark.createDataFrame(views, V), spark.createDataFrame(ratings, R),
            spark.createDataFrame(searches, S))


def _rounded(df):
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr
    )


def mart_content_performance_naive(
    views, ratings, searches
):
    """E2 as the reference writes it: J1 (views x ratings x searches per movie) + GROUP BY.

    Kept for equivalence tests on small inputs only; its intermediate row count is the
    product of the per-movie fact counts.
    """
    joined = left_join_facts(
        views,
        [(ratings, "movie_id"), (searches, "clicked_movie_id")],
        key="movie_id",
    )
    mv, cr, sq = "_base", "_f0", "_f1"
    joined = joined.select(
        F.col(f"{mv}.movie_id").alias("movie_id"),
        F.col(f"{mv}.movie_title").alias("movie_title"),
        F.col(f"{mv}.genre").alias("genre"),
        F.col(f"{mv}.view_id").alias("view_id"),
        F.col(f"{mv}.user_id").alias("user_id"),
        F.col(f"{mv}.watch_duration_minutes").alias("watch_duration_minutes"),
        F.col(f"{cr}.rating").alias("rating"),
        F.col(f"{cr}.rating_id").alias("rating_id"),
        F.col(f"{sq}.search_id").alias("search_id"),
        F.col(f"{sq}.clicked_movie_id").alias("clicked_movie_id"),
    )
    return joined.groupBy(*_CONTENT_KEYS).agg(
        count_distinct("view_id").alias("total_views"),
        count_distinct("user_id").alias("unique_viewers"),
        F.avg("watch_duration_minutes").alias("avg_watch_duration"),
        F.avg("rating").alias("avg_rating"),
        count_distinct("rating_id").alias("total_ratings"),
        count_distinct("search_id").alias("search_appearances"),
        safe_pct(
            count_distinct_if(F.col("clicked_movie_id") == F.col("movie_id"), "search_id"),
            count_distinct("search_id"),
        ).alias("search_to_view_rate"),
    )


@pytest.mark.parametrize("seed", range(6))
def test_preaggregated_star_equals_naive_join(spark, seed):
    v, r, s = _random_case(spark, seed)
    cols = marts.mart_content_performance(v, r, s).columns
    fast = marts.mart_content_performance(v, r, s)
    naive = mart_content_performance_naive(v, r, s).select(*cols)
    assert _rounded(fast) == _rounded(naive)


def test_search_rate_is_100_or_null(spark):
    v, r, s = _random_case(spark, 7)
    rates = {row["search_to_view_rate"] for row in marts.mart_content_performance(v, r, s).collect()}
    assert rates <= {100.0, None}


def test_mode_ties_take_smallest_and_nulls_ignored(spark):
    views = spark.createDataFrame(
        [("v1", "u", "m", "t", "Drama", 60, True, None), ("v2", "u", "m", "t", "Action", 60, None, None),
         ("v3", "u", "m", "t", None, 60, False, None), ("v4", "u", "m", "t", None, 60, False, None),
         ("v5", "w", "m", "t", None, 90, True, None)],
        V,
    )
    rows = {r["user_id"]: r for r in marts.mart_user_activity(views).collect()}
    assert rows["u"]["favorite_genre"] == "Action"
    assert rows["u"]["completion_rate"] == 25.0
    assert rows["w"]["favorite_genre"] is None
    assert rows["u"]["total_views"] == 4 and rows["u"]["unique_movies_watched"] == 1


def test_payment_mart_types(spark):
    pays = spark.createDataFrame(
        [("p1", "u", None, 4.99, "paypal", "basic", "completed"),
         ("p2", "u", None, 9.99, "credit_card", "basic", "pending")],
        "payment_id string, user_id string, payment_date timestamp_ntz, amount double, "
        "payment_method string, subscription_plan string, status string",
    ).withColumn("amount", F.col("amount").cast("decimal(10,2)"))
    out = marts.mart_payment_analysis(pays)
    types = dict(out.dtypes)
    assert types["total_revenue"] == "decimal(20,2)"
    assert types["avg_payment_amount"] == "decimal(14,6)"
    row = out.first()
    assert row["successful_payments"] == 1 and row["preferred_payment_method"] == "credit_card"
    assert str(row["total_revenue"]) == "14.98"


def test_null_user_group_keeps_its_mode(spark):
    views = spark.createDataFrame(
        [("v1", None, "m", "t", "Drama", 60, True, None), ("v2", None, "m", "t", "Drama", 60, None, None),
         ("v3", None, "m", "t", "Action", 60, False, None), ("v4", "u", "m", "t", "Crime", 60, False, None)],
        V,
    )
    rows = {r["user_id"]: r for r in marts.mart_user_activity(views).collect()}
    assert rows[None]["favorite_genre"] == "Drama" and rows[None]["total_views"] == 3
    assert rows["u"]["favorite_genre"] == "Crime"
    pays = spark.createDataFrame(
        [("p1", None, None, 1.0, "paypal", None, "completed"), ("p2", None, None, 1.0, "paypal", None, "x"),
         ("p3", "u", None, 1.0, "gift_card", None, "x")],
        "payment_id string, user_id string, payment_date timestamp_ntz, amount double, "
        "payment_method string, subscription_plan string, status string",
    )
    got = {(r["user_id"], r["subscription_plan"]): r["preferred_payment_method"]
           for r in marts.mart_payment_analysis(pays).collect()}
    assert got == {(None, None): "paypal", ("u", None): "gift_card"}
