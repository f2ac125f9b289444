"""G1: synthetic document collections with the reference generator's value sets.

Rows come from ``spark.range`` and every random choice is a hash of (row id, seed,
field), so the output is deterministic, needs no driver-side data and scales to any
size by ``scale`` (1 = 100 views, 60 payments, 80 ratings, 50 searches, 50 users).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The generator's value sets, in its order.
MOVIES = [
    ("movie_101", "Inception", "Sci-Fi"),
    ("movie_102", "The Dark Knight", "Action"),
    ("movie_103", "Interstellar", "Sci-Fi"),
    ("movie_104", "Pulp Fiction", "Drama"),
    ("movie_105", "The Matrix", "Sci-Fi"),
    ("movie_106", "Forrest Gump", "Drama"),
    ("movie_107", "The Godfather", "Crime"),
]
DEVICES = [
    ("smart_tv", "webos", None),
    ("mobile", "android", "chrome"),
    ("mobile", "ios", "safari"),
    ("desktop", "windows", "firefox"),
    ("tablet", "ipados", "safari"),
]
DURATIONS = [60, 90, 120, 135, 150]
COMPLETED = [True, False, True, True]
PLANS = [("basic_monthly", 4.99), ("premium_monthly", 9.99), ("annual", 89.99)]
PAYMENT_METHODS = ["credit_card", "paypal", "gift_card"]
STATUSES = ["completed", "completed", "completed", "pending"]
PROMO_CODES = ["", "", "", "WELCOME20", "FEBRUARY2024"]
REVIEWS = [
    "Amazing movie!",
    "Good but too long",
    "Masterpiece!",
    "Worth watching",
    "",
    "Not my taste",
    "Excellent cinematography",
]
QUERIES = [
    "christopher nolan",
    "leonardo dicaprio",
    "action movies",
    "best sci-fi",
    "comedies 2024",
    "marvel",
    "oscar winners",
    "new releases",
]
FILTER_GENRES = ["Action", "Comedy", "Drama", "Sci-Fi"]
YEARS_FROM = [2000, 2010, 2020]
RATING_MIN = [7, 8]
BASE_ROWS = {"movie_views": 100, "user_payments": 60, "content_ratings": 80, "search_queries": 50}
BASE_USERS = 50

ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"


class _Draw:
    def __init__(self, seed: int, stream: str):
        self.seed, self.stream = seed, stream

    def int(self, field: str, lo: int, hi: int) -> Column:
        """Uniform integer in [lo, hi]."""
        h = F.xxhash64(F.col("id"), F.lit(self.seed), F.lit(f"{self.stream}.{field}"))
        return (F.pmod(h, F.lit(hi - lo + 1)) + F.lit(lo)).cast("int")

    def unit(self, field: str) -> Column:
        return self.int(field, 0, 999_999).cast("double") / F.lit(1_000_000.0)

    def choice(self, field: str, values: list) -> Column:
        return F.array(*[F.lit(v) for v in values])[self.int(field, 0, len(values) - 1)]

    def struct_choice(self, field: str, values: list[tuple], names: list[str]) -> Column:
        structs = [
            F.struct(*[F.lit(v).cast("string").alias(n) for v, n in zip(row, names)]) for row in values
        ]
        return F.array(*structs)[self.int(field, 0, len(values) - 1)]


def _when_day(d: _Draw, month: int, day_hi: int, hour_lo: int, hour_hi: int) -> Column:
    return F.make_timestamp_ntz(
        F.lit(2025), F.lit(month), d.int("day", 1, day_hi), d.int("hour", hour_lo, hour_hi),
        d.int("minute", 0, 59), F.lit(0),
    )


def _user(d: _Draw, users: int) -> Column:
    return F.concat(F.lit("user_"), d.int("user", 1, users).cast("string"))


def synth_collections(spark: SparkSession, scale: int = 1, seed: int = 42) -> dict[str, DataFrame]:
    """Four raw collections (the shape of the exported documents, ISO text with 'Z')."""
    users = BASE_USERS * scale
    out = {}

    d = _Draw(seed, "views")
    movie = d.struct_choice("movie", MOVIES, ["id", "title", "genre"])
    start = _when_day(d, 2, 20, 0, 23)
    duration = d.choice("duration", DURATIONS)
    pairs = F.when(d.unit("has_pauses") > 0.3, d.int("pauses", 0, 3)).otherwise(0)
    pause_at = lambda i: start + F.make_dt_interval(
        F.lit(0), F.lit(0),
        F.lit(10) + F.pmod(F.xxhash64(F.col("id"), F.lit(seed), i), duration - 19),
    )
    pause_pairs = F.flatten(
        F.transform(
            F.when(pairs > 0, F.sequence(F.lit(1), pairs)).otherwise(F.array().cast("array<int>")),
            lambda i: F.array(
                F.struct(F.lit("pause").alias("type"),
                         F.date_format(pause_at(i), ISO_Z).alias("timestamp")),
                F.struct(F.lit("resume").alias("type"),
                         F.date_format(pause_at(i) + F.expr("INTERVAL 1 MINUTE"), ISO_Z).alias("timestamp")),
            ),
        )
    )
    like_at = start + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(20) + F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit("like")), duration - 29)
    )
    like = F.when(
        d.unit("has_like") > 0.7,
        F.array(F.struct(F.lit("like").alias("type"), F.date_format(like_at, ISO_Z).alias("timestamp"))),
    ).otherwise(F.array().cast("array<struct<type:string,timestamp:string>>"))
    out["movie_views"] = spark.range(1, BASE_ROWS["movie_views"] * scale + 1).select(
        F.concat(F.lit("view_"), (F.col("id") + 1000).cast("string")).alias("view_id"),
        _user(d, users).alias("user_id"),
        movie["id"].alias("movie_id"),
        movie["title"].alias("movie_title"),
        movie["genre"].alias("genre"),
        F.date_format(start, ISO_Z).alias("start_time"),
        F.date_format(start + F.make_dt_interval(F.lit(0), F.lit(0), duration), ISO_Z).alias("end_time"),
        duration.alias("watch_duration_minutes"),
        d.choice("completed", COMPLETED).alias("completed"),
        d.struct_choice("device", DEVICES, ["type", "os", "browser"]).alias("device"),
        F.concat(pause_pairs, like).alias("interactions"),
    )

    d = _Draw(seed, "payments")
    plan = d.struct_choice("plan", PLANS, ["name", "amount"])
    paid = _when_day(d, 1, 31, 8, 22)
    monthly = plan["name"].contains("monthly")
    next_bill = F.when(monthly, paid + F.expr("INTERVAL 30 DAYS")).otherwise(paid + F.expr("INTERVAL 365 DAYS"))
    out["user_payments"] = spark.range(1, BASE_ROWS["user_payments"] * scale + 1).select(
        F.concat(F.lit("pay_"), (F.col("id") + 1000).cast("string")).alias("payment_id"),
        _user(d, users).alias("user_id"),
        F.date_format(paid, ISO_Z).alias("payment_date"),
        plan["amount"].cast("double").alias("amount"),
        F.lit("USD").alias("currency"),
        d.choice("method", PAYMENT_METHODS).alias("payment_method"),
        plan["name"].alias("subscription_plan"),
        d.choice("status", STATUSES).alias("status"),
        F.date_format(next_bill, ISO_Z).alias("next_billing_date"),
        d.choice("promo", PROMO_CODES).alias("promo_code_applied"),
    )

    d = _Draw(seed, "ratings")
    movie = d.struct_choice("movie", MOVIES, ["id", "title", "genre"])
    out["content_ratings"] = spark.range(1, BASE_ROWS["content_ratings"] * scale + 1).select(
        F.concat(F.lit("rating_"), (F.col("id") + 1000).cast("string")).alias("rating_id"),
        _user(d, users).alias("user_id"),
        movie["id"].alias("movie_id"),
        movie["title"].alias("movie_title"),
        d.int("rating", 3, 5).alias("rating"),
        d.choice("review", REVIEWS).alias("review_text"),
        F.date_format(_when_day(d, 2, 20, 10, 23), ISO_Z).alias("created_at"),
        d.int("helpful", 0, 50).alias("helpful_count"),
        d.int("reports", 0, 2).alias("reports_count"),
        F.when(d.unit("flagged") > 0.9, d.choice("flag", [True, False])).otherwise(F.lit(False))
        .alias("moderation_flag"),
    )

    d = _Draw(seed, "searches")
    filters = F.when(
        d.unit("has_filters") > 0.7,
        F.struct(
            d.choice("f_genre", FILTER_GENRES).alias("genre"),
            d.choice("f_year", YEARS_FROM).alias("year_from"),
            d.choice("f_rating", RATING_MIN).alias("rating_min"),
        ),
    ).otherwise(
        # an empty document {}: every key absent
        F.struct(
            F.lit(None).cast("string").alias("genre"),
            F.lit(None).cast("int").alias("year_from"),
            F.lit(None).cast("int").alias("rating_min"),
        )
    )
    clicked = F.when(d.unit("clicked") > 0.4, d.struct_choice("movie", MOVIES, ["id", "title", "genre"])["id"])
    out["search_queries"] = spark.range(1, BASE_ROWS["search_queries"] * scale + 1).select(
        F.concat(F.lit("search_"), (F.col("id") + 1000).cast("string")).alias("search_id"),
        _user(d, users).alias("user_id"),
        d.choice("query", QUERIES).alias("query"),
        F.date_format(_when_day(d, 2, 20, 0, 23), ISO_Z).alias("timestamp"),
        filters.alias("filters_applied"),
        d.int("results", 5, 50).alias("results_count"),
        clicked.alias("clicked_movie_id"),
        F.concat(F.lit("sess_"), d.int("session", 100, 999).cast("string")).alias("session_id"),
    )
    return out


def write_collections(collections: dict[str, DataFrame], base_path: str) -> dict[str, str]:
    """Export collections as JSON lines with an ``_id`` field, like a database export."""
    paths = {}
    for name, df in collections.items():
        path = f"{base_path.rstrip('/')}/{name}"
        key = df.columns[0]
        df.select(F.concat(F.lit("oid-"), F.col(key)).alias("_id"), "*").write.mode("overwrite").json(path)
        paths[name] = path
    return paths

