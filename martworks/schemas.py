"""Declared schemas of the reference's sources and target tables (FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()  # noqa: E741
TS = T.TimestampNTZType()
DEC = T.DecimalType(10, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


# ---------------------------------------------------------------- sensor readings (CSV)
SENSOR_CSV = _struct(("id", S), ("room_id/id", S), ("noted_date", S), ("temp", T.DoubleType()), ("out/in", S))

# ---------------------------------------------------------------- pets (JSON object with an array)
PET = _struct(
    ("name", S), ("species", S), ("favFoods", T.ArrayType(S)), ("birthYear", I), ("photo", S)
)
PETS_TABLE = _struct(
    ("name", S), ("species", S), ("favfoods", S), ("birthyear", I), ("photo", S),
    ("loaded_at", TS),
)
PETS_KEYS = ("name", "species", "birthyear")

# ---------------------------------------------------------------- nutrition (XML)
FOOD = _struct(
    ("name", T.ArrayType(S)),
    ("mfr", S),
    ("serving", _struct(("_VALUE", S), ("_units", S))),
    ("calories", _struct(("_total", S), ("_fat", S))),
    ("total-fat", S),
    ("saturated-fat", S),
    ("cholesterol", S),
    ("sodium", S),
    ("carb", S),
    ("fiber", S),
    ("protein", S),
    ("vitamins", _struct(("a", S), ("c", S))),
    ("minerals", _struct(("ca", S), ("fe", S))),
)
# Output column <- source path, as the reference maps them.
FOOD_COLUMNS = (
    ("try_element_at(name, 1)", "name"),  # the first <name> wins (X2)
    ("mfr", "manufacturer"),
    ("serving._VALUE", "serving_value"),
    ("serving._units", "serving_units"),
    ("calories._total", "calories_total"),
    ("calories._fat", "calories_fat"),
    ("`total-fat`", "total_fat"),
    ("`saturated-fat`", "saturated_fat"),
    ("cholesterol", "cholesterol"),
    ("sodium", "sodium"),
    ("carb", "carbohydrates"),
    ("fiber", "fiber"),
    ("protein", "protein"),
    ("vitamins.a", "vitamin_a"),
    ("vitamins.c", "vitamin_c"),
    ("minerals.ca", "calcium"),
    ("minerals.fe", "iron"),
)
FOOD_DECIMALS = ("serving_value", "total_fat", "saturated_fat", "carbohydrates", "fiber", "protein")
FOOD_INTS = (
    "calories_total", "calories_fat", "cholesterol", "sodium", "vitamin_a", "vitamin_c",
    "calcium", "iron",
)
NUTRITION_TABLE = _struct(
    ("name", S), ("manufacturer", S), ("serving_value", DEC), ("serving_units", S),
    ("calories_total", I), ("calories_fat", I), ("total_fat", DEC), ("saturated_fat", DEC),
    ("cholesterol", I), ("sodium", I), ("carbohydrates", DEC), ("fiber", DEC), ("protein", DEC),
    ("vitamin_a", I), ("vitamin_c", I), ("calcium", I), ("iron", I), ("loaded_at", TS),
)
NUTRITION_KEYS = ("name", "manufacturer")

# ---------------------------------------------------------------- document collections (JSON lines)
DEVICE = _struct(("type", S), ("os", S), ("browser", S))

# Numbers and the fields that are kept as JSON text are declared as text: T5 parses the
# numbers whether the document holds 90, 90.0 or "90", and no nested field is cut off.
RAW_COLLECTIONS = {
    "movie_views": _struct(
        ("_id", S), ("view_id", S), ("user_id", S), ("movie_id", S), ("movie_title", S),
        ("genre", S), ("start_time", S), ("end_time", S), ("watch_duration_minutes", S),
        ("completed", T.BooleanType()), ("device", DEVICE), ("interactions", S),
    ),
    "user_payments": _struct(
        ("_id", S), ("payment_id", S), ("user_id", S), ("payment_date", S),
        ("amount", S), ("currency", S), ("payment_method", S),
        ("subscription_plan", S), ("status", S), ("next_billing_date", S),
        ("promo_code_applied", S),
    ),
    "content_ratings": _struct(
        ("_id", S), ("rating_id", S), ("user_id", S), ("movie_id", S), ("movie_title", S),
        ("rating", S), ("review_text", S), ("created_at", S), ("helpful_count", S),
        ("reports_count", S), ("moderation_flag", T.BooleanType()),
    ),
    "search_queries": _struct(
        ("_id", S), ("search_id", S), ("user_id", S), ("query", S), ("timestamp", S),
        ("filters_applied", S), ("results_count", S), ("clicked_movie_id", S),
        ("session_id", S),
    ),
}

TARGET_TABLES = {
    "movie_views": _struct(
        ("view_id", S), ("user_id", S), ("movie_id", S), ("movie_title", S), ("genre", S),
        ("start_time", TS), ("end_time", TS), ("watch_duration_minutes", I),
        ("completed", T.BooleanType()), ("device_type", S), ("device_os", S),
        ("interactions", S), ("loaded_at", TS), ("source", S),
    ),
    "user_payments": _struct(
        ("payment_id", S), ("user_id", S), ("payment_date", TS), ("amount", DEC),
        ("currency", S), ("payment_method", S), ("payment_method_category", S),
        ("subscription_plan", S), ("status", S), ("next_billing_date", TS),
        ("promo_code_applied", S), ("loaded_at", TS), ("source", S),
    ),
    "content_ratings": _struct(
        ("rating_id", S), ("user_id", S), ("movie_id", S), ("movie_title", S), ("rating", I),
        ("review_text", S), ("created_at", TS), ("helpful_count", I), ("reports_count", I),
        ("moderation_flag", T.BooleanType()), ("loaded_at", TS), ("source", S),
    ),
    "search_queries": _struct(
        ("search_id", S), ("user_id", S), ("query", S), ("query_length", I), ("timestamp", TS),
        ("filters_applied", S), ("results_count", I), ("clicked_movie_id", S),
        ("session_id", S), ("loaded_at", TS), ("source", S),
    ),
}

TARGET_KEYS = {
    "movie_views": "view_id",
    "user_payments": "payment_id",
    "content_ratings": "rating_id",
    "search_queries": "search_id",
}

# Column defaults of the target tables.
TARGET_DEFAULTS = {
    "content_ratings": {"reports_count": 0, "moderation_flag": False},
}

# Payment method -> category; anything else (NULL included) -> 'other'.
PAYMENT_METHOD_CATEGORY = {"credit_card": "card", "paypal": "digital", "gift_card": "voucher"}
PAYMENT_METHOD_DEFAULT = "other"


def empty_targets(spark) -> dict:
    return {name: spark.createDataFrame([], schema) for name, schema in TARGET_TABLES.items()}
