from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException, SparkRuntimeException
from pyspark.sql import functions as F

from martworks.functions import columns as C


def _one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "text,as_float,as_int",
    [
        ("12.7", 12.7, 12),
        ("-12.7", -12.7, -12),
        (" 3 ", 3.0, 3),
        ("x", None, None),
        ("", None, None),
        (None, None, None),
        ("nan", None, None),
        ("inf", None, None),
        ("5d", None, None),
        ("1_000", None, None),
        ("1e3", 1000.0, 1000),
        (".5", 0.5, 0),
        ("1e400", None, None),
    ],
)
def test_to_float_and_to_int(spark, text, as_float, as_int):
    assert _one(spark, C.to_float, text) == as_float
    assert _one(spark, C.to_int, text) == as_int


def test_to_int_out_of_range_fails(spark):
    with pytest.raises((ArithmeticException, SparkRuntimeException, Exception)):
        _one(spark, C.to_int, "1e12")


def test_to_decimal_rounds_half_away_from_zero(spark):
    assert _one(spark, lambda c: C.to_decimal(C.to_float(c)), "2.675") == Decimal("2.68")
    assert _one(spark, lambda c: C.to_decimal(C.to_float(c)), "-2.675") == Decimal("-2.68")


def test_map_values_default_for_unknown_and_null(spark):
    mapping = {"credit_card": "card", "paypal": "digital", "gift_card": "voucher"}
    f = lambda c: C.map_values(c, mapping, "other")
    assert _one(spark, f, "paypal") == "digital"
    assert _one(spark, f, "cash") == "other"
    assert _one(spark, f, None) == "other"
    big = {f"k{i}": f"v{i}" for i in range(100)}
    g = lambda c: C.map_values(c, big, "none")
    assert _one(spark, g, "k42") == "v42"
    assert _one(spark, g, None) == "none"


def test_join_array(spark):
    assert _one(spark, C.join_array, ["a", "b"], "array<string>") == "a, b"
    assert _one(spark, C.join_array, None, "array<string>") is None
    assert _one(spark, C.join_array, [], "array<string>") == ""


def test_text_length_counts_code_points(spark):
    assert _one(spark, C.text_length, "héllo wörld") == 11
    assert _one(spark, C.text_length, "a\U0001F600b") == 3
    assert _one(spark, C.text_length, None) is None


def test_to_json_text(spark):
    df = spark.createDataFrame(
        [([], {"genre": None, "year_from": None}), (None, None)],
        "a array<struct<type:string>>, s struct<genre:string,year_from:int>",
    )
    rows = df.select(C.to_json_text("a").alias("a"), C.to_json_text("s").alias("s")).collect()
    assert rows[0]["a"] == "[]" and rows[0]["s"] == "{}"
    assert rows[1]["a"] is None and rows[1]["s"] is None
