"""Property tests: numeric text parsing against Python's float()."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martworks.functions import columns as C


def python_to_float(text):
    """The reference's rule with the documented deviations: no underscores, and NaN or
    infinity become NULL."""
    if not text or "_" in text:
        return None
    try:
        value = float(text)
    except ValueError:
        return None
    return None if math.isnan(value) or math.isinf(value) else value


def python_to_int(text):
    value = python_to_float(text)
    return None if value is None else int(value)


_digits = st.text(alphabet="0123456789", min_size=0, max_size=6)
_numberish = st.builds(
    lambda sign, a, dot, b, exp, pad: f"{pad}{sign}{a}{dot}{b}{exp}{pad}",
    st.sampled_from(["", "+", "-"]),
    _digits,
    st.sampled_from(["", "."]),
    _digits,
    st.sampled_from(["", "e3", "E-2", "e+1", "e", "d", "f"]),
    st.sampled_from(["", " ", "\t"]),
)
_texts = st.one_of(
    _numberish,
    st.sampled_from(["nan", "inf", "-inf", "Infinity", "1_000", "", " ", "x", "1.2.3", "--1", "0x10"]),
)


@settings(max_examples=6, deadline=None)
@given(st.lists(_texts, min_size=50, max_size=200))
def test_to_float_and_to_int_follow_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select(
        "i", C.to_float("t").alias("f"), F.when(F.abs(C.to_float("t")) < 2**31, C.to_int("t")).alias("n")
    ).collect()
    for row in rows:
        text = texts[row["i"]]
        want = python_to_float(text)
        assert row["f"] == want, (text, row["f"], want)
        if want is not None and abs(want) < 2**31:
            assert row["n"] == python_to_int(text), text
