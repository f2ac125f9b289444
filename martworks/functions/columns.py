"""Column-level conversions.

Each function maps a ``Column`` to a ``Column`` and is built from Spark expressions
only, so it runs inside the generated code of the stage that uses it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the text forms a Python ``float()`` accepts for a finite number, minus
# underscores (deviation X4): optional sign, digits with an optional fraction or a bare
# fraction, optional exponent, surrounding white space allowed.
NUMERIC_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

_INF = float("inf")


def as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def to_float(c) -> Column:
    """Text -> double; empty, malformed, NaN and infinite values -> NULL."""
    text = as_col(c).cast("string")
    value = F.when(text.rlike(NUMERIC_TEXT), text.try_cast("double"))
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(_INF)), value)


def to_int(c) -> Column:
    """Like ``int(float(text))``: parse as double, truncate toward zero.

    A value outside the INTEGER range fails the job (ANSI cast), as the load into an
    INTEGER column does.
    """
    return to_float(c).cast("int")


def to_decimal(c, precision: int = 10, scale: int = 2) -> Column:
    """Rounded fixed point (half away from zero); out of range fails the job."""
    return as_col(c).cast(T.DecimalType(precision, scale))


def to_json_text(c) -> Column:
    """Nested value -> JSON text. An empty array gives ``[]``, NULL stays NULL."""
    return F.to_json(as_col(c))


def join_array(c, sep: str = ", ") -> Column:
    """List of strings -> ``"a, b"``; a NULL list stays NULL."""
    return F.array_join(as_col(c), sep)


def map_values(c, mapping: dict, default=None) -> Column:
    """Look a value up in a fixed mapping; anything else -> default, NULL and keys
    mapped to None included."""
    col = as_col(c)
    if not mapping:
        return F.lit(default)
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    looked_up = F.when(col.isNotNull(), F.try_element_at(F.create_map(*pairs), col))
    return F.coalesce(looked_up, F.lit(default))


def text_length(c) -> Column:
    """Length in characters (code points); NULL stays NULL."""
    return F.length(as_col(c))
