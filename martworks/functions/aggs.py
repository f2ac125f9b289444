"""Aggregate expressions used by the marts.

All of them are built-in Catalyst aggregates, so they take part in partial (map-side)
aggregation and whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.functions.columns import as_col


def count_distinct(col) -> Column:
    """A1: exact distinct count, NULLs ignored."""
    return F.count_distinct(as_col(col))


def count_if(cond) -> Column:
    """A4: ``SUM(CASE WHEN cond THEN 1 ELSE 0 END)``; a NULL condition counts as 0."""
    return F.count_if(as_col(cond))


def count_distinct_if(cond, col) -> Column:
    """A5: ``COUNT(DISTINCT CASE WHEN cond THEN col END)``."""
    return F.count_distinct(F.when(as_col(cond), as_col(col)))


def safe_pct(num, den) -> Column:
    """``num::FLOAT / NULLIF(den, 0) * 100``; a zero or NULL denominator gives NULL."""
    return as_col(num).cast("double") / F.nullif(as_col(den), F.lit(0)) * F.lit(100.0)


def mode_table(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    """A3 as two plain aggregations: count each (keys, value), then per key take the
    value with the highest count, the smallest value on ties. NULL values are ignored;
    a group with only NULLs has no row (a left join gives it NULL).

    Both steps combine map-side, so a hot key or a hot value is reduced before the
    shuffle; the result has one row per key and joins back without row growth.
    """
    counted = (
        df.where(F.col(col).isNotNull())
        .groupBy(*keys, col)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    return counted.groupBy(*keys).agg(
        F.min_by(F.col(col), F.struct(-F.col("_n"), F.col(col))).alias(name)
    )
