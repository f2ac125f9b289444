"""Joins of fact tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_facts(
    base: DataFrame, facts: Sequence[tuple[DataFrame, str]], key: str
) -> DataFrame:
    """Left outer equi-join of ``base`` to each fact on ``base[key] = fact[fact_key]``.

    Columns stay reachable as ``_base.<name>`` and ``_f<i>.<name>``.
    This is the reference's naive form: with several rows per key on each side it
    emits every combination of them, so the output grows with the product of the fact
    sizes per key. Use it for dimension-like facts (at most one row per key) only; for
    a mart over many-to-many facts use :func:`preaggregated_star`.
    """
    out = base.alias("_base")
    for i, (fact, fact_key) in enumerate(facts):
        alias = f"_f{i}"
        cond = F.col(f"_base.{key}") == F.col(f"{alias}.{fact_key}")
        out = out.join(fact.alias(alias), cond, "left")
    return out


def preaggregated_star(
    base_agg: DataFrame,
    fact_aggs: Sequence[DataFrame],
    key: str,
    zero_fill: Sequence[str] = (),
) -> DataFrame:
    """Join per-key aggregates of several facts to an aggregated base.

    ``base_agg`` is grouped by keys that include ``key``; every frame in ``fact_aggs``
    holds at most one row per ``key``. Each join is therefore many-to-one and the row
    count never grows. Counts of facts missing for a key become 0 (``zero_fill``),
    as ``COUNT`` over an unmatched left join gives 0. A NULL ``key`` never matches.
    """
    out = base_agg
    for fact in fact_aggs:
        out = out.join(fact, on=key, how="left")
    for name in zero_fill:
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("bigint")))
    return out


def anti_join(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key has no equal in ``other``.

    Plain equality, so a row with a NULL key component is always kept. ``other`` is
    reduced to its distinct keys first (combined map-side), so a hot key in ``other``
    does not land on one reducer.
    """
    return df.join(other.select(*keys).distinct(), on=list(keys), how="left_anti")
