"""P7 by load day: marts from mergeable states, so that a reloaded day is recomputed alone.

A mart's figures are sums, extremes, distinct counts and most frequent values. All of them
follow from counts by (group, value), and these add up over days. The state of a load day is
that table for the day's rows, stored in the partition of the day; a mart is its states added
up. A daily run reads one partition of each replicated table, never the earlier days' rows; a
day that is loaded again replaces its state, and later days' states go as their rows do (M4).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martworks.plans import marts
from martworks.sinks import writers
from martworks.sinks.merge_writers import drop_partitions_after
from martworks.sources import readers

DAY = "load_date"
#: How a state's figures of several days become one.
_MERGE = {
    "_rows": F.sum, "_minutes": F.sum, "_timed": F.sum, "_completed": F.sum, "_revenue": F.sum,
    "_amounts": F.sum, "_ratings": F.sum, "_rated": F.sum, "_first": F.min, "_last": F.max,
}


@dataclass(frozen=True)
class State:
    """The parts of one fact: ``make`` turns rows of ``table`` into them."""

    table: str
    make: Callable[[DataFrame], DataFrame]


STATES = {
    "activity": State("movie_views", marts.activity_parts),
    "content_views": State("movie_views", marts.content_view_parts),
    "content_ratings": State("content_ratings", marts.rating_parts),
    "content_searches": State("search_queries", marts.search_parts),
    "payments": State("user_payments", marts.payment_parts),
}
#: Mart -> its states, in the order of the arguments of the function that finishes it.
MARTS = {
    "mart_user_activity": (("activity",), marts.activity_of),
    "mart_content_performance": (
        ("content_views", "content_ratings", "content_searches"), marts.content_of,
    ),
    "mart_payment_analysis": (("payments",), marts.payments_of),
}


def merged(states: DataFrame) -> DataFrame:
    """The states of all days as one: equal groups added up."""
    figures = [c for c in states.columns if c in _MERGE]
    keys = [c for c in states.columns if c not in figures and c != DAY]
    # a sum keeps the stored type: one day or many give the same columns
    added = [
        _MERGE[c](c).cast(states.schema[c].dataType).alias(c) if _MERGE[c] is F.sum
        else _MERGE[c](c).alias(c)
        for c in figures
    ]
    return states.groupBy(*keys).agg(*added)


def day_rows(spark: SparkSession, table_path: str, day: date) -> DataFrame:
    """One load day of a replicated table: a partition filter."""
    return spark.read.parquet(table_path).where(F.col(DAY) == F.lit(day)).drop(DAY)


def refresh_state(
    spark: SparkSession, name: str, table_path: str, states_dir: str, day: date
) -> DataFrame:
    """Write the state ``name`` of ``day`` and drop those of later days; all that are stored.

    Rows without a load day (the NULL partition) are in no state.
    """
    path = f"{states_dir.rstrip('/')}/{name}"
    parts = STATES[name].make(day_rows(spark, table_path, day)).withColumn(DAY, F.lit(day))
    seen = Observation()
    parts = parts.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DAY).parquet(path)
    rows = seen.get.get("rows", 0)
    drop_partitions_after(spark, path, DAY, day, and_day=rows == 0)
    stored = writers.stored_table(spark, path)
    return spark.createDataFrame([], parts.schema) if stored is None else stored


def refresh_marts(
    spark: SparkSession,
    table_paths: Mapping[str, str],
    states_dir: str,
    out_dir: str,
    day: date,
    names: Sequence[str] = tuple(MARTS),
    publish: str | None = None,
) -> dict[str, DataFrame]:
    """P7 after a load of ``day`` (M4): its states anew, then the marts from all states.

    ``table_paths`` names the replicated tables by collection; marts whose tables are not
    among them are left out. ``names`` and ``publish`` as in :func:`martworks.plans.jobs.build_marts`.
    """
    out = {}
    for mart in names:
        parts, finish = MARTS[mart]
        if not all(STATES[part].table in table_paths for part in parts):
            continue
        states = [
            merged(refresh_state(spark, part, table_paths[STATES[part].table], states_dir, day))
            for part in parts
        ]
        path = f"{out_dir.rstrip('/')}/{mart}"
        if publish is None:
            writers.write_parquet(finish(*states), path)
            out[mart] = readers.read_parquet(spark, path)
        else:
            writers.publish_table(finish(*states), f"{publish}{mart}", path)
            out[mart] = spark.table(f"{publish}{mart}")
    return out
