"""Exact quantiles and the quantile trim.

``percentile`` keeps a map of every distinct value in one final task, which does not
scale. Here the column's distinct values with their counts (a value held by a third of all
rows is one row after the map-side combine) are range-partitioned by value and staged.
Ranges are cut from a sample, so any spacing of the values gives even parts. One row per
part reaches the driver: its rows, smallest and largest value. The parts that hold the
wanted ranks are read again and a running count inside each finds the values. That is a
fixed number of jobs, whatever the values look like.

Linear interpolation between the two neighbouring order statistics gives the same number
as pandas ``quantile`` and SQL ``quantile_cont``. The trim itself is a literal range
filter, which reaches the Parquet scan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martworks.session import work_path

_V = "_qv"


def exact_quantiles(df: DataFrame, col: str | Column, probs: Sequence[float]) -> list:
    """Exact quantiles with linear interpolation; NULL and NaN are ignored.

    Returns ``None`` for every probability when there is no value.
    """
    spark = df.sparkSession
    c = col if isinstance(col, Column) else F.col(col)
    vals = df.select(c.cast("double").alias(_V)).where(F.col(_V).isNotNull() & ~F.isnan(_V))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = (
        vals.groupBy(_V)
        .agg(F.count(F.lit(1)).alias("n"))
        .repartitionByRange(parts, _V)
        .withColumn("part", F.spark_partition_id())
    )
    # staged: the ranges come from a sample and must not be drawn again between the passes
    path = work_path(spark, "quantiles")
    counted.write.parquet(path)
    counted = spark.read.schema(counted.schema).parquet(path)
    rows = counted.groupBy("part").agg(F.sum("n").alias("n"), F.min(_V).alias("lo")).collect()
    total = sum(r["n"] for r in rows)
    if not total:
        return [None for _ in probs]
    positions = [(total - 1) * p for p in probs]
    wanted = sorted({math.floor(h) for h in positions} | {math.ceil(h) for h in positions})
    before, ranks = 0, []
    for row in sorted(rows, key=lambda r: r["lo"]):
        ranks += [(r, row["part"], r - before) for r in wanted if before <= r < before + row["n"]]
        before += row["n"]
    upto = Window.partitionBy("part").orderBy(_V)
    inside = counted.where(F.col("part").isin(sorted({p for _, p, _ in ranks})))
    inside = inside.withColumn("upto", F.sum("n").over(upto))
    hit = F.lit(False)
    for _, part, local in ranks:
        held = (F.col("upto") - F.col("n") <= local) & (F.col("upto") > local)
        hit = hit | ((F.col("part") == part) & held)
    found = inside.where(hit).collect()
    value = {
        r: next(
            row[_V]
            for row in found
            if row["part"] == part and row["upto"] - row["n"] <= local < row["upto"]
        )
        for r, part, local in ranks
    }
    result = []
    for h in positions:
        lo, hi = value[math.floor(h)], value[math.ceil(h)]
        frac = h - math.floor(h)
        result.append(lo if frac == 0 else lo + (hi - lo) * frac)
    return result


def quantile_trim(df: DataFrame, col: str, lo: float = 0.05, hi: float = 0.95) -> DataFrame:
    """Keep rows with ``q_lo <= col <= q_hi``, as pandas does; NULL drops."""
    q_lo, q_hi = exact_quantiles(df, col, [lo, hi])
    if q_lo is None or q_hi is None:
        return df.where(F.lit(False))
    return df.where(F.col(col).between(F.lit(q_lo), F.lit(q_hi)))
