"""Top-n rows and extremes (L1-L3).

``orderBy(...).limit(n)`` plans as ``TakeOrderedAndProject``: every partition keeps its
own n best rows and only n x partitions rows reach the final merge, so there is no
global sort and no shuffle of the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _order(col: str, ascending: bool, tie_order: Sequence[str]):
    c = F.col(col)
    first = c.asc_nulls_last() if ascending else c.desc_nulls_last()
    return [first] + [F.col(t).asc_nulls_last() for t in tie_order]


def top_n(
    df: DataFrame,
    n: int,
    col: str,
    ascending: bool = False,
    tie_order: Sequence[str] = (),
    keep_nulls: bool = False,
) -> DataFrame:
    """L1: the n largest (or smallest) rows by ``col``.

    Ties are broken by ``tie_order`` (arrival order: pass a sequence column). Like
    pandas ``nlargest``, rows with a NULL ``col`` are left out unless ``keep_nulls``,
    in which case they sort last.
    """
    src = df if keep_nulls else df.where(F.col(col).isNotNull())
    return src.orderBy(*_order(col, ascending, tie_order)).limit(n)


def extremes(
    df: DataFrame,
    n: int,
    col: str,
    tie_order: Sequence[str] = (),
    side_col: str = "extreme_side",
    rank_col: str = "extreme_rank",
) -> DataFrame:
    """L2: the n largest rows followed by the n smallest, every column, duplicates kept.

    The order of the result is carried by ``side_col`` ('top' | 'bottom') and
    ``rank_col`` (1..n within the side); the window runs over at most 2n rows.
    """
    parts = []
    for side, asc in (("top", False), ("bottom", True)):
        picked = top_n(df, n, col, ascending=asc, tie_order=tie_order)
        w = Window.orderBy(*_order(col, asc, tie_order))
        parts.append(
            picked.withColumn(side_col, F.lit(side)).withColumn(rank_col, F.row_number().over(w))
        )
    return union_all(parts)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """L3: concatenate frames, columns matched by name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def with_arrival_order(df: DataFrame, name: str = "_arrival") -> DataFrame:
    """A sortable arrival order for rows read from files: (file path, position in read).

    Call it directly after the read, before any shuffle.
    """
    return df.withColumn(
        name,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.monotonically_increasing_id().alias("pos"),
        ),
    )
