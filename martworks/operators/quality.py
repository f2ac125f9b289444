"""Data-quality gates and load reports (V1-V6).

Reports are DataFrames computed by Spark aggregations. Gates run one small action
(``isEmpty`` reads at most one row; ``require_not_null`` collects one aggregate row)
and raise on failure.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DataQualityError(ValueError):
    """A gate failed; the message names the table or columns."""


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """V1: one row ``(table_name, row_count)`` per table, all in one job."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.col("row_count")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def require_nonempty(tables: Mapping[str, DataFrame]) -> None:
    """V2: fail when a source has no rows, naming the first empty one."""
    for name, df in tables.items():
        if df.isEmpty():
            raise DataQualityError(f"Source table {name} is empty")


def gate_report(
    nonempty: Mapping[str, DataFrame],
    records: Mapping[str, DataFrame],
    not_null: Mapping[str, tuple[DataFrame, Sequence[str]]],
) -> DataFrame:
    """V2, V5 and V6 as rows (gate, table_name, failures) instead of an error: 1 for an
    empty table, the number of NULLs for a NOT NULL column (``table.column``)."""
    parts = []
    for gate, tables in (("V2", nonempty), ("V5", records)):
        for name, df in tables.items():
            empty = (F.count(F.lit(1)) == 0).cast("bigint")
            parts.append(df.agg(empty.alias("failures")).withColumn("at", F.lit(f"{gate}|{name}")))
    for name, (df, cols) in not_null.items():
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        rows = F.explode(F.array(*[
            F.struct(F.col(c).alias("failures"), F.lit(f"V6|{name}.{c}").alias("at")) for c in cols
        ]))
        parts.append(counts.select(rows.alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, parts).select(
        F.split_part("at", F.lit("|"), F.lit(1)).alias("gate"),
        F.split_part("at", F.lit("|"), F.lit(2)).alias("table_name"),
        "failures",
    )


def load_report(table: DataFrame, date_col: str, new_flag: str | None = None) -> DataFrame:
    """V3: total rows, first and last date, and rows added in this run.

    ``new_flag`` names a boolean column marking the rows this run added; without it the
    report shows 0 new rows. One aggregate, one scan.
    """
    new_rows = F.count_if(F.col(new_flag)) if new_flag else F.lit(0).cast("bigint")
    return table.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min(date_col).alias("min_date"),
        F.max(date_col).alias("max_date"),
        new_rows.alias("new_rows"),
    )


def table_profile(df: DataFrame) -> DataFrame:
    """V4: row count and the column list, one row per column, in one job; each column
    also carries its relational type (T16)."""
    from martworks.operators.transform import sql_type

    columns = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(i + 1).alias("ordinal_position"),
                F.lit(sql_type(f.dataType)).alias("sql_type"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return (
        df.agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.inline(columns), F.col("row_count"))
    )


def require_records(df: DataFrame, what: str = "batch") -> DataFrame:
    """V5: fail on an empty batch before transform or load; returns ``df``."""
    if df.isEmpty():
        raise DataQualityError(f"No data in {what}")
    return df


def require_not_null(df: DataFrame, cols: Sequence[str], what: str = "table") -> DataFrame:
    """V6: fail when a NOT NULL column holds NULL; one aggregate over ``df``."""
    if not cols:
        return df
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    bad = {c: row[c] for c in cols if row[c]}
    if bad:
        raise DataQualityError(f"NULL in NOT NULL column(s) of {what}: {bad}")
    return df
