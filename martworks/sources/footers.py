"""Answers from file statistics: counts and extremes of a stored table without its rows.

Parquet files carry the row count of each row group and the least and greatest value of each
column. Spark's DataSource V2 scan can answer ``count``, ``min`` and ``max`` from them, the V1
scan that ``spark.read.parquet`` uses by default cannot. The functions here read a table through
the V2 scan for one aggregate, worked out at once: on a table of any size the job reads
footers only. Where the statistics don't serve (text, timestamps, a filter) Spark scans the
columns concerned; the answer is the same.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_V1_SOURCES = "spark.sql.sources.useV1SourceList"
_PUSH = "spark.sql.parquet.aggregatePushdown"
_NO_STATISTICS = "No min/max found"


@contextmanager
def footer_scan(spark: SparkSession) -> Iterator[None]:
    """Within the block Parquet is read through the V2 scan and aggregates are pushed into it."""
    before = {key: spark.conf.get(key) for key in (_V1_SOURCES, _PUSH)}
    v1 = [s for s in before[_V1_SOURCES].split(",") if s.strip().lower() != "parquet"]
    spark.conf.set(_V1_SOURCES, ",".join(v1))
    spark.conf.set(_PUSH, "true")
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _aggregate(spark: SparkSession, path: str, *aggregates: Column) -> tuple[Row | None, str]:
    """The aggregate row of the table at ``path`` (None without files) and its plan."""
    with footer_scan(spark):
        try:
            df = spark.read.parquet(path).agg(*aggregates)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None, ""
            raise
        plan = df._jdf.queryExecution().executedPlan().toString
        try:
            # files without row groups have no statistics: their count comes as NULL
            return df.collect()[0], plan()
        except Exception as error:
            if _NO_STATISTICS not in str(error):
                raise
    # a file with NULLs only, or written without statistics: its columns are read
    df = spark.read.parquet(path).agg(*aggregates)
    return df.collect()[0], df._jdf.queryExecution().executedPlan().toString()


def table_files(spark: SparkSession, table: str, col: str) -> str | None:
    """The folder of a catalog table whose files say all there is to ``col``: Parquet, not
    partitioned by it and without a default value for files that lack it."""
    field = next((f for f in spark.table(table).schema.fields if f.name == col), None)
    if field is None or any("DEFAULT" in key for key in field.metadata):
        return None
    about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    partitioned = "# Partition Information" in about
    if partitioned or about.get("Provider", "").lower() != "parquet":
        return None
    return about.get("Location")


def stored_watermark(
    spark: SparkSession, path: str, col: str, default: date | datetime | int | float
):
    """M5 on a stored table: the greatest value of ``col``; ``default`` when the table or the
    column is missing or there is no row."""
    try:
        row, _ = _aggregate(spark, path, F.max(col))
    except AnalysisException as error:
        if error.getCondition() != "UNRESOLVED_COLUMN.WITH_SUGGESTION":
            raise
        return default
    return default if row is None or row[0] is None else row[0]


def stored_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """V1 on stored tables: one row (table_name, row_count) for each, 0 without files."""
    counts = []
    for name, path in paths.items():
        row, _ = _aggregate(spark, path, F.count(F.lit(1)))
        counts.append((name, 0 if row is None else row[0] or 0))
    return spark.createDataFrame(counts, "table_name string, row_count long")


def stored_report(spark: SparkSession, path: str, date_col: str, new_rows: int = 0) -> DataFrame:
    """V3 on a stored table: total rows, first and last date, and the rows a run added."""
    aggregates = [F.count(F.lit(1)), F.min(date_col), F.max(date_col)]
    row, _ = _aggregate(spark, path, *aggregates)
    kind = T.DateType() if row is None else spark.read.parquet(path).schema[date_col].dataType
    schema = T.StructType(
        [
            T.StructField("total_rows", T.LongType()),
            T.StructField("min_date", kind),
            T.StructField("max_date", kind),
            T.StructField("new_rows", T.LongType()),
        ]
    )
    values = (0, None, None) if row is None else (row[0] or 0, *row[1:])
    return spark.createDataFrame([(*values, new_rows)], schema)


def pushed_plan(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> str:
    """The plan of count, min and max of ``columns``, to see what is pushed into the scan."""
    extremes = [f(c) for c in columns for f in (F.min, F.max)]
    return _aggregate(spark, path, F.count(F.lit(1)), *extremes)[1]
