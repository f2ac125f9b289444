"""S1 with quarantine: rows of a CSV that do not fit the declared schema are set aside.

A reader that fills NULL into what it cannot parse loses rows later without a word, one that
fails on the first bad line stops a load over a typing error. Here every line is parsed once,
with the corrupt-record column beside the typed ones, and written to one staged table in two
partitions: the good rows, and the rejected ones with their file, the line as it stands there
and the columns that are at fault. Counts are observed on that write. Without a place for
rejects the load fails, naming what was found first.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.operators.quality import DataQualityError
from martworks.operators.topn import with_arrival_order
from martworks.session import work_path

_LINE, _OK, _FILE = "_line", "_ok", "_file"
_BROKEN = "_broken"
REJECTS = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("line", T.StringType()),
        T.StructField("columns", T.ArrayType(T.StringType())),
    ]
)


@dataclass(frozen=True)
class Checked:
    """``good`` rows in the declared schema, ``rejected`` rows as (file, line, columns)."""

    good: DataFrame
    rejected: DataFrame
    rows: int
    rejects: int


def _at_fault(schema: T.StructType, options: Mapping[str, str], failed: Column) -> Column:
    """The columns that a rejected line holds text for and no value of the declared type;
    none if the line has another number of fields. ``failed``: those that fail a check."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    texts = texts.add(_BROKEN, T.StringType())
    form = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    parsed = F.from_csv(F.col(_LINE), F.lit(texts.toDDL()), form)
    wrong = [
        F.when(parsed[f.name].isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f.name))
        for f in schema.fields
    ]
    unparsed = F.when(parsed[_BROKEN].isNull(), F.array_compact(F.array(*wrong)))
    none = F.array().cast("array<string>")
    return F.when(F.col(_LINE).isNull(), failed).otherwise(
        F.array_union(F.coalesce(unparsed, none), failed)
    )


def read_csv_checked(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    rejects_path: str | None = None,
    checks: Mapping[str, Column] | None = None,
    position_col: str | None = None,
    at_most: int | None = None,
    options: Mapping[str, str] | None = None,
) -> Checked:
    """S1 with a declared schema; every line is either a good row or a rejected one.

    A line is rejected if a field does not parse as its declared type, if it has another
    number of fields, or if one of ``checks`` (column name -> condition on the typed row, NULL
    counts as true) does not hold. Empty fields are NULL and no fault. ``rejects_path`` gets
    the rejected rows (replaced at each run); without it, or with more than ``at_most`` of
    them, the load raises. A line that only fails a check is given as it would be written
    again, the others as they stand in the file. ``position_col`` adds the arrival order.
    """
    options = dict(options or {})
    read = T.StructType(list(schema.fields)).add(_LINE, T.StringType())
    reader = spark.read.schema(read).option("header", "true").options(**options)
    rows = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=_LINE).csv(path)
    if position_col:
        rows = with_arrival_order(rows, position_col)
    rows = rows.withColumn(_FILE, F.col("_metadata.file_path"))
    checks = dict(checks or {})
    failed = F.array_compact(
        F.array(
            F.lit(None).cast("string"),
            *[F.when(~F.coalesce(ok, F.lit(True)), F.lit(name)) for name, ok in checks.items()],
        )
    )
    columns = [F.col(f"`{f.name}`") for f in schema.fields]
    kept = [*columns, *([F.col(position_col)] if position_col else [])]
    rows = rows.withColumn("_failed", failed)
    ok = F.col(_LINE).isNull() & (F.size("_failed") == 0)
    seen = Observation()
    marked = rows.withColumn(_OK, ok).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(~F.col(_OK)).alias("rejects")
    )
    stage = work_path(spark, "checked-csv")
    marked.write.partitionBy(_OK).parquet(stage)
    kinds = T.StructType(list(rows.schema.fields)).add(_OK, T.BooleanType())
    staged = spark.read.schema(kinds).parquet(stage)
    counts = {k: seen.get.get(k, 0) for k in ("rows", "rejects")}

    again = F.to_csv(F.struct(*columns))
    rejected = staged.where(~F.col(_OK)).select(
        F.col(_FILE).alias("file"),
        F.coalesce(F.col(_LINE), again).alias("line"),
        _at_fault(schema, options, F.col("_failed")).alias("columns"),
    )
    too_many = at_most is not None and counts["rejects"] > at_most
    if too_many or (counts["rejects"] and rejects_path is None):
        first = rejected.orderBy("file", "line").first()
        raise DataQualityError(
            f"{counts['rejects']} of {counts['rows']} rows of {path} do not fit the schema; "
            f"the first in {first['file']}: {first['line']!r}, columns {first['columns']}"
        )
    if rejects_path is not None:
        rejected.write.mode("overwrite").parquet(rejects_path)
        rejected = spark.read.schema(REJECTS).parquet(rejects_path)
    return Checked(staged.where(F.col(_OK)).select(*kept), rejected, counts["rows"], counts["rejects"])

