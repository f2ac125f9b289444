"""S1 with inferred types in one parse.

Inference by the reader parses every line twice: once to find the types, once to read. Here the
lines are parsed once, as text, into a staged table, and on the same write one aggregate counts
for every column how many values fit each type of the lattice; the smallest type that all
values fit is the column's, and the staged text is cast to it. The types are those of the
reader's inference.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.functions.columns import NUMERIC_TEXT
from martworks.session import work_path

# The texts of dates, timestamps and special numbers that the reader takes.
DATE = r"^\d{4}-\d{2}-\d{2}$"
TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})?$"
SPECIAL = ("NaN", "Inf", "-Inf")
WHOLE = r"^[+-]?\d+$"


def _fits(text: Column) -> dict[str, Column]:
    """Type -> whether a value's text is one of it."""
    whole, day = text.rlike(WHOLE), text.rlike(DATE)
    return {
        "int": whole & text.try_cast("int").isNotNull(),
        "bigint": whole & text.try_cast("bigint").isNotNull(),
        "double": text.rlike(NUMERIC_TEXT) | text.isin(*SPECIAL),
        "date": day & text.try_cast("date").isNotNull(),
        "timestamp": (day | text.rlike(TIMESTAMP)) & text.try_cast("timestamp").isNotNull(),
        "boolean": F.lower(text).isin("true", "false"),
    }


def infer_types(texts: DataFrame) -> tuple[DataFrame, Observation, list[str]]:
    """``texts`` with the lattice's counts observed on it; see :func:`types_of`."""
    seen, names = Observation(), texts.columns
    counts = []
    for i, name in enumerate(names):
        text = F.col(f"`{name}`")
        counts.append(F.count(text).alias(f"{i}:values"))
        counts += [F.count_if(fits).alias(f"{i}:{kind}") for kind, fits in _fits(text).items()]
    return texts.observe(seen, *counts), seen, names


def types_of(counts: Mapping[str, int], names: list[str]) -> dict[str, str]:
    """Column -> the smallest type that all its values fit; text where there is none."""
    out = {}
    for i, name in enumerate(names):
        n = counts.get(f"{i}:values", 0)
        kinds = [k.split(":", 1)[1] for k, v in counts.items() if k.startswith(f"{i}:") and v == n]
        order = ["int", "bigint", "double", "date", "timestamp", "boolean"]
        out[name] = next((k for k in order if n and k in kinds), "string")
    return out


def read_csv_inferred(
    spark: SparkSession, path: str, options: Mapping[str, str] | None = None
) -> DataFrame:
    """CSV with a header row, types inferred; the files are parsed once.

    A line with another number of fields fails the job.
    """
    reader = spark.read.option("header", "true").options(**dict(options or {}))
    names = reader.csv(path).columns  # the header only
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    texts = reader.schema(schema).option("mode", "FAILFAST").csv(path)
    watched, seen, names = infer_types(texts)
    stage = work_path(spark, "inferred-csv")
    watched.write.parquet(stage)
    kinds = types_of(seen.get, names)
    stored = spark.read.schema(schema).parquet(stage)
    return stored.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in names])
