"""Frame-level cleaning and conforming operators.

Each takes a DataFrame and returns a DataFrame; only column metadata is inspected on
the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime  # noqa: F401  (re-exported for callers)

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.functions.columns import as_col, to_float


class SchemaError(ValueError):
    """Column names or types do not fit the declared target."""


def normalize_name(name: str) -> str:
    return name.lower().replace(" ", "_").replace("/", "_").replace("-", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Lower-case names; space, '/' and '-' become '_'. Colliding names raise."""
    names = [normalize_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, new in zip(df.columns, names):
        if new in seen:
            raise SchemaError(f"columns {seen[new]!r} and {old!r} both normalise to {new!r}")
        seen[new] = old
    return df.toDF(*names)


def filter_equals(df: DataFrame, col: str, value) -> DataFrame:
    """Case-sensitive equality; a NULL value never matches."""
    return df.where(F.col(col) == F.lit(value))


# Day, month, hour and minute take one or two digits, as ``strptime``'s %d-%m-%Y %H:%M.
SENSOR_DATE_PATTERN = "d-M-yyyy H:m"


def parse_date(df: DataFrame, col: str, pattern: str = SENSOR_DATE_PATTERN) -> DataFrame:
    """Text in ``pattern`` -> DATE. A malformed value fails the job (ANSI mode)."""
    return df.withColumn(col, F.to_date(F.to_timestamp(F.col(col), pattern)))


def coerce_timestamp(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """T4: ISO-8601 text -> TIMESTAMP_NTZ (UTC wall clock, a trailing 'Z' accepted);
    a bad value becomes NULL."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns(
        {c: F.col(c).cast("string").try_cast(T.TimestampNTZType()) for c in present}
    )


def coerce_numeric(df: DataFrame, cols: Sequence[str], dtype="double") -> DataFrame:
    """T5: text or number -> number of ``dtype``; a bad value becomes NULL.

    Text is read as T6 reads it (``5d`` is no number), whole numbers by way of double
    (``12.0`` is 12, a fraction is cut off as in T6).
    """
    present = [c for c in cols if c in df.columns]

    def parse(c):
        if not isinstance(df.schema[c].dataType, T.StringType):
            return F.col(c).try_cast(dtype)
        return to_float(c).try_cast(dtype)

    return df.withColumns({c: parse(c) for c in present})


def flatten_struct(
    df: DataFrame, col: str, fields: Sequence[str], prefix: str | None = None
) -> DataFrame:
    """``device.type`` -> ``device_type`` for the listed fields, then drop ``device``.

    Fields not listed are dropped with the struct. A missing struct column leaves the
    frame as it is; a NULL struct gives NULL fields.
    """
    if col not in df.columns:
        return df
    prefix = col if prefix is None else prefix
    return df.withColumns(
        {f"{prefix}_{f}": F.col(col).getField(f) for f in fields}
    ).drop(col)


def to_json_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Nested columns -> JSON text (empty array ``[]``, empty struct ``{}``, NULL stays).
    A text column holds the JSON text of its source already and stays."""
    present = [
        c for c in cols if c in df.columns and not isinstance(df.schema[c].dataType, T.StringType)
    ]
    return df.withColumns({c: F.to_json(F.col(c)) for c in present})


def add_audit_columns(
    df: DataFrame, as_of: datetime, source: str | None = None,
    loaded_col: str = "loaded_at", source_col: str = "source",
) -> DataFrame:
    """``loaded_at`` = the run time given by the caller, ``source`` = a constant."""
    cols = {loaded_col: as_timestamp(as_of)}
    if source is not None:
        cols[source_col] = F.lit(source)
    return df.withColumns(cols)


def project_rename(df: DataFrame, mapping: Sequence[tuple[str, str]] | Mapping[str, str]) -> DataFrame:
    """Select and rename, nested paths included (``vitamins.a`` -> ``vitamin_a``)."""
    pairs = mapping.items() if isinstance(mapping, Mapping) else mapping

    def resolve(path):
        if isinstance(path, str) and "(" in path:
            return F.expr(path)
        return as_col(path)

    return df.select(*[resolve(path).alias(name) for path, name in pairs])


def conform(
    df: DataFrame,
    schema: T.StructType,
    defaults: Mapping[str, object] | None = None,
    allow_extra: bool = False,
) -> DataFrame:
    """Bring rows to a declared schema.

    Each declared column is cast to its type (a value that does not fit fails, as the
    INSERT would); an absent or NULL column takes the declared default, else NULL.
    Columns the schema does not declare raise (X21) unless ``allow_extra``.
    """
    defaults = dict(defaults or {})
    declared = {f.name for f in schema.fields}
    extra = [c for c in df.columns if c not in declared]
    if extra and not allow_extra:
        raise SchemaError(f"columns not declared by the target: {extra}")
    out = []
    for field in schema.fields:
        if field.name in df.columns:
            value = F.col(field.name).cast(field.dataType)
        else:
            value = F.lit(None).cast(field.dataType)
        if field.name in defaults:
            value = F.coalesce(value, F.lit(defaults[field.name]).cast(field.dataType))
        out.append(value.alias(field.name))
    return df.select(*out)


def sql_type(dtype: T.DataType) -> str:
    """The relational column type for a Spark type (T16, the mapping the reference meant
    to build, plus DATE, DECIMAL and BOOLEAN; LONG maps to BIGINT so it cannot overflow)."""
    if isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        return "VARCHAR(255)"
    if isinstance(dtype, (T.IntegerType, T.ShortType, T.ByteType)):
        return "INTEGER"
    if isinstance(dtype, T.LongType):
        return "BIGINT"
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return "FLOAT"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    if isinstance(dtype, T.DateType):
        return "DATE"
    if isinstance(dtype, T.DecimalType):
        return f"DECIMAL({dtype.precision},{dtype.scale})"
    if isinstance(dtype, T.BooleanType):
        return "BOOLEAN"
    return "TEXT"


def infer_target_schema(df: DataFrame) -> list[tuple[str, str]]:
    """(normalised column name, relational type) for each column of ``df``."""
    return [(normalize_name(f.name), sql_type(f.dataType)) for f in df.schema.fields]


def jdbc_column_types(df: DataFrame) -> str:
    """T16 for the JDBC sink: the ``createTableColumnTypes`` option value, so the table
    K5 creates has the mapped column types."""
    return ", ".join(f"{n} {t}" for n, t in infer_target_schema(df) if t != "TEXT")


def target_ddl(df: DataFrame, table: str) -> str:
    cols = ", ".join(f"{n} {t}" for n, t in infer_target_schema(df))
    return f"CREATE TABLE {table} ({cols})"


def add_missing_column(df: DataFrame, name: str, dtype, default=None) -> DataFrame:
    """Add a column with a default value only if it is absent."""
    if name in df.columns:
        return df
    return df.withColumn(name, F.lit(default).cast(dtype))


def as_timestamp(value: date | datetime | str) -> F.Column:
    """A TIMESTAMP_NTZ literal built from text, so no time zone (of the Python process
    or of the session) can shift the wall-clock value."""
    if isinstance(value, datetime):
        text = value.isoformat(sep=" ")
    elif isinstance(value, date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = str(value)
    return F.lit(text).cast(T.TimestampNTZType())


def literal_for(value, dtype: T.DataType) -> F.Column:
    """A literal of ``value`` for comparison with a column of ``dtype``."""
    if isinstance(dtype, T.TimestampNTZType) and isinstance(value, (datetime, date, str)):
        return as_timestamp(value)
    return F.lit(value)
