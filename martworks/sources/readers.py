"""Sources (S1-S6). Every reader takes an explicit schema by default: inference costs
an extra pass over the data and can change between runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.operators.topn import with_arrival_order


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    infer: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV with a header row; the schema is given, or inferred when ``infer``.

    A line that doesn't fit the schema in the columns that are read fails the job; to set
    such lines aside use :func:`martworks.sources.quarantine.read_csv_checked`.
    """
    reader = spark.read.option("header", "true").option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", "true")
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan (filters and column pruning reach the files)."""
    return spark.read.parquet(path)


def read_json_records(
    spark: SparkSession,
    path: str,
    field: str,
    element_schema: T.StructType,
    multi_line: bool = True,
    position_col: str | None = None,
) -> DataFrame:
    """S3: documents holding an array of records -> one row per element.

    ``multi_line=True`` reads files that each hold one JSON object (one task per file);
    ``False`` reads JSON lines where every line is such a document, which splits.
    A document without the array, or with an empty one, gives no rows; a malformed one
    fails the job. ``position_col`` adds the arrival order (file, element index) as a struct.
    """
    schema = T.StructType([T.StructField(field, T.ArrayType(element_schema))])
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    docs = reader.option("multiLine", str(multi_line).lower()).json(path)
    if position_col is None:
        return docs.select(F.inline(F.col(field)))
    exploded = docs.select(
        F.col("_metadata.file_path").alias("_file"), F.posexplode(F.col(field)).alias("_pos", "_rec")
    )
    return exploded.select(
        "_rec.*", F.struct(F.col("_file").alias("file"), F.col("_pos").alias("pos")).alias(position_col)
    )


def read_xml_records(
    spark: SparkSession,
    path: str,
    row_tag: str,
    schema: T.StructType,
    direct_children_only: bool = False,
    ignore_surrounding_spaces: bool = False,
    position_col: str | None = None,
) -> DataFrame:
    """One row per ``row_tag`` element; attributes are fields ``_name``, element text
    with attributes is ``_VALUE``; missing elements are NULL.

    Text keeps its surrounding spaces by default (X3). Declare elements that may repeat
    as arrays and take element 0 to get the first one (X2). ``rowTag`` also matches
    ``row_tag`` elements nested deeper; with ``direct_children_only`` every file is
    parsed whole and only children of the root element are kept (X1), one task per file.
    A malformed document fails the job. ``position_col`` adds the arrival order (file,
    position in it) as a struct, so that files come in the order of their names.
    """
    opts = {
        "ignoreSurroundingSpaces": str(ignore_surrounding_spaces).lower(),
        "mode": "FAILFAST",
    }
    if not direct_children_only:
        reader = spark.read.format("xml").option("rowTag", row_tag).schema(schema)
        for key, value in opts.items():
            reader = reader.option(key, value)
        rows = reader.load(path)
        return with_arrival_order(rows, position_col) if position_col else rows
    doc = T.StructType([T.StructField(row_tag, T.ArrayType(schema))])
    files = spark.read.text(path, wholetext=True)
    parsed = files.select(
        F.col("_metadata.file_path").alias("_file"), F.from_xml("value", doc, opts).alias("_doc")
    )
    rows = parsed.select("_file", F.posexplode(F.col(f"_doc.{row_tag}")).alias("_pos", "_rec"))
    if position_col is None:
        return rows.select("_rec.*")
    place = F.struct(F.col("_file").alias("file"), F.col("_pos").alias("pos"))
    return rows.select("_rec.*", place.alias(position_col))


def read_collection(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    drop: Sequence[str] = ("_id",),
    undeclared_col: str | None = None,
) -> DataFrame:
    """Full scan of an exported document collection (JSON lines) without ``_id``.

    Timestamp fields declared in the schema accept ISO text with up to microseconds; a
    field declared as text takes the document's own text for it, be it a number or nested.
    A malformed line fails the job. ``undeclared_col`` adds the names of the fields that a
    document has and the schema lacks (an array, NULL if there are none).
    """
    opts = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]", "mode": "FAILFAST"}
    if undeclared_col is None:
        df = spark.read.schema(schema).options(**opts).json(path)
    else:
        lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
        names = F.array(*[F.lit(f.name) for f in schema.fields])
        extra = F.array_except(F.json_object_keys("value"), names)
        lines = lines.select(
            F.from_json("value", schema, opts).alias("_doc"),
            F.when(F.size(extra) > 0, extra).alias(undeclared_col),
            F.col("_metadata"),
        )
        df = lines.select("_doc.*", undeclared_col)
    return df.drop(*[c for c in drop if c in df.columns])


def read_table(
    spark: SparkSession, name_or_jdbc: str, table: str | None = None, **jdbc_options
) -> DataFrame:
    """Scan a catalog table, or ``table`` at a JDBC URL (see :func:`read_jdbc`)."""
    if name_or_jdbc.startswith("jdbc:"):
        if not table:
            raise ValueError("a JDBC source needs the table name")
        return read_jdbc(spark, name_or_jdbc, table, **jdbc_options)
    return spark.table(name_or_jdbc)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """S6 over JDBC: with ``partition_column`` and bounds the read is split into
    ``num_partitions`` range queries that run in parallel."""
    props = dict(properties or {})
    props.setdefault("fetchsize", str(fetch_size))
    if partition_column:
        return spark.read.jdbc(
            url, table, column=partition_column, lowerBound=lower_bound,
            upperBound=upper_bound, numPartitions=num_partitions, properties=props,
        )
    return spark.read.jdbc(url, table, properties=props)
