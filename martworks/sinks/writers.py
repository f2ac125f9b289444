"""Sinks (K1-K5) and the table swap used by merges.

Files are written through Spark's commit protocol: a lost executor re-runs its task,
and only committed task output becomes visible.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()
) -> None:
    """K1: write (by default replace) a Parquet dataset."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K2: CSV with a header row, no index column."""
    df.write.mode(mode).option("header", "true").csv(path)


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``; None only if there is no such folder or it holds no
    data files. Any other analysis error is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_table(df: DataFrame, target: str, spark: SparkSession | None = None) -> None:
    """K3: append rows, columns matched by name.

    ``target`` is a catalog table name, or a Parquet path when it contains '/'.
    """
    spark = spark or df.sparkSession
    if "/" in target:
        existing = stored_table(spark, target)
        if existing is not None:
            df = df.select(*existing.columns)
        df.write.mode("append").parquet(target)
        return
    # saveAsTable in append mode resolves columns by name, unlike insertInto
    df.write.mode("append").saveAsTable(target)


def full_refresh(df: DataFrame, table: str, path: str | None = None) -> None:
    """K4: load a catalog table anew (optionally below an external path).

    A table that is there already is replaced in one metadata step (:func:`publish_table`):
    readers find the old rows or the new ones, never neither.
    """
    spark = df.sparkSession
    if path or spark.catalog.tableExists(table):
        publish_table(df, table, path)
    else:
        df.write.saveAsTable(table)


VERSION = "v-"


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def _versions_folder(spark: SparkSession, table: str, path: str | None, current: str | None) -> str:
    if path:
        return path.rstrip("/")
    parent, _, name = current.rpartition("/")
    return parent if name.startswith(VERSION) else f"{current}__versions"


def publish_table(df: DataFrame, table: str, path: str | None = None) -> str:
    """Write ``df`` in full to a fresh folder, then point ``table`` at it; the folder.

    The switch is one change of the table's location, after all rows are written: a reader
    before it sees the old version, one after it the new one, and a run that dies leaves the
    old table as it was. ``df`` may read the table. The version that was replaced stays for the
    readers it still has; versions before that, and folders of runs that died, are removed.
    One writer at a time. A table whose columns change is created anew, which is two metadata
    steps.
    """
    spark = df.sparkSession
    current = _location(spark, table) if spark.catalog.tableExists(table) else None
    if current is None and not path:
        raise ValueError("a new table needs the folder of its versions")
    base = _versions_folder(spark, table, path, current)
    fresh = f"{base}/{VERSION}{uuid.uuid4().hex[:12]}"
    df.write.parquet(fresh)
    columns = [(f.name, f.dataType) for f in df.schema.fields]
    same = current is not None and columns == [
        (f.name, f.dataType) for f in spark.table(table).schema.fields
    ]
    if same:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{fresh}'")
    else:
        if current is not None:
            spark.sql(f"DROP TABLE {table}")
        spark.catalog.createTable(table, fresh, "parquet", schema=df.schema)
    spark.catalog.refreshTable(table)
    _remove_old(spark, base, keep={fresh, current or fresh})
    return fresh


def _remove_old(spark: SparkSession, base: str, keep: set[str]) -> None:
    """Delete the versions below ``base`` that are neither current nor just replaced."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    kept = {fs.makeQualified(path(k)).toString() for k in keep}
    old = [status.getPath() for status in fs.globStatus(path(f"{base}/{VERSION}*")) or []]
    if base.endswith("__versions"):  # where the table stood before its first version
        first = path(base.removesuffix("__versions"))
        old += [first] if fs.exists(first) else []
    for folder in old:
        if fs.makeQualified(folder).toString() not in kept:
            fs.delete(folder, True)


def replace_table(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Replace ``table`` by ``df`` even when ``df`` reads ``table`` (merges): the new rows are
    written in full before the table is pointed at them (see :func:`publish_table`)."""
    full_refresh(df, table)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    properties: Mapping[str, str] | None = None,
    num_partitions: int | None = None,
    batch_size: int = 10_000,
) -> None:
    """K5: write into an external relational table, one connection per partition,
    ``batch_size`` rows per round trip (instead of one INSERT per row)."""
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    if num_partitions:
        props.setdefault("numPartitions", str(num_partitions))
    df.write.jdbc(url, table, mode=mode, properties=props)
