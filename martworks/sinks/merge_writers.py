"""Merges written in place: only the rows or partitions a merge changes are written.

The pure merge operators return the whole new table, which the staged swap
(:func:`martworks.sinks.writers.replace_table`) rewrites. For a large target and a daily
batch that rewrite is the dominant cost, and two of the merges never need it:

* insert-ignore (M3) never changes an existing row: appending the new keys is the
  whole merge;
* day reload (M4) only replaces the rows loaded on the ``as_of`` day: with the target
  partitioned by its load day, that is one partition, replaced by a dynamic partition
  overwrite. Older partitions stay as they are;
* upsert (M2) can change any stored row, but only rows whose key is in the batch: with
  the target partitioned by a hash bucket of the key, only the buckets the batch touches
  are read, merged and replaced.

Each batch is evaluated once, into a staged table under the shared checkpoint folder. Its
distinct keys are staged too; when they are few (rows and bytes of the written files) they
are broadcast, else AQE decides. The result is the same either way. M3 and M4 compare them
with the target's key table, of which only the batch's buckets are read, M2 with the
target's own buckets.

A rerun gives the same table for rows with a key: M3 finds its keys present, M4 replaces
the same partition with the same rows, M2 updates to the same values. Rows with a NULL
key never conflict, so a rerun of M2 or M3 appends them again.

Every writer returns the number of rows it wrote as ``{"inserted": n, "updated": m}``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import date, datetime
from functools import partial as partly

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.operators.merge import any_null, batch_keys, one_per_key, upsert
from martworks.session import work_path
from martworks.sinks.key_index import BUCKETS, KeyIndex
from martworks.sinks.writers import stored_table

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 16 << 20
NULL_BUCKET = -1
BUCKETS_FILE = "_key_buckets"


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


class Staging:
    """Tables written under the shared checkpoint folder, removed at the end of the block."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            fs, target = _fs(self.spark, path)
            fs.delete(target, True)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = work_path(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keys(self, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The distinct non-NULL keys of a batch; marked for broadcast only if the written
        table is small."""
        found = self.table(batch_keys(batch, keys), "batch-keys")
        fs, target = _fs(self.spark, self.paths[-1])
        size = fs.getContentSummary(target).getLength()
        if size <= BROADCAST_BYTES and found.count() <= BROADCAST_ROWS:
            return F.broadcast(found)
        return found


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def insert_ignore_into(
    spark: SparkSession,
    batch: DataFrame,
    target_path: str,
    keys: Sequence[str],
    order_by: Sequence | None = None,
    key_buckets: int = BUCKETS,
) -> dict[str, int]:
    """M3 written in place: append one row for each batch key that the target lacks.

    The target isn't read: what it holds is looked up in its key table
    (:class:`martworks.sinks.key_index.KeyIndex`), in the buckets of the batch's keys.
    Choose ``key_buckets`` so that one bucket's keys are some hundred megabytes.
    """
    with Staging(spark) as staging:
        staged = staging.table(batch, "insert-ignore")
        rows = one_per_key(staged, keys, order_by)
        existing = stored_table(spark, target_path)
        if existing is not None:
            index = KeyIndex(spark, target_path, keys, key_buckets)
            present = index.present(existing, staging.keys(staged, keys))
            rows = rows.select(*existing.columns).join(present, list(keys), "left_anti")
        rows, seen = _observed(rows)
        rows.write.mode("append").parquet(target_path)
        return {"inserted": seen.get.get("rows", 0), "updated": 0}


def reload_day_into(
    spark: SparkSession,
    batch: DataFrame,
    target_path: str,
    keys: Sequence[str],
    as_of: date | datetime,
    loaded_col: str = "loaded_at",
    load_date_col: str = "load_date",
    order_by: Sequence | None = None,
    unique_keys: bool = False,
    key_buckets: int = BUCKETS,
    audit: Callable[[], object] | None = None,
) -> dict[str, int]:
    """M4 written in place on a target partitioned by ``load_date_col``.

    Rows loaded before the ``as_of`` day win; the ``as_of`` partition is replaced by the
    batch rows whose key no earlier day holds, and goes away if there are none. Partitions
    of later days are dropped (the reference deletes every row with ``DATE(loaded_at) >=
    as_of``). An empty batch changes nothing. Rows with a NULL load time sit in the NULL
    partition, which is never replaced. The day is written before partitions are dropped,
    so a run that fails in between is finished by running it again. ``unique_keys``: the
    batch has one row per key already. Earlier days are not read: their keys are looked up
    in the target's key table, in the buckets of the batch's keys (``key_buckets`` in all).
    ``audit`` is called when the batch is staged and the target still untouched; it raises to
    stop the load.
    """
    day = as_of.date() if isinstance(as_of, datetime) else as_of
    with Staging(spark) as staging:
        staged = staging.table(batch, "reload-day")
        if audit is not None:
            audit()
        if staged.isEmpty():
            return {"inserted": 0, "updated": 0}
        rows = staged if unique_keys else one_per_key(staged, keys, order_by)
        rows = rows.withColumn(load_date_col, F.lit(day))
        existing = stored_table(spark, target_path)
        if existing is not None:
            index = KeyIndex(spark, target_path, keys, key_buckets)
            loaded_before = partly(_is_earlier, col=load_date_col, day=day)
            present = index.present(existing, staging.keys(staged, keys), loaded_before)
            rows = rows.select(*existing.columns).join(present, list(keys), "left_anti")
        rows, seen = _observed(rows)
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(load_date_col)
            .parquet(target_path)
        )
        written = seen.get.get("rows", 0)
        # a dynamic overwrite without rows replaces nothing: the stale day has to go as well
        drop_partitions_after(spark, target_path, load_date_col, day, and_day=written == 0)
        return {"inserted": written, "updated": 0}


def _is_earlier(name: str, col: str, day: date) -> bool:
    """Is the data file in a partition of ``col`` before ``day``, or in the NULL one?"""
    value = name.split(f"{col}=", 1)[1].split("/", 1)[0]
    try:
        return date.fromisoformat(value) < day
    except ValueError:  # the NULL partition (__HIVE_DEFAULT_PARTITION__)
        return True


def drop_partitions_after(
    spark: SparkSession, path: str, col: str, day: date, and_day: bool = False
) -> list[str]:
    """Delete the ``col=<date>`` partition folders of ``path`` later than ``day`` (and
    those of the day itself with ``and_day``).

    Works on the folder listing (one entry per partition), not on the data.
    """
    fs, _ = _fs(spark, path)
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{col}=*")
    dropped = []
    for status in fs.globStatus(pattern) or []:
        value = status.getPath().getName().split("=", 1)[1]
        try:
            part_day = date.fromisoformat(value)
        except ValueError:  # the NULL partition (__HIVE_DEFAULT_PARTITION__)
            continue
        if part_day > day or (and_day and part_day == day):
            fs.delete(status.getPath(), True)
            dropped.append(value)
    return dropped


def key_bucket(keys: Sequence[str], buckets: int):
    """Stable hash bucket of the key columns; rows with a NULL key, which no merge ever
    touches again, are in ``NULL_BUCKET``."""
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")
    return F.when(any_null(keys), F.lit(NULL_BUCKET)).otherwise(bucket)


class LayoutError(ValueError):
    """The stored table is not laid out the way the writer was asked to use it."""


def _check_buckets(
    spark: SparkSession, path: str, stored: DataFrame | None, keys, buckets: int, bucket_col: str
) -> None:
    """Compare ``buckets`` with the number the table was written with.

    The number lies beside the data (files with a leading underscore are no data). A table
    without it is checked once by a pass over its keys.
    """
    fs, _ = _fs(spark, path)
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{BUCKETS_FILE}")
    wanted = {"keys": list(keys), "buckets": buckets}
    if stored is not None and fs.exists(mark):
        with_mark = spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils
        stream = fs.open(mark)
        found = json.loads(bytes(with_mark.readFullyToByteArray(stream)).decode())
        stream.close()
        if found != wanted:
            raise LayoutError(f"{path} is stored with {found}, not {wanted}")
        return
    if stored is not None:
        if bucket_col not in stored.columns:
            raise LayoutError(f"{path} is not partitioned by {bucket_col}")
        other = stored.where(~any_null(keys) & (F.col(bucket_col) != key_bucket(keys, buckets)))
        if not other.select(bucket_col).isEmpty():
            raise LayoutError(f"{path} is not stored in {buckets} buckets of {list(keys)}")
    stream = fs.create(mark, True)
    stream.write(bytearray(json.dumps(wanted).encode()))
    stream.close()


def upsert_into(
    spark: SparkSession,
    batch: DataFrame,
    target_path: str,
    keys: Sequence[str],
    order_by: Sequence,
    update_cols: Sequence[str] | None = None,
    stamp: tuple[str, object] | None = None,
    buckets: int = 4096,
    bucket_col: str = "key_bucket",
    schema: T.StructType | None = None,
) -> dict[str, int]:
    """M2 written in place on a target partitioned by ``bucket_col`` = hash bucket of the
    keys: only the buckets holding a batch key are rewritten.

    The touched bucket ids (at most ``buckets`` integers) become a partition filter, so
    untouched buckets are neither read nor written. One job reads those buckets, merges
    and writes them with a dynamic partition overwrite: new files go to a staging folder
    and replace the old bucket folders only at job commit, after every task has read its
    input, so a lost executor just reruns its task. A rerun of a whole failed job merges
    the same batch again and gives the same rows. Rows with a NULL key are appended.
    Choose ``buckets`` so one bucket holds about a gigabyte; a table stored with another
    number raises. A first load creates ``schema``, by default the batch's columns and the
    stamp column.
    """
    with Staging(spark) as staging:
        staged = staging.table(batch, "upsert")
        existing = stored_table(spark, target_path)
        if existing is not None:
            _check_buckets(spark, target_path, existing, keys, buckets, bucket_col)
            empty = spark.createDataFrame([], existing.drop(bucket_col).schema)
        else:
            fields = list((schema or staged.schema).fields)
            if stamp and stamp[0] not in [f.name for f in fields]:
                fields.append(T.StructField(stamp[0], T.TimestampNTZType()))
            empty = spark.createDataFrame([], T.StructType(fields))
        keyed, loners = staged.where(~any_null(keys)), staged.where(any_null(keys))
        carried = staging.keys(keyed, keys)
        target, updated = empty, 0
        if existing is not None:
            touched = carried.select(key_bucket(keys, buckets).alias("b")).distinct().collect()
            target = existing.where(F.col(bucket_col).isin([r["b"] for r in touched])).drop(bucket_col)
            updated = target.select(*keys).join(carried, list(keys), "left_semi").count()
        merged = upsert(target, keyed, keys, order_by, update_cols, stamp, known_keys=carried)
        merged = merged.withColumn(bucket_col, key_bucket(keys, buckets))
        # rebalance: AQE cuts the rows of each bucket into files of the advisory size (a
        # few files per bucket, big buckets split) instead of one file per task and bucket
        (
            merged.hint("rebalance", bucket_col)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(bucket_col)
            .parquet(target_path)
        )
        if existing is None:
            _check_buckets(spark, target_path, None, keys, buckets, bucket_col)
        alone, seen = _observed(upsert(empty, loners, keys, order_by, update_cols, stamp))
        alone = alone.withColumn(bucket_col, F.lit(NULL_BUCKET))
        alone.write.mode("append").partitionBy(bucket_col).parquet(target_path)
        inserted = carried.count() - updated + seen.get.get("rows", 0)
        return {"inserted": inserted, "updated": updated}
