"""A key table beside a stored table, for merges that must know which keys it holds.

Insert-ignore and day reload need the stored keys and nothing else. Reading the key column of
the whole target for each batch grows with the target; here the keys stand in their own
Parquet table below the target's folder (``_keys/...``, which no reader of the target sees),
partitioned by a hash bucket of the key. A batch's buckets become a partition filter, so a
small batch reads a few buckets and never the target.

An entry is (key, data file). It counts only while that file is part of the target, and a
data file without entries is entered before the first look-up. So the key table needs no
transaction with the target: rows that another writer appended, partitions that were dropped or
overwritten, and runs that died between the two writes are all seen as they are. What is
listed is file names, never rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.operators.merge import any_null
from martworks.sinks.writers import stored_table

FILE, BUCKET = "_file", "_bucket"
BUCKETS = 256
#: Files of a bucket folder from which on it is written anew as few.
COMPACT_FROM = 24
#: What stands before the path in a file's address.
_ORIGIN = r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?"
_LISTED = T.StructType([T.StructField(FILE, T.StringType())])


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _place(address: str) -> str:
    return re.sub(_ORIGIN, "", address)


class KeyIndex:
    """The stored keys of the Parquet table at ``target_path``."""

    def __init__(
        self, spark: SparkSession, target_path: str, keys: Sequence[str], buckets: int = BUCKETS
    ):
        self.spark, self.keys, self.buckets = spark, list(keys), buckets
        self.target_path = target_path.rstrip("/")
        # another key or number of buckets is another table
        self.path = f"{self.target_path}/_keys/{'-'.join(self.keys)}-{buckets}"
        self.entries_path, self.files_path = f"{self.path}/entries", f"{self.path}/files"

    # -- files -----------------------------------------------------------------------------

    def stored_files(self, target: DataFrame) -> dict[str, str]:
        """Name below the target's folder -> path of each of its data files."""
        root = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.target_path)
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        base = _place(fs.makeQualified(root).toString()).rstrip("/") + "/"
        return {_place(unquote(p)).removeprefix(base): p for p in target.inputFiles()}

    def _table(self, path: str) -> DataFrame | None:
        fs, where = _fs(self.spark, path)
        return stored_table(self.spark, path) if fs.exists(where) else None

    def refresh(self, target: DataFrame) -> dict[str, str]:
        """Enter the files that have no entries yet; the target's files by name."""
        files = self.stored_files(target)
        entered = self._table(self.files_path)
        known = set()
        if entered is not None:
            known = {r[FILE] for r in entered.distinct().collect()}
        new = sorted(set(files) - known)
        if new:
            self._enter(target, {name: files[name] for name in new}, whole=not known)
        return files

    def _enter(self, target: DataFrame, new: dict[str, str], whole: bool) -> None:
        """Keys of the new files: no other file is read, and no other column."""
        rows = target
        if not whole:
            reader = self.spark.read.schema(target.schema).option("basePath", self.target_path)
            rows = reader.parquet(*[unquote(path) for path in new.values()])
        place = F.regexp_replace("_metadata.file_path", _ORIGIN, "")
        rows = rows.where(~any_null(self.keys)).select(*self.keys, place.alias("_place"))
        named = self.spark.createDataFrame(
            [(_place(path), name) for name, path in new.items()],
            T.StructType([T.StructField("_place", T.StringType()), *_LISTED.fields]),
        )
        rows = rows.join(F.broadcast(named), "_place").select(*self.keys, FILE)
        rows = rows.withColumn(BUCKET, self._bucket())
        entries = rows.hint("rebalance", BUCKET).write.mode("append").partitionBy(BUCKET)
        entries.parquet(self.entries_path)
        # after the entries: a file whose entries are not complete is entered again
        listed = self.spark.createDataFrame([(name,) for name in new], _LISTED)
        listed.coalesce(1).write.mode("append").parquet(self.files_path)

    def _bucket(self):
        hashed = F.xxhash64(*[F.col(k) for k in self.keys])
        return F.pmod(hashed, F.lit(self.buckets)).cast("int")

    # -- look-up ---------------------------------------------------------------------------

    def touched(self, carried: DataFrame) -> list[int]:
        """The buckets of a batch's keys: at most ``buckets`` numbers."""
        found = carried.select(self._bucket().alias(BUCKET)).distinct()
        return sorted(r[BUCKET] for r in found.collect())

    def present(
        self, target: DataFrame, carried: DataFrame, counts: Callable[[str], bool] | None = None
    ) -> DataFrame:
        """Those of the batch's distinct keys ``carried`` that the target holds.

        ``counts`` says of a data file's name whether its rows count.
        """
        files = self.refresh(target)
        self._compact(files)
        entries = self._table(self.entries_path)
        live = [(name,) for name in sorted(files) if counts is None or counts(name)]
        if entries is None or not live:
            return carried.limit(0)
        near = entries.where(F.col(BUCKET).isin(self.touched(carried)))
        held = near.join(carried, self.keys, "left_semi")
        named = F.broadcast(self.spark.createDataFrame(live, _LISTED))
        return held.join(named, FILE, "left_semi").select(*self.keys).distinct()

    # -- upkeep ----------------------------------------------------------------------------

    def compact(self, target: DataFrame, least: int = COMPACT_FROM) -> list[int]:
        """Write the buckets of ``least`` files or more anew; the buckets written."""
        return self._compact(self.refresh(target), least)

    def _compact(self, files: dict[str, str], least: int = COMPACT_FROM) -> list[int]:
        """Entries of files that are gone are left out. Only bucket folders that are complete
        take the place of old ones, so a run that fails is simply made again."""
        fs, _ = _fs(self.spark, self.entries_path)
        pattern = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(
            f"{self.entries_path}/{BUCKET}=*/part-*"
        )
        held: Counter[int] = Counter(
            int(status.getPath().getParent().getName().split("=", 1)[1])
            for status in fs.globStatus(pattern) or []
        )
        full = sorted(bucket for bucket, n in held.items() if n >= least)
        if full:
            named = self.spark.createDataFrame([(name,) for name in sorted(files)], _LISTED)
            stored = self._table(self.entries_path).where(F.col(BUCKET).isin(full))
            (
                stored.join(F.broadcast(named), FILE, "left_semi")
                .distinct()
                .hint("rebalance", BUCKET)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(BUCKET)
                .parquet(self.entries_path)
            )
        return full
