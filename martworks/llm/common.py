"""Helpers shared by the operators: table access, staged tables, row marks, Arrow text."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.session import work_path

CHUNK_BYTES = 1 << 19


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Files of a staged table for each core of the cluster, at most.
FILES_PER_CORE = 8


def staged(
    df: DataFrame, name: str, tasks: int | None = None, path: str | None = None
) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder (or to ``path``) and read it back.

    Cuts the lineage: a lost executor costs the tasks that run, not the steps before. It is
    written by at most ``tasks`` tasks, by default ``FILES_PER_CORE`` for each core: a table
    that comes out of a shuffle with many more partitions would be that many small files.
    ``tasks=0`` leaves the partitions and their order as they are.
    """
    spark = df.sparkSession
    path = path or work_path(spark, name)
    if tasks is None:
        tasks = FILES_PER_CORE * spark.sparkContext.defaultParallelism
    (df.coalesce(tasks) if tasks else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _give_back() -> None:
    """Hand memory that is free in this process back to the system: the worker waits for its
    next task beside others, and what it holds is theirs to use."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def frugal(work: Callable) -> Callable:
    """A function for ``mapInArrow`` that leaves no free memory behind at the end of a task."""

    @functools.wraps(work)
    def run(batches, *args, **kwargs):
        try:
            yield from work(batches, *args, **kwargs)
        finally:
            _give_back()

    return run


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def text_of(df: DataFrame) -> Column:
    """The text column, null read as empty."""
    return F.coalesce(df["text"].cast("string"), F.lit("")).alias("text")


def utf8_batch(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets (n + 1), without copying rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


@frugal
def _fit(batches, fit: Callable):
    rows = [tuple(r.values()) for batch in batches for r in batch.to_pylist()]
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(rows))], pa.binary())], ["model"])


def fitted(sample: DataFrame, fit: Callable[[list[tuple]], object]) -> object:
    """What ``fit`` makes of the rows of a bounded sample, worked out in one task.

    Only the model comes to the driver; without a task (no rows) it is fitted to nothing.
    """
    made = sample.coalesce(1).mapInArrow(functools.partial(_fit, fit=fit), "model binary")
    rows = made.collect()
    return pickle.loads(rows[0]["model"]) if rows else fit([])


def labelled_sample(
    docs: DataFrame, marked: DataFrame, label: str, per_label: int, most_chars: int
) -> DataFrame:
    """(text, label): ``per_label`` texts of each label 0 and 1 at most, drawn by id.

    ``marked`` has one label for each doc_id. Only texts of up to ``most_chars`` characters can
    be drawn, one of each id; what is too long or missing is left out before the draw, so it
    costs no place in it.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs))
    rows = rows.where(F.length("text") <= most_chars).withColumn("mark", F.xxhash64("text"))
    able = rows.groupBy("doc_id").agg(F.min("mark").alias("mark")).join(marked, "doc_id")
    by_id = [F.xxhash64("doc_id"), F.col("doc_id")]
    drawn = [able.where(F.col(label) == k).orderBy(*by_id).limit(per_label) for k in (0, 1)]
    # three numbers for each row, per_label rows of each label: bounded
    rows = rows.join(F.broadcast(drawn[0].union(drawn[1])), ["doc_id", "mark"])
    rows = rows.groupBy("doc_id", label).agg(F.min("text").alias("text"))
    return rows.orderBy(*by_id).limit(2 * per_label).select("text", label)


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 2048) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, so that what is made of one is small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; a longer row is a range of its own."""
    n, at = len(offsets) - 1, 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(n, max(at + 1, to))
        yield at, to
        at = to
