"""M7: pick up newly arrived files exactly once and insert-ignore them by key.

A re-aim of the daily incremental load: Structured Streaming's file source keeps the
list of files it has processed in the checkpoint, so every file is read once, and
``trigger(availableNow=True)`` processes what has arrived and stops (a scheduled batch
run with streaming bookkeeping).

The target is a Parquet folder partitioned by run and micro-batch id. The run id is the
one the checkpoint carries: a restart continues its run, a new checkpoint starts another
one and never touches partitions of earlier runs. Each micro-batch

* reduces itself to one row per key (M1),
* drops keys the target already holds outside its own partition (M3), and
* overwrites only its own partition (dynamic partition overwrite).

A micro-batch that is replayed after a failure therefore rewrites exactly the rows it
wrote before; nothing is lost or doubled. The micro-batch is staged first; its keys are
looked up in the target's key table, of which only their buckets are read, or in the state
that the query keeps of the keys it has seen (``seen="state"``), without reading the target.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from martworks.operators.merge import any_null, one_per_key
from martworks.operators.transform import SchemaError
from martworks.sinks.key_index import BUCKETS, KeyIndex
from martworks.sinks.merge_writers import Staging
from martworks.sinks.writers import stored_table

RUN_COL, BATCH_COL = "_run_id", "_batch_id"


def read_target(spark: SparkSession, target_path: str, schema: T.StructType) -> DataFrame:
    """The loaded rows, without the partition columns."""
    stored = stored_table(spark, target_path)
    if stored is None:
        return spark.createDataFrame([], schema)
    return stored.drop(RUN_COL, BATCH_COL)


def checkpoint_run(spark: SparkSession, checkpoint: str) -> str:
    """The id that the checkpoint gave its query; it stays the same over restarts."""
    line = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(line)["id"]


def batch_merger(
    spark: SparkSession,
    target_path: str,
    keys: Sequence[str],
    cols: Sequence[str],
    order_by: Sequence[str] | None = None,
    run_id: str | Callable[[], str] = "manual",
    key_buckets: int = BUCKETS,
    own_run_is_new: bool = False,
):
    """The ``foreachBatch`` function: insert-ignore one micro-batch into its own partition.

    ``own_run_is_new``: the keys of the run's earlier micro-batches have been left out already.

    Calling it again with the same run and ``batch_id`` (a replay after a failure) rewrites
    the same partition with the same rows. A target without the two partition columns was
    written by something else and raises.
    """

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        run = run_id if isinstance(run_id, str) else run_id()
        with Staging(spark) as staging:
            staged = staging.table(batch, "micro-batch")
            fresh = one_per_key(staged, keys, order_by)
            stored = stored_table(spark, target_path)
            if stored is not None:
                if not {RUN_COL, BATCH_COL} <= set(stored.columns):
                    raise SchemaError(f"{target_path} is not partitioned by {RUN_COL}, {BATCH_COL}")
                own = f"{RUN_COL}={run}/" + ("" if own_run_is_new else f"{BATCH_COL}={batch_id}/")
                index = KeyIndex(spark, target_path, keys, key_buckets)
                others = [n for n in index.stored_files(stored) if not n.startswith(own)]
                if others:
                    present = index.present(
                        stored, staging.keys(staged, keys), lambda name: not name.startswith(own)
                    )
                    fresh = fresh.join(present, on=list(keys), how="left_anti")
            (
                fresh.select(*cols)
                .withColumns({RUN_COL: F.lit(run), BATCH_COL: F.lit(batch_id).cast("long")})
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(RUN_COL, BATCH_COL)
                .parquet(target_path)
            )

    return merge_batch


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # a micro-batch uploads what changed, not the whole store
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings while a query starts; the query keeps its own copy."""
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _first_of_new(
    key: tuple, parts: Iterator[pd.DataFrame], state: GroupState, order_by: Sequence[str]
) -> Iterator[pd.DataFrame]:
    """The first row of a key that no earlier micro-batch had."""
    if state.exists:
        return
    state.update((True,))
    best = None
    for part in parts:
        part = part if best is None else pd.concat([best, part])
        # NULL comes first, as in the batch form
        best = part.sort_values(list(order_by), kind="stable", na_position="first").head(1)
    if best is not None:
        yield best


def new_keys(source: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None) -> DataFrame:
    """The rows of a stream whose key no earlier row had; rows with a NULL key pass.

    The keys seen are the state of a stateful operator, partitioned by key and restored from
    the checkpoint. Without ``order_by`` any row of a new key may be the first: a built-in
    operator. With it the rows that a micro-batch brings for a new key are compared.
    """
    keyed, loners = source.where(~any_null(keys)), source.where(any_null(keys))
    if not order_by:
        return keyed.dropDuplicates(list(keys)).unionByName(loners)
    pick = functools.partial(_first_of_new, order_by=tuple(order_by))
    first = keyed.groupBy(*keys).applyInPandasWithState(
        pick, source.schema, "seen boolean", "append", "NoTimeout"
    )
    return first.unionByName(loners)


def stream_load(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    target_path: str,
    keys: Sequence[str],
    checkpoint: str,
    order_by: Sequence[str] | None = None,
    path_glob: str | None = None,
    source_format: str = "parquet",
    max_files_per_trigger: int | None = None,
    recursive: bool = False,
    key_buckets: int = BUCKETS,
    seen: str = "index",
) -> StreamingQuery:
    """Start the load; it stops by itself once the files present at start are done.

    ``seen``: where the keys loaded so far are looked up. ``index``: in the target's key table.
    ``state``: in the state store (RocksDB) of the query, for loads whose micro-batches follow
    each other closely; then only the keys of other runs, if there are any, are looked up in
    the key table.
    """
    if seen not in ("index", "state"):
        raise ValueError("seen must be 'index' or 'state'")
    reader = spark.readStream.schema(schema).format(source_format)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    source = reader.load(source_dir)
    if seen == "state":
        source = new_keys(source, keys, order_by)
    merge_batch = batch_merger(
        spark, target_path, keys, [f.name for f in schema.fields], order_by,
        run_id=lambda: checkpoint_run(spark, checkpoint), key_buckets=key_buckets,
        own_run_is_new=seen == "state",
    )
    writer = source.writeStream.foreachBatch(merge_batch)
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    with _settings(spark, _STATE_CONF if seen == "state" else {}):
        return writer.start()


def run_stream_load(*args, **kwargs) -> None:
    """:func:`stream_load` and wait until it has processed everything available."""
    query = stream_load(*args, **kwargs)
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
