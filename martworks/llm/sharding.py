"""Shards in random order by a two-pass external shuffle.

First pass: every record gets a bucket by a seeded hash of the place where it is stored
(file and row), so identical records, hot ids and hot sources are dealt as evenly as any
others; the buckets are as many as keep one to ``bucket_bytes``, and their row counts give
each bucket its first position in the whole order. Second pass: one exchange brings bucket b
to partition b, the task puts its records in stored order, shuffles them (``shuffle``, Spark's
Fisher-Yates permutation, seeded by the seed and the bucket) and writes them at once. Buckets
in order make the whole order; shard s gets the positions p with p * shards div rows = s, so
row counts differ by one at most, a shard's files in name order are its slots in order, and a
bucket touches few shards. Nothing but DataFrame functions is used.

The same seed, files and bucket size give the same shards: what a task that runs again makes
is what it made before. Rows that do not come straight from Parquet files are staged
first (``stored=False``), which fixes their places.

Defined cases: null ids, null and empty texts and repeated rows are records like any other; a
record longer than ``bucket_bytes`` is moved whole; with fewer records than shards some shards
are empty; an empty table gives no rows; the table's columns are kept in the struct ``record``,
so that names like ``shard`` or ``slot`` do not clash.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martworks.llm.common import staged
from martworks.session import work_path

SHARDS = 24
SEED = 20260501
#: A bucket's bytes at least. A task holds it about four times: as rows, as an array, shuffled
#: and sorted to write; so a bucket may be a sixteenth of a core's share of memory.
BUCKET_BYTES = 32 << 20
MEMORY_SHARE = 16
#: Up to so many buckets their positions (16 bytes each) are broadcast.
BROADCAST_BUCKETS = 1 << 20
_RUN = 1024


def bucket_bytes_of(spark: SparkSession) -> int:
    """Bytes of a bucket on this cluster: larger executors take fewer, larger buckets."""
    conf = spark.sparkContext.getConf()
    size = re.fullmatch(r"(\d+)([kmgt]?)b?", conf.get("spark.executor.memory", "1g").lower())
    if not size or spark.sparkContext.master.startswith("local["):
        return BUCKET_BYTES
    memory = int(size[1]) << {"": 20, "k": 10, "m": 20, "g": 30, "t": 40}[size[2]]
    cores = max(1, int(conf.get("spark.executor.cores", "4")))
    return max(BUCKET_BYTES, memory // cores // MEMORY_SHARE)


def record_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: texts by their length, the rest 8 a column."""
    total = F.lit(0).cast("long")
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType | T.BinaryType):
            total += F.coalesce(F.octet_length(col), F.lit(0)) + 8
        elif isinstance(field.dataType, T.StructType | T.ArrayType | T.MapType):
            total += F.coalesce(F.octet_length(F.to_json(col)), F.lit(0)) + 8
        else:
            total += 8
    return total


def first_positions(counts: DataFrame) -> DataFrame:
    """(bucket, first): the rows of all buckets before each one, summed in two steps."""
    runs = counts.withColumn("run", F.floor(F.col("bucket") / _RUN))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.groupBy("run").agg(F.sum("rows").alias("rows"))
    starts = starts.select("run", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("run").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    inner = runs.withColumn("inner", F.coalesce(F.sum("rows").over(within), F.lit(0)))
    return inner.join(starts, "run").select("bucket", (F.col("start") + F.col("inner")).alias("first"))


def write_shards(
    table: DataFrame,
    path: str,
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Write the rows of ``table`` to ``path/shard=s`` in random order; (shard, slot, record).

    ``stored``: the table is read from Parquet files and its rows are as they stand there.
    """
    spark = table.sparkSession
    bucket_bytes = bucket_bytes_of(spark) if bucket_bytes is None else bucket_bytes
    if shards < 1 or bucket_bytes < 1:
        raise ValueError("shards and bucket_bytes must be at least 1")
    if not stored:
        table = staged(table, "sharding-rows")
    of = table.agg(F.count(F.lit(1)).alias("rows"), F.sum(record_bytes(table)).alias("bytes"))
    rows, size = of.first()
    buckets = max(1, -(-(size or 0) // bucket_bytes))

    place = table.metadataColumn("_metadata")
    record = F.struct(*[F.col(f"`{c}`") for c in table.columns])
    placed = table.select(
        place.file_name.alias("file"), place.row_index.alias("row"), record.alias("record")
    )
    bucket = F.pmod(F.xxhash64(F.lit(seed), "file", "row"), F.lit(buckets)).cast("int")
    dealt = placed.withColumn("bucket", bucket)
    first = first_positions(dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows")))
    if buckets <= BROADCAST_BUCKETS:
        first = F.broadcast(first)

    in_order = F.array_sort(
        F.collect_list(F.struct("file", "row", "record")),
        lambda a, b: F.when(a["file"] < b["file"], -1)
        .when(a["file"] > b["file"], 1)
        .when(a["row"] < b["row"], -1)
        .when(a["row"] > b["row"], 1)
        .otherwise(0),
    )
    gathered = dealt.repartitionById(buckets, "bucket").groupBy("bucket").agg(in_order.alias("all"))
    shuffled = gathered.withColumn("all", F.shuffle("all", seed)).join(first, "bucket")
    laid = shuffled.select("first", F.posexplode("all").alias("at", "one"))
    position = F.col("first") + F.col("at")
    # shard s begins at ceil(s * rows / shards)
    shard = F.expr(f"cast((first + at) * {shards}L div {max(rows, 1)}L as int)")
    begin = F.expr(f"(shard * {rows}L + {shards - 1}L) div {shards}L")
    out = laid.withColumn("shard", shard).select(
        "shard", (position - begin).alias("slot"), F.col("one.record").alias("record")
    )
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return read_shards(spark, path, table.schema)


def read_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(shard, slot, record) of written shards; ``schema``: of the records."""
    kinds = T.StructType().add("slot", T.LongType()).add("record", schema)
    kinds = kinds.add("shard", T.IntegerType())
    return spark.read.schema(kinds).parquet(path).select("shard", "slot", "record")


def shard_documents(docs: DataFrame, stored: bool = False) -> DataFrame:
    """Shard, slot and digests of each document, from the shard files as they were written."""
    path = work_path(docs.sparkSession, "shards")
    written = write_shards(docs, path, stored=stored)
    text = F.coalesce(F.col("record.text").cast("string"), F.lit(""))
    return written.select(
        F.col("record.doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
