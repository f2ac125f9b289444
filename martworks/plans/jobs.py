"""End-to-end jobs (P1-P7): compositions of the operators, from raw files to tables.

Transform steps return lazy DataFrames; only the explicit sink calls write. Clock values
(``as_of``) are arguments, so a rerun with the same inputs gives the same tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from martworks import schemas
from martworks.functions import columns as fcols
from martworks.operators import merge, quality, topn, transform
from martworks.operators.trim import quantile_trim
from martworks.plans import marts
from martworks.sinks import merge_writers, writers
from martworks.sources import footers, readers
from martworks.sources.inference import read_csv_inferred
from martworks.sources.quarantine import Checked, read_csv_checked
from martworks.sources.splitting import read_large_json, read_large_xml

ARRIVAL = "_arrival"
UNDECLARED = "_undeclared"


# ---------------------------------------------------------------- P1 sensor readings

def sensor_clean(readings: DataFrame, lo: float = 0.05, hi: float = 0.95) -> DataFrame:
    """T2 ('out/in' = 'In') -> T3 (dd-MM-yyyy HH:mm -> DATE) -> A7 on ``temp``."""
    inside = transform.filter_equals(readings, "out/in", "In")
    dated = transform.parse_date(inside, "noted_date")
    return quantile_trim(dated, "temp", lo, hi)


def sensor_extremes(readings: DataFrame, n: int = 5, order_col: str = ARRIVAL) -> DataFrame:
    """L2: the n hottest rows, then the n coldest; ties keep arrival order."""
    return topn.extremes(readings, n, "temp", tie_order=[order_col])


def sensor_readings(spark: SparkSession, csv_path: str, rejects_path: str | None = None) -> Checked:
    """S1 for P1: readings that don't parse, and indoor ones without a readable date, are
    rejected; without ``rejects_path`` they fail the job."""
    dated = F.try_to_timestamp("noted_date", F.lit(transform.SENSOR_DATE_PATTERN)).isNotNull()
    readable = F.col("noted_date").isNull() | (F.col("out/in") != F.lit("In")) | dated
    return read_csv_checked(
        spark, csv_path, schemas.SENSOR_CSV, rejects_path, {"noted_date": readable}, ARRIVAL
    )


def sensor_job(
    spark: SparkSession, csv_path: str, out_dir: str | None = None, rejects_path: str | None = None
):
    """S1 -> {L2 -> K2} and {T2 -> T3 -> A7 -> K2}. Returns (extremes, clean)."""
    raw = sensor_readings(spark, csv_path, rejects_path).good
    cols = [c for c in raw.columns if c != ARRIVAL]
    extremes = sensor_extremes(raw).orderBy(F.col("extreme_side").desc(), "extreme_rank")
    clean = sensor_clean(raw).select(*cols)
    if out_dir:
        writers.write_csv(extremes.select(*cols).coalesce(1), f"{out_dir}/extreme_temps")
        writers.write_csv(clean, f"{out_dir}/cleaned_data")
    return extremes.select(*cols, "extreme_side", "extreme_rank"), clean


# ---------------------------------------------------------------- P2 one-time load

def one_time_load(
    spark: SparkSession, csv_path: str, parquet_path: str, table: str, table_path: str | None = None,
    jdbc_url: str | None = None, jdbc_properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """S1 (inferred, one parse) -> K1 -> S2 -> T1 -> T16 -> K4 -> V4. Returns the profile.

    With ``jdbc_url`` the table is (re)created in that database instead (K5 in overwrite
    mode, column types from T16), and the profile reads it back over JDBC.
    """
    writers.write_parquet(read_csv_inferred(spark, csv_path), parquet_path)
    df = transform.normalize_columns(readers.read_parquet(spark, parquet_path))
    if jdbc_url:
        props = dict(jdbc_properties or {})
        props["createTableColumnTypes"] = transform.jdbc_column_types(df)
        writers.write_jdbc(df, jdbc_url, table, mode="overwrite", properties=props)
        return quality.table_profile(readers.read_jdbc(spark, jdbc_url, table, jdbc_properties))
    writers.full_refresh(df, table, path=table_path)
    return quality.table_profile(readers.read_table(spark, table))


# ---------------------------------------------------------------- P3 incremental load

def incremental_job(
    spark: SparkSession,
    source: DataFrame,
    table: str,
    date_col: str,
    default,
    as_of: date,
) -> DataFrame:
    """T17 -> M5 -> M6 -> K3 -> V3. Appends only the new rows; returns the report.

    A table without the date column gets it, with ``as_of`` as the value of its old rows.
    Watermark and report come from the files' statistics where the table's files have them.
    """
    target = None
    if spark.catalog.tableExists(table):
        if date_col not in spark.table(table).columns:
            # the default is kept in the table's schema and read for the rows already there
            spark.sql(
                f"ALTER TABLE {table} ADD COLUMNS ({date_col} DATE DEFAULT DATE'{as_of.isoformat()}')"
            )
            spark.catalog.refreshTable(table)
        target = spark.table(table)
    files = footers.table_files(spark, table, date_col) if target is not None else None
    if files:
        watermark = footers.stored_watermark(spark, files, date_col, default)
    else:
        watermark = merge.high_watermark(target, date_col, default)
    new = merge.new_rows_since(source, date_col, watermark)
    if target is not None:
        new = merge.only_declared(new, target.columns)
    # the number of appended rows is observed on the write itself: no second pass
    seen = Observation("appended")
    writers.append_table(new.observe(seen, F.count(F.lit(1)).alias("rows")), table, spark)
    added = seen.get.get("rows", 0)
    files = footers.table_files(spark, table, date_col)
    if files:
        return footers.stored_report(spark, files, date_col, added)
    report = quality.load_report(spark.table(table), date_col)
    return report.withColumn("new_rows", F.lit(added).cast("bigint"))


# ---------------------------------------------------------------- P4 JSON documents

def pets_batch(records: DataFrame) -> DataFrame:
    """T10 + T14: favFoods joined with ', ', columns renamed to the table's names."""
    return records.select(
        F.col("name"),
        F.col("species"),
        fcols.join_array("favFoods").alias("favfoods"),
        F.col("birthYear").alias("birthyear"),
        F.col("photo"),
        F.col(ARRIVAL),
    )


def json_job(
    spark: SparkSession, path: str, target: DataFrame | None, as_of: datetime, table: str | None = None,
    multi_line: bool = True, large: bool = False,
) -> DataFrame:
    """S3 -> V5 -> T10 -> T14 -> M2 (keys name, species, birthyear; last wins).

    Returns the new table; with ``table`` it is also written by the swap. JSON lines, one
    document a line (``multi_line=False``), split between documents; ``large`` documents, one
    in a file, are split between their records.
    """
    if large:
        records = read_large_json(spark, path, "pets", schemas.PET, position_col=ARRIVAL)
    else:
        records = readers.read_json_records(
            spark, path, "pets", schemas.PET, multi_line=multi_line, position_col=ARRIVAL
        )
    batch = pets_batch(quality.require_records(records, "pets document"))
    if target is None:
        # known to be empty when the plan is made: nothing of the batch is looked up in it
        target = spark.createDataFrame([], schemas.PETS_TABLE).limit(0)
    out = merge.upsert(
        target, batch, list(schemas.PETS_KEYS), order_by=[ARRIVAL],
        update_cols=["favfoods", "photo"], stamp=("loaded_at", as_of),
    )
    if table:
        writers.replace_table(spark, out, table)
        return spark.table(table)
    return out


# ---------------------------------------------------------------- P5 XML documents

def nutrition_batch(foods: DataFrame) -> DataFrame:
    """T14 -> T6 -> T7: project the 17 columns, parse numbers, fix decimals."""
    flat = transform.project_rename(foods, list(schemas.FOOD_COLUMNS) + [(ARRIVAL, ARRIVAL)])
    conv = {c: fcols.to_decimal(fcols.to_float(c), 10, 2) for c in schemas.FOOD_DECIMALS}
    conv.update({c: fcols.to_int(c) for c in schemas.FOOD_INTS})
    return flat.withColumns(conv)


def xml_job(
    spark: SparkSession, path: str, as_of: datetime, table: str | None = None,
    direct_children_only: bool = True, large: bool = False,
) -> DataFrame:
    """P5: S4 -> V5 -> T14 -> T6 -> T7 -> V6 -> M2 into an empty table -> K4.

    ``large`` files are split between their records, others are one task each.
    """
    if large:
        foods = read_large_xml(spark, path, "food", schemas.FOOD, position_col=ARRIVAL)
    else:
        foods = readers.read_xml_records(
            spark, path, "food", schemas.FOOD, direct_children_only=direct_children_only,
            position_col=ARRIVAL,
        )
    batch = nutrition_batch(quality.require_records(foods, "nutrition document"))
    quality.require_not_null(batch, ["name"], "nutrition_data")
    empty = spark.createDataFrame([], schemas.NUTRITION_TABLE).limit(0)
    out = merge.upsert(
        empty, batch, list(schemas.NUTRITION_KEYS), order_by=[ARRIVAL], stamp=("loaded_at", as_of)
    )
    if table:
        writers.full_refresh(out, table)
    return out


# ---------------------------------------------------------------- P6 collection replication

def _views(df: DataFrame) -> DataFrame:
    df = transform.coerce_timestamp(df, ["start_time", "end_time"])
    df = transform.coerce_numeric(df, ["watch_duration_minutes"], "int")
    df = transform.flatten_struct(df, "device", ["type", "os"])
    return transform.to_json_columns(df, ["interactions"])


def _payments(df: DataFrame) -> DataFrame:
    df = transform.coerce_timestamp(df, ["payment_date", "next_billing_date"])
    df = transform.coerce_numeric(df, ["amount"], "double")
    return df.withColumn(
        "payment_method_category",
        fcols.map_values("payment_method", schemas.PAYMENT_METHOD_CATEGORY, schemas.PAYMENT_METHOD_DEFAULT),
    )


def _ratings(df: DataFrame) -> DataFrame:
    df = transform.coerce_timestamp(df, ["created_at"])
    return transform.coerce_numeric(df, ["rating", "helpful_count", "reports_count"], "int")


def _searches(df: DataFrame) -> DataFrame:
    df = transform.coerce_timestamp(df, ["timestamp"])
    df = transform.coerce_numeric(df, ["results_count"], "int")
    df = df.withColumn("query_length", fcols.text_length("query"))
    return transform.to_json_columns(df, ["filters_applied"])


_TRANSFORMS = {
    "movie_views": _views,
    "user_payments": _payments,
    "content_ratings": _ratings,
    "search_queries": _searches,
}


def replicate_batch(name: str, raw: DataFrame, as_of: datetime, source: str = "mongodb",
                    order_col: str = ARRIVAL) -> DataFrame:
    """One collection: M1 -> T4/T5 -> T8/T9/T11/T12 -> T13 -> T15 -> V6 on the key."""
    key = schemas.TARGET_KEYS[name]
    raw = raw.drop("_id", UNDECLARED)
    deduped = merge.dedupe_first(raw, [key], [order_col]).drop(order_col)
    shaped = transform.add_audit_columns(_TRANSFORMS[name](deduped), as_of, source)
    return transform.conform(shaped, schemas.TARGET_TABLES[name], schemas.TARGET_DEFAULTS.get(name))


def replicate_collections(
    raw: Mapping[str, DataFrame],
    targets: Mapping[str, DataFrame],
    as_of: datetime,
    check_keys: bool = True,
) -> dict[str, DataFrame]:
    """For each collection the batch (``replicate_batch``) is loaded with M4.

    ``raw`` frames carry an arrival-order column ``_arrival``. Returns the new target
    tables; write them with :func:`martworks.sinks.writers.replace_table`.
    """
    out = {}
    for name, df in raw.items():
        key = schemas.TARGET_KEYS[name]
        rows = _gate(name, df, check_keys)
        batch = replicate_batch(name, df, as_of)
        out[name] = merge.reload_day(targets[name], batch, [key], as_of, batch_is_empty=rows == 0)
    return out


def _gate_counts(name: str, raw: DataFrame) -> list:
    """What the gates of a collection need to know of its raw rows: NULL ids (X20), undeclared
    fields (X21), the number of rows (X13). Deduplication keeps every NULL-id row, so the raw
    counts hold."""
    key = schemas.TARGET_KEYS[name]
    undeclared = F.lit(None).cast("string")
    if UNDECLARED in raw.columns:
        undeclared = F.max(F.array_join(UNDECLARED, ", "))
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
        undeclared.alias("undeclared"),
    ]


def _require(name: str, counts: Mapping, check_keys: bool = True) -> int:
    """Raise on NULL ids and undeclared fields; the number of rows."""
    if check_keys and counts.get("null_keys"):
        raise quality.DataQualityError(
            f"NULL in NOT NULL column {schemas.TARGET_KEYS[name]} of {name}"
        )
    if counts.get("undeclared"):
        raise transform.SchemaError(f"fields of {name} not declared: {counts['undeclared']}")
    return counts.get("rows", 0)


def _gate(name: str, raw: DataFrame, check_keys: bool = True) -> int:
    """The gates as one narrow pass over the raw rows, for batches that stay lazy."""
    return _require(name, raw.agg(*_gate_counts(name, raw)).first().asDict(), check_keys)


def replicate_collections_into(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    target_paths: Mapping[str, str],
    as_of: datetime,
) -> dict[str, dict[str, int]]:
    """P6 written in place: each table is a Parquet folder partitioned by ``load_date``;
    a run replaces only the ``as_of`` day (M4 via dynamic partition overwrite). Returns the
    rows written for each collection (X14). The gates are audited on the staged batch: a
    collection that fails one leaves its table as it was.

    The collections are independent, so their loads are submitted from a small thread
    pool and run as concurrent Spark jobs; a failure in any of them is raised.
    """

    def load_one(name: str) -> dict[str, int]:
        # write, audit, publish: the export is parsed once, into the staged batch, the gates
        # look at what was counted on the way, and only then the target is touched
        counts = Observation()
        rows = raw[name].observe(counts, *_gate_counts(name, raw[name]))
        batch = replicate_batch(name, rows, as_of)
        key = schemas.TARGET_KEYS[name]
        return merge_writers.reload_day_into(
            spark, batch, target_paths[name], [key], as_of, unique_keys=True,
            audit=lambda: _require(name, counts.get),
        )

    with ThreadPoolExecutor(max_workers=max(1, min(4, len(raw)))) as pool:
        futures = {name: pool.submit(load_one, name) for name in raw}
        return {name: future.result() for name, future in futures.items()}


def read_collections(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """S5 for the four exported collections, each with an arrival-order column."""
    return {
        name: topn.with_arrival_order(
            readers.read_collection(
                spark, path, schemas.RAW_COLLECTIONS[name], drop=(), undeclared_col=UNDECLARED
            ),
            ARRIVAL,
        )
        for name, path in paths.items()
    }


# ---------------------------------------------------------------- P7 marts

MARTS = {
    "mart_user_activity": ("movie_views",),
    "mart_content_performance": ("movie_views", "content_ratings", "search_queries"),
    "mart_payment_analysis": ("user_payments",),
}
_BUILD = {
    "mart_user_activity": marts.mart_user_activity,
    "mart_content_performance": marts.mart_content_performance,
    "mart_payment_analysis": marts.mart_payment_analysis,
}
_SUMMARIES = {
    "genre_summary": ("mart_content_performance", marts.mart_genre_summary),
    "favourite_genre_summary": ("mart_user_activity", marts.mart_favourite_genre_summary),
    "plan_summary": ("mart_payment_analysis", marts.mart_plan_summary),
}


def build_marts(
    tables: Mapping[str, DataFrame],
    out_dir: str,
    names: Sequence[str] = tuple(MARTS),
    publish: str | None = None,
) -> dict[str, DataFrame]:
    """For each mart V2 on its sources, E1-E3, K1 to ``out_dir``; R1-R3 read what was
    written, R4 the payments. Returns the written marts and the summaries.

    With ``publish`` (a prefix such as ``marts.``) each mart is a catalog table, replaced in one
    metadata step when its rows are written; without it a plain folder that is overwritten.
    """
    out = {}
    for name in names:
        quality.require_nonempty({k: tables[k] for k in MARTS[name]})
        path = f"{out_dir.rstrip('/')}/{name}"
        spark = tables[MARTS[name][0]].sparkSession
        mart = _BUILD[name](*[tables[k] for k in MARTS[name]])
        if publish is None:
            writers.write_parquet(mart, path)
            out[name] = readers.read_parquet(spark, path)
        else:
            writers.publish_table(mart, f"{publish}{name}", path)
            out[name] = spark.table(f"{publish}{name}")
    for name, (mart, summary) in _SUMMARIES.items():
        if mart in out:
            out[name] = summary(out[mart])
    if "mart_payment_analysis" in names:
        out["distinct_users"] = marts.distinct_users(tables["user_payments"])
    return out
