"""Registered queries that run the end-to-end jobs (P1-P7), gates and schema mapping.

The given tables are exported in the form the job's source has (CSV, JSON, XML, document
collections), the job reads the export and loads its table, and the query returns the
loaded table. Exports and tables lie under the shared work folder.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks import schemas
from martworks.functions import aggs
from martworks.operators import merge, quality, transform
from martworks.operators.trim import quantile_trim
from martworks.plans import jobs, mart_states
from martworks.plans.registry import _E1_SQL, _E2_FROM, _E3_SQL, ORACLE_SQL, register
from martworks.plans.testdata import (
    events_as_ratings,
    events_as_searches,
    events_as_views,
    load,
    orders_as_payments,
    orders_as_views,
    round_doubles,
)
from martworks.session import table_path, work_path
from martworks.sinks import merge_writers, writers
from martworks.sources import footers, readers

AS_OF = datetime(2024, 2, 1, 6, 0)
_LOADED = "TIMESTAMP '2024-02-01 06:00:00' AS loaded_at"
_ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _text(col: str):
    return F.col(col).cast("string")


def _table_name() -> str:
    return "mw_" + uuid.uuid4().hex[:12]


def _read_and_drop(spark: SparkSession, table: str) -> DataFrame:
    """The rows of an external table, whose catalog entry goes and whose files stay."""
    df = spark.table(table)
    df.schema  # noqa: B018  (resolved before the entry goes)
    spark.sql(f"DROP TABLE {table}")
    return df


# ---------------------------------------------------------------- P1, P2, P3


@register(
    "p1_sensor_clean",
    """
WITH s AS (SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS room_id_id,
                  CAST(ts AS DATE) AS noted_date, value AS temp, 'In' AS out_in
           FROM events WHERE event_type IN ('click', 'view')),
q AS (SELECT quantile_cont(temp, 0.05) AS lo, quantile_cont(temp, 0.95) AS hi FROM s)
SELECT s.* REPLACE (ROUND(temp, 6) AS temp) FROM s, q WHERE temp BETWEEN lo AND hi
""",
)
def q_p1_sensor_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    path = work_path(spark, "p1-readings")
    writers.write_csv(_readings(events, F.col("value")), path)
    _, clean = jobs.sensor_job(spark, path)
    return round_doubles(transform.normalize_columns(clean))


_P1_EXTREMES = """
WITH s AS (SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS room_id_id,
                  strftime(ts, '%d-%m-%Y %H:%M') AS noted_date, ROUND(value, 6) AS temp,
                  CASE WHEN event_type IN ('click', 'view') THEN 'In' ELSE 'Out' END AS out_in,
                  value, event_id
           FROM events),
h AS (SELECT * EXCLUDE (value, event_id), 'top' AS extreme_side,
             CAST(ROW_NUMBER() OVER (ORDER BY value DESC, event_id) AS INTEGER) AS extreme_rank FROM s),
c AS (SELECT * EXCLUDE (value, event_id), 'bottom' AS extreme_side,
             CAST(ROW_NUMBER() OVER (ORDER BY value, event_id) AS INTEGER) AS extreme_rank FROM s)
SELECT * FROM h WHERE extreme_rank <= 5 UNION ALL SELECT * FROM c WHERE extreme_rank <= 5
"""


def _readings(events: DataFrame, temp) -> DataFrame:
    """events as sensor readings; ``temp`` is the text or number of the reading."""
    inside = F.col("event_type").isin("click", "view")
    return events.select(
        _text("event_id").alias("id"),
        _text("user_id").alias("room_id/id"),
        F.date_format("ts", "dd-MM-yyyy HH:mm").alias("noted_date"),
        temp.alias("temp"),
        F.when(inside, "In").otherwise("Out").alias("out/in"),
    )


@register("p1_sensor_extremes", _P1_EXTREMES)
def q_p1_sensor_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "p1-extremes")
    writers.write_csv(_readings(load(spark, sf_dir, "events"), F.col("value")), path)
    extremes, _ = jobs.sensor_job(spark, path)
    return round_doubles(transform.normalize_columns(extremes))


_BAD = "event_id % 97 = 0 OR event_id % 89 = 0"


@register(
    "p1_quarantine",
    f"""
WITH s AS (SELECT *, strftime(ts, '%d-%m-%Y %H:%M') AS noted,
                  CASE WHEN event_type IN ('click', 'view') THEN 'In' ELSE 'Out' END AS side
           FROM events)
SELECT CAST(event_id AS VARCHAR) AS id, 'good' AS kind, ROUND(value, 6) AS temp,
       CAST(NULL AS VARCHAR) AS line, CAST(NULL AS VARCHAR) AS at_fault
FROM s WHERE NOT ({_BAD})
UNION ALL
SELECT CAST(event_id AS VARCHAR), 'rejected', NULL,
       concat_ws(',', event_id, user_id, noted,
                 CASE WHEN event_id % 97 = 0 THEN '"' || CAST(user_id AS VARCHAR) || ',5"'
                      ELSE 'n/a' END, side),
       'temp'
FROM s WHERE {_BAD}
""",
)
def q_p1_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings with a decimal comma or a word for a number are set aside, none is lost."""
    events = load(spark, sf_dir, "events")
    number = F.col("event_id")
    temp = (
        F.when(number % 97 == 0, F.concat(_text("user_id"), F.lit(",5")))
        .when(number % 89 == 0, F.lit("n/a"))
        .otherwise(_text("value"))
    )
    path = work_path(spark, "p1-bad-readings")
    writers.write_csv(_readings(events, temp), f"{path}/csv")
    checked = jobs.sensor_readings(spark, f"{path}/csv", f"{path}/rejects")
    nothing = F.lit(None).cast("string")
    good = checked.good.select(
        "id", F.lit("good").alias("kind"), "temp", nothing.alias("line"), nothing.alias("at_fault")
    )
    rejected = checked.rejected.select(
        F.split_part("line", F.lit(","), F.lit(1)).alias("id"),
        F.lit("rejected").alias("kind"),
        F.lit(None).cast("double").alias("temp"),
        "line",
        F.array_join("columns", ", ").alias("at_fault"),
    )
    return round_doubles(good.unionAll(rejected))


@register(
    "p2_one_time_load",
    """
SELECT c.column_name, CAST(c.ordinal_position AS INTEGER) AS ordinal_position, c.sql_type, n.row_count
FROM (VALUES ('c_custkey', 1, 'INTEGER'), ('c_name', 2, 'VARCHAR(255)'), ('c_nationkey', 3, 'INTEGER'),
             ('c_acctbal', 4, 'FLOAT'), ('c_mktsegment', 5, 'VARCHAR(255)'))
     c(column_name, ordinal_position, sql_type),
     (SELECT COUNT(*) AS row_count FROM customer) n
""",
)
def q_p2_one_time_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = work_path(spark, "p2-customer")
    writers.write_csv(load(spark, sf_dir, "customer"), f"{base}/csv")
    table = _table_name()
    profile = jobs.one_time_load(spark, f"{base}/csv", f"{base}/parquet", table, f"{base}/table")
    profile.schema  # noqa: B018
    spark.sql(f"DROP TABLE {table}")
    return profile


_P3_TARGET = "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01 00:00:00'"


@register(
    "p3_incremental",
    f"""
SELECT o.* REPLACE (ROUND(o_totalprice, 6) AS o_totalprice) FROM (
    {_P3_TARGET}
    UNION ALL
    SELECT * FROM orders WHERE o_orderdate > (SELECT MAX(o_orderdate) FROM ({_P3_TARGET}))) o
""",
)
def q_p3_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    table, path = _table_name(), work_path(spark, "p3-orders")
    old = orders.where(F.col("o_orderdate") < transform.as_timestamp("1996-01-01 00:00:00"))
    writers.full_refresh(old, table, path=path)
    jobs.incremental_job(spark, orders, table, "o_orderdate", datetime(1970, 1, 1), date(2024, 2, 1))
    return round_doubles(_read_and_drop(spark, table))


@register(
    "p3_missing_date_column",
    """
SELECT o_orderkey, o_orderstatus, DATE '1995-06-01' AS order_date FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS order_date FROM orders
WHERE CAST(o_orderdate AS DATE) > DATE '1995-06-01'
""",
)
def q_p3_missing_date_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("order_date")
    )
    table, path = _table_name(), work_path(spark, "p3-evolved")
    old = orders.where(F.col("o_orderstatus") == "F").drop("order_date")
    writers.full_refresh(old, table, path=path)
    jobs.incremental_job(spark, orders, table, "order_date", date(1970, 1, 1), date(1995, 6, 1))
    return _read_and_drop(spark, table)


# ---------------------------------------------------------------- P4, P5


_P4_SQL = f"""
SELECT c_name AS name, c_mktsegment AS species, c_mktsegment || ', ' || c_name AS favfoods,
       c_nationkey AS birthyear, CASE WHEN c_acctbal < 0 THEN NULL ELSE 'second' END AS photo,
       {_LOADED}
FROM customer
"""


def _pets(spark: SparkSession, sf_dir: str, customers: int) -> DataFrame:
    """Documents that repeat their pets; the last mention of a key wins."""
    customer = load(spark, sf_dir, "customer")

    def pet(photo):
        return F.struct(
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("species"),
            F.array("c_mktsegment", "c_name").alias("favFoods"),
            F.col("c_nationkey").alias("birthYear"),
            photo.alias("photo"),
        )

    # documents of so many customers at most, each customer twice
    grouped = customer.groupBy(F.expr(f"c_custkey div {customers}").alias("doc")).agg(
        F.collect_list(pet(F.lit("first"))).alias("one"),
        F.collect_list(pet(F.when(F.col("c_acctbal") >= 0, F.lit("second")))).alias("two"),
    )
    return grouped.select(F.concat("one", "two").alias("pets"))


@register("p4_json_pets", _P4_SQL)
def q_p4_json_pets(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "p4-pets")
    _pets(spark, sf_dir, 16).write.json(path)
    return jobs.json_job(spark, path, None, AS_OF, multi_line=False)


@register("p4_large_json", _P4_SQL)
def q_p4_large_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document a file, read by several tasks."""
    path = work_path(spark, "p4-large-pets")
    _pets(spark, sf_dir, 1000).write.option("maxRecordsPerFile", 1).json(path)
    return jobs.json_job(spark, path, None, AS_OF, large=True)


_P5_SQL = f"""
SELECT p_name || ' ' || CAST(p_partkey AS VARCHAR) AS name, p_brand AS manufacturer,
       CAST(p_size AS DECIMAL(10, 2)) AS serving_value, 'g' AS serving_units,
       CAST(p_size * 4 AS INTEGER) AS calories_total, CAST(p_size AS INTEGER) AS calories_fat,
       CAST(p_retailprice AS DECIMAL(10, 2)) AS total_fat, CAST(NULL AS DECIMAL(10, 2)) AS saturated_fat,
       CAST(0 AS INTEGER) AS cholesterol, CAST(p_size AS INTEGER) AS sodium,
       CAST(p_size AS DECIMAL(10, 2)) AS carbohydrates, CAST(1.5 AS DECIMAL(10, 2)) AS fiber,
       CAST(NULL AS DECIMAL(10, 2)) AS protein, CAST(1 AS INTEGER) AS vitamin_a,
       CAST(2 AS INTEGER) AS vitamin_c, CAST(3 AS INTEGER) AS calcium, CAST(NULL AS INTEGER) AS iron,
       {_LOADED}
FROM part
"""


def _foods(spark: SparkSession, sf_dir: str, records: int) -> str:
    """Files of so many records at most; nested elements of the same tag are not records."""
    part = load(spark, sf_dir, "part")
    size = _text("p_size")
    foods = part.select(
        F.concat_ws(" ", "p_name", _text("p_partkey")).alias("name"),
        F.col("p_brand").alias("mfr"),
        F.struct(size.alias("_VALUE"), F.lit("g").alias("_units")).alias("serving"),
        F.struct(
            (F.col("p_size") * 4).cast("string").alias("_total"), size.alias("_fat")
        ).alias("calories"),
        F.format_string("%.2f", "p_retailprice").alias("total-fat"),
        F.lit("n/a").alias("saturated-fat"),
        F.lit("0").alias("cholesterol"),
        size.alias("sodium"),
        size.alias("carb"),
        F.lit("1.5").alias("fiber"),
        F.struct(F.lit("1").alias("a"), F.lit("2").alias("c")).alias("vitamins"),
        F.struct(F.lit("3").alias("ca")).alias("minerals"),
        F.struct(F.struct(F.lit("not a record").alias("name")).alias("food")).alias("seealso"),
    )
    path = work_path(spark, "p5-foods")
    writer = foods.write.format("xml").option("rowTag", "food").option("rootTag", "foods")
    writer.option("maxRecordsPerFile", records).save(path)
    return path


@register("p5_xml_nutrition", _P5_SQL)
def q_p5_xml_nutrition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.xml_job(spark, _foods(spark, sf_dir, 500), AS_OF)


@register("p5_large_xml", _P5_SQL)
def q_p5_large_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of any size, read by several tasks."""
    return jobs.xml_job(spark, _foods(spark, sf_dir, 1_000_000), AS_OF, large=True)


# ---------------------------------------------------------------- P6: the other three collections


def _replicated(spark: SparkSession, name: str, export: DataFrame) -> DataFrame:
    """The loaded table of a collection whose export holds each document once more."""
    base = work_path(spark, f"p6-{name}")
    key = schemas.TARGET_KEYS[name]
    export.write.json(f"{base}/export/a")
    again = export.withColumn("user_id", F.lit("repeated later"))
    again.where(F.col(key).endswith("0")).write.json(f"{base}/export/b")
    raw = jobs.read_collections(spark, {name: f"{base}/export/*"})
    jobs.replicate_collections_into(spark, raw, {name: f"{base}/table"}, AS_OF)
    columns = schemas.TARGET_TABLES[name].fieldNames()
    return spark.read.parquet(f"{base}/table").select(*columns)


_P6_PAYMENTS = f"""
SELECT 'pay_' || CAST(o_orderkey AS VARCHAR) AS payment_id, 'user_' || CAST(o_custkey AS VARCHAR) AS user_id,
       o_orderdate AS payment_date, CAST(o_totalprice AS DECIMAL(10, 2)) AS amount, 'USD' AS currency,
       CASE o_orderstatus WHEN 'F' THEN 'credit_card' WHEN 'O' THEN 'paypal' ELSE 'cash' END AS payment_method,
       CASE o_orderstatus WHEN 'F' THEN 'card' WHEN 'O' THEN 'digital' ELSE 'other' END
           AS payment_method_category,
       o_orderpriority AS subscription_plan, 'completed' AS status,
       CAST(NULL AS TIMESTAMP) AS next_billing_date, CAST(NULL AS VARCHAR) AS promo_code_applied,
       {_LOADED}, 'mongodb' AS source
FROM orders
"""


@register("p6_replicate_payments", _P6_PAYMENTS)
def q_p6_replicate_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts are text in the documents, a billing date is not a date."""
    status = F.col("o_orderstatus")
    export = load(spark, sf_dir, "orders").select(
        F.concat(F.lit("pay_"), _text("o_orderkey")).alias("payment_id"),
        F.concat(F.lit("user_"), _text("o_custkey")).alias("user_id"),
        F.date_format("o_orderdate", _ISO).alias("payment_date"),
        F.format_string("%.2f", "o_totalprice").alias("amount"),
        F.lit("USD").alias("currency"),
        F.when(status == "F", "credit_card").when(status == "O", "paypal").otherwise("cash")
        .alias("payment_method"),
        F.col("o_orderpriority").alias("subscription_plan"),
        F.lit("completed").alias("status"),
        F.lit("next month").alias("next_billing_date"),
    )
    return _replicated(spark, "user_payments", export)


@register(
    "p6_replicate_ratings",
    f"""
SELECT 'rating_' || CAST(event_id AS VARCHAR) AS rating_id, 'user_' || CAST(user_id AS VARCHAR) AS user_id,
       props AS movie_id, event_type AS movie_title, CAST(trunc(value) AS INTEGER) AS rating,
       event_type AS review_text, date_trunc('second', ts) AS created_at,
       CAST(user_id AS INTEGER) AS helpful_count, CAST(0 AS INTEGER) AS reports_count,
       false AS moderation_flag, {_LOADED}, 'mongodb' AS source
FROM events
""",
)
def q_p6_replicate_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings as numbers with a fraction, counts as text, two fields missing."""
    export = load(spark, sf_dir, "events").select(
        F.concat(F.lit("rating_"), _text("event_id")).alias("rating_id"),
        F.concat(F.lit("user_"), _text("user_id")).alias("user_id"),
        F.col("props").alias("movie_id"),
        F.col("event_type").alias("movie_title"),
        F.col("value").alias("rating"),
        F.col("event_type").alias("review_text"),
        F.date_format("ts", _ISO).alias("created_at"),
        _text("user_id").alias("helpful_count"),
    )
    return _replicated(spark, "content_ratings", export)


@register(
    "p6_replicate_searches",
    f"""
SELECT 'search_' || CAST(doc_id AS VARCHAR) AS search_id, 'user_' || source AS user_id, text AS query,
       CAST(length(text) AS INTEGER) AS query_length, TIMESTAMP '2024-01-05 10:00:00' AS timestamp,
       '{{"lang":"' || lang || '","undeclared":{{"deep":[1,2]}}}}' AS filters_applied,
       CAST(n_chars AS INTEGER) AS results_count,
       CASE WHEN lang = 'en' THEN 'movie_' || source END AS clicked_movie_id,
       lang AS session_id, {_LOADED}, 'mongodb' AS source
FROM documents
""",
)
def q_p6_replicate_searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as queries; the filters keep fields that nobody declared."""
    source = F.col("source")
    export = load(spark, sf_dir, "documents").select(
        F.concat(F.lit("search_"), _text("doc_id")).alias("search_id"),
        F.concat(F.lit("user_"), source).alias("user_id"),
        F.col("text").alias("query"),
        F.lit("2024-01-05T10:00:00Z").alias("timestamp"),
        F.struct(
            F.col("lang"), F.struct(F.array(F.lit(1), F.lit(2)).alias("deep")).alias("undeclared")
        ).alias("filters_applied"),
        F.col("n_chars").cast("double").alias("results_count"),
        F.when(F.col("lang") == "en", F.concat(F.lit("movie_"), source)).alias("clicked_movie_id"),
        F.col("lang").alias("session_id"),
    )
    return _replicated(spark, "search_queries", export)


@register(
    "s5_raw_numbers_as_text",
    """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ROUND(value, 6) END AS amount,
       CASE WHEN event_type = 'error' THEN NULL ELSE CAST(user_id AS INTEGER) END AS whole
FROM events
""",
)
def q_s5_raw_numbers_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in documents as text, as numbers, with a fraction of zero, or as no number."""
    kind, user = F.col("event_type"), F.col("user_id")
    export = load(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "click", F.to_json(F.struct(_text("value").alias("n"))))
        .when(kind == "error", F.lit('{"n":"5d"}'))
        .otherwise(F.to_json(F.struct(F.col("value").alias("n"))))
        .alias("amount"),
        F.when(kind == "view", F.to_json(F.struct(user.cast("double").alias("n"))))
        .when(kind == "error", F.lit('{"n":""}'))
        .otherwise(F.to_json(F.struct(_text("user_id").alias("n"))))
        .alias("whole"),
    )
    # the inner value of {"n": value} as it is written, so that one field has all the forms
    inner = lambda c: F.regexp_extract(c, r'^\{"n":(.*)\}$', 1)
    lines = export.select(
        F.format_string(
            '{"event_id":%d,"amount":%s,"whole":%s}', "event_id", inner("amount"), inner("whole")
        ).alias("value")
    )
    path = work_path(spark, "s5-numbers")
    lines.write.text(path)
    raw = readers.read_collection(spark, path, "event_id long, amount string, whole string")
    typed = transform.coerce_numeric(transform.coerce_numeric(raw, ["amount"]), ["whole"], "int")
    return round_doubles(typed)


# ---------------------------------------------------------------- P7: written marts and summaries


def _marts(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    events, orders = load(spark, sf_dir, "events"), load(spark, sf_dir, "orders")
    content = "mart_content_performance" in names
    tables = {
        "movie_views": orders_as_views(orders) if content else events_as_views(events),
        "content_ratings": events_as_ratings(events),
        "search_queries": events_as_searches(events),
        "user_payments": orders_as_payments(orders),
    }
    return jobs.build_marts(tables, work_path(spark, "p7-marts"), names)


def _register_p7(name: str, mart: str, table: str, sql: str) -> None:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(_marts(spark, sf_dir, mart)[table])

    query.__name__ = f"q_{name}"
    register(name, sql)(query)


_register_p7("p7_mart_user_activity", "mart_user_activity", "mart_user_activity", _E1_SQL)
_register_p7(
    "p7_mart_content_performance", "mart_content_performance", "mart_content_performance",
    ORACLE_SQL["e2_content_performance"],
)
_register_p7("p7_mart_payment_analysis", "mart_payment_analysis", "mart_payment_analysis", _E3_SQL)
_register_p7(
    "r1_genre_summary", "mart_content_performance", "genre_summary",
    _E2_FROM
    + "SELECT genre, COUNT(*) AS total_movies, ROUND(AVG(avg_rating), 6) AS avg_rating "
    "FROM content GROUP BY genre",
)
_register_p7(
    "r2_favourite_genre_summary", "mart_user_activity", "favourite_genre_summary",
    f"SELECT favorite_genre, COUNT(*) AS users FROM ({_E1_SQL}) GROUP BY favorite_genre",
)
_register_p7(
    "r3_plan_summary", "mart_payment_analysis", "plan_summary",
    f"SELECT subscription_plan, COUNT(*) AS users FROM ({_E3_SQL}) GROUP BY subscription_plan",
)


def _by_day(spark: SparkSession, sf_dir: str, mart: str) -> DataFrame:
    """The mart after three load days and a second load of the last one."""
    events, orders = load(spark, sf_dir, "events"), load(spark, sf_dir, "orders")
    content = mart == "mart_content_performance"
    # whole minutes, as the replicated table has them: sums over days are exact
    whole = events_as_views(events).withColumn(
        "watch_duration_minutes", F.col("watch_duration_minutes").cast("int")
    )
    rows = {
        "movie_views": orders_as_views(orders) if content else whole,
        "content_ratings": events_as_ratings(events),
        "search_queries": events_as_searches(events),
        "user_payments": orders_as_payments(orders),
    }
    ids = {
        "movie_views": "view_id", "content_ratings": "rating_id",
        "search_queries": "search_id", "user_payments": "payment_id",
    }
    base = work_path(spark, "p7-by-day")
    wanted = {mart_states.STATES[n].table for n in mart_states.MARTS[mart][0]}
    paths = {name: f"{base}/{name}" for name in wanted}
    made = {}
    for day in (1, 2, 3, 3):
        for name, path in paths.items():
            part = rows[name].where(F.col(ids[name]) % 3 == day - 1)
            merge_writers.reload_day_into(
                spark, part, path, [ids[name]], date(2024, 3, day), unique_keys=True, key_buckets=8
            )
        made = mart_states.refresh_marts(
            spark, paths, f"{base}/states", f"{base}/marts", date(2024, 3, day), [mart]
        )
    return round_doubles(made[mart])


_E1_WHOLE_SQL = _E1_SQL.replace(
    "ROUND(SUM(value), 6)", "CAST(SUM(CAST(TRUNC(value) AS INTEGER)) AS BIGINT)"
).replace("AVG(value)", "AVG(CAST(TRUNC(value) AS INTEGER))")

for _mart, _sql in (
    ("mart_user_activity", _E1_WHOLE_SQL),
    ("mart_content_performance", ORACLE_SQL["e2_content_performance"]),
    ("mart_payment_analysis", _E3_SQL),
):

    def _query(spark: SparkSession, sf_dir: str, mart: str = _mart) -> DataFrame:
        return _by_day(spark, sf_dir, mart)

    register(f"p7_by_day_{_mart.removeprefix('mart_')}", _sql)(_query)


# ---------------------------------------------------------------- M5, V1, V3 from file statistics


def _stored_orders(spark: SparkSession, sf_dir: str) -> str:
    path = work_path(spark, "footers-orders")
    day = F.to_date("o_orderdate").alias("order_day")
    load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", day).write.parquet(path)
    return path


@register("m5_stored_watermark", "SELECT MAX(CAST(o_orderdate AS DATE)) AS watermark FROM orders")
def q_m5_stored_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = footers.stored_watermark(spark, _stored_orders(spark, sf_dir), "order_day", date(1970, 1, 1))
    return spark.range(1).select(F.lit(mark).alias("watermark"))


@register(
    "v3_stored_report",
    """
SELECT COUNT(*) AS total_rows, MIN(CAST(o_orderdate AS DATE)) AS min_date,
       MAX(CAST(o_orderdate AS DATE)) AS max_date, CAST(0 AS BIGINT) AS new_rows
FROM orders
""",
)
def q_v3_stored_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return footers.stored_report(spark, _stored_orders(spark, sf_dir), "order_day")


@register(
    "v1_stored_counts",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
        for t in ("orders", "lineitem", "customer", "events")
    ),
)
def q_v1_stored_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("orders", "lineitem", "customer", "events")
    return footers.stored_counts(spark, {n: table_path(sf_dir, n) for n in names})


# ---------------------------------------------------------------- A5, A7, M4, T16, gates


@register(
    "a5_count_distinct_if",
    """
SELECT o_custkey, COUNT(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END) AS done_kinds,
       COUNT(DISTINCT o_orderpriority) AS kinds
FROM orders GROUP BY o_custkey
""",
)
def q_a5_count_distinct_if(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = F.col("o_orderstatus") == "F"
    return load(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        aggs.count_distinct_if(done, "o_orderpriority").alias("done_kinds"),
        aggs.count_distinct("o_orderpriority").alias("kinds"),
    )


_UNEVEN = "l_extendedprice * l_extendedprice * l_extendedprice * (l_discount - 0.05)"


@register(
    "a7_quantile_trim_skewed",
    f"""
WITH v AS (SELECT l_orderkey, l_linenumber, {_UNEVEN} AS x FROM lineitem),
q AS (SELECT quantile_cont(x, 0.05) AS lo, quantile_cont(x, 0.95) AS hi FROM v)
SELECT l_orderkey, l_linenumber FROM v, q WHERE x BETWEEN lo AND hi
""",
)
def q_a7_quantile_trim_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.expr(_UNEVEN.replace("0.05", "0.05D")).alias("x")
    )
    return quantile_trim(rows, "x").drop("x")


@register(
    "m4_reload_day_rerun_in_place",
    """
SELECT event_id, event_type, ROUND(value, 6) AS value, TIMESTAMP '2024-03-01 05:00:00' AS loaded_at,
       DATE '2024-03-01' AS load_date
FROM events WHERE event_type IN ('click', 'view')
""",
)
def q_m4_reload_day_rerun_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day 2 first brings every event, its rerun only events that day 1 holds: the rows
    that only the first run brought have to go."""
    events = load(spark, sf_dir, "events").select("event_id", "event_type", "value")
    first = events.where(F.col("event_type").isin("click", "view"))
    path = work_path(spark, "m4-rerun")
    for day, rows in ((1, first), (2, events), (2, first.withColumn("value", F.col("value") + 1))):
        stamped = rows.withColumn("loaded_at", transform.as_timestamp(f"2024-03-0{day} 05:00:00"))
        merge_writers.reload_day_into(
            spark, stamped, path, ["event_id"], date(2024, 3, day), key_buckets=8
        )
    return round_doubles(spark.read.parquet(path))


@register(
    "t16_target_schema",
    """
SELECT 'CREATE TABLE orders (o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus VARCHAR(255), '
       || 'o_totalprice FLOAT, o_orderdate TIMESTAMP, o_orderpriority VARCHAR(255))' AS ddl,
       'o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus VARCHAR(255), o_totalprice FLOAT, '
       || 'o_orderdate TIMESTAMP, o_orderpriority VARCHAR(255)' AS jdbc_types,
       COUNT(*) AS row_count
FROM orders
""",
)
def q_t16_target_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    return orders.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(transform.target_ddl(orders, "orders")).alias("ddl"),
        F.lit(transform.jdbc_column_types(orders)).alias("jdbc_types"),
        "row_count",
    )


@register(
    "v2_v5_v6_gates",
    """
SELECT 'V2' AS gate, 'orders' AS table_name, CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS failures FROM orders
UNION ALL
SELECT 'V2', 'returned nothing', CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END FROM orders WHERE o_totalprice < 0
UNION ALL
SELECT 'V5', 'events', CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END FROM events
UNION ALL
SELECT 'V6', 'events.big_value', COUNT(*) FILTER (WHERE value <= 100) FROM events
UNION ALL
SELECT 'V6', 'events.event_id', COUNT(*) FILTER (WHERE event_id IS NULL) FROM events
""",
)
def q_v2_v5_v6_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, events = load(spark, sf_dir, "orders"), load(spark, sf_dir, "events")
    marked = events.withColumn("big_value", F.when(F.col("value") > 100, F.col("value")))
    return quality.gate_report(
        nonempty={"orders": orders, "returned nothing": orders.where("o_totalprice < 0")},
        records={"events": events},
        not_null={"events": (marked, ["big_value", "event_id"])},
    )


@register(
    "m5_high_watermark",
    "SELECT MAX(ts) AS watermark FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'",
)
def q_m5_high_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    target = events.where(F.col("ts") < transform.as_timestamp("2024-01-15 00:00:00"))
    mark = merge.high_watermark(target, "ts", datetime(1970, 1, 1))
    return spark.range(1).select(transform.literal_for(mark, events.schema["ts"].dataType).alias("watermark"))
