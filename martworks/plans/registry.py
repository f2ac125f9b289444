"""Registered queries over the driver's tables, each with its DuckDB oracle.

Every query reads whole tables at ``sf_dir`` and returns a lazy ``DataFrame``. Floating
columns are rounded to 6 digits on both sides, because two engines sum doubles in
different orders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martworks.operators.quality import row_counts
from martworks.plans import marts
from martworks.plans.testdata import (
    ALL_TABLES,
    events_as_ratings,
    events_as_searches,
    events_as_views,
    load,
    orders_as_payments,
    orders_as_views,
    round_doubles,
)

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return wrap


# ---------------------------------------------------------------- marts

_E1_SQL = """
SELECT user_id,
       COUNT(DISTINCT event_id) AS total_views,
       ROUND(SUM(value), 6) AS total_watch_time_minutes,
       ROUND(AVG(value), 6) AS avg_watch_duration,
       COUNT(DISTINCT props) AS unique_movies_watched,
       MODE() WITHIN GROUP (ORDER BY event_type) AS favorite_genre,
       ROUND(CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS DOUBLE)
             / COUNT(*) * 100, 6) AS completion_rate,
       MAX(ts) AS last_activity_date
FROM events
GROUP BY user_id
"""


def _user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_user_activity(events_as_views(load(spark, sf_dir, "events")))


@register("e1_user_activity", _E1_SQL)
def q_e1_user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(_user_activity(spark, sf_dir))


_E2_FROM = """
WITH mv AS (
    SELECT o_orderkey AS view_id, CAST(year(o_orderdate) AS INTEGER) AS user_id,
           o_custkey AS movie_id, o_orderstatus AS movie_title, o_orderpriority AS genre,
           o_totalprice AS watch_duration_minutes
    FROM orders),
cr AS (SELECT event_id AS rating_id, user_id AS movie_id, value AS rating
       FROM events WHERE event_type = 'click'),
sq AS (SELECT event_id AS search_id, user_id AS clicked_movie_id
       FROM events WHERE event_type = 'purchase'),
content AS (
    SELECT mv.movie_id, mv.movie_title, mv.genre,
           COUNT(DISTINCT mv.view_id) AS total_views,
           COUNT(DISTINCT mv.user_id) AS unique_viewers,
           AVG(mv.watch_duration_minutes) AS avg_watch_duration,
           AVG(cr.rating) AS avg_rating,
           COUNT(DISTINCT cr.rating_id) AS total_ratings,
           COUNT(DISTINCT sq.search_id) AS search_appearances,
           CAST(COUNT(DISTINCT CASE WHEN sq.clicked_movie_id = mv.movie_id
                                    THEN sq.search_id END) AS DOUBLE)
               / NULLIF(COUNT(DISTINCT sq.search_id), 0) * 100 AS search_to_view_rate
    FROM mv
    LEFT JOIN cr ON mv.movie_id = cr.movie_id
    LEFT JOIN sq ON mv.movie_id = sq.clicked_movie_id
    GROUP BY mv.movie_id, mv.movie_title, mv.genre)
"""


def _content(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    events = load(spark, sf_dir, "events")
    return marts.mart_content_performance(
        orders_as_views(orders), events_as_ratings(events), events_as_searches(events)
    )


@register(
    "e2_content_performance",
    _E2_FROM
    + """
SELECT movie_id, movie_title, genre, total_views, unique_viewers,
       ROUND(avg_watch_duration, 6) AS avg_watch_duration,
       ROUND(avg_rating, 6) AS avg_rating, total_ratings, search_appearances,
       ROUND(search_to_view_rate, 6) AS search_to_view_rate
FROM content
""",
)
def q_e2_content_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(_content(spark, sf_dir))


_E3_SQL = """
SELECT o_custkey AS user_id, o_orderpriority AS subscription_plan,
       COUNT(*) AS total_payments,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(10, 2))) AS DECIMAL(20, 2)) AS total_revenue,
       MIN(o_orderdate) AS first_payment,
       MAX(o_orderdate) AS last_payment,
       CAST(AVG(CAST(o_totalprice AS DECIMAL(10, 2))) AS DECIMAL(14, 6)) AS avg_payment_amount,
       MODE() WITHIN GROUP (ORDER BY o_orderstatus) AS preferred_payment_method,
       CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS successful_payments
FROM orders
GROUP BY o_custkey, o_orderpriority
"""


def _payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_as_payments(load(spark, sf_dir, "orders"))


@register("e3_payment_analysis", _E3_SQL)
def q_e3_payment_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_payment_analysis(_payments(spark, sf_dir))


@register("r4_distinct_users", "SELECT COUNT(DISTINCT o_custkey) AS unique_users FROM orders")
def q_r4_distinct_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.distinct_users(_payments(spark, sf_dir))


# ---------------------------------------------------------------- quality (V1)

@register(
    "v1_row_counts",
    "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in ALL_TABLES
    ),
)
def q_v1_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts({t: load(spark, sf_dir, t) for t in ALL_TABLES})


# ---------------------------------------------------------------- trim and top-n

from martworks.operators import merge, topn, transform  # noqa: E402
from martworks.operators.quality import load_report, table_profile  # noqa: E402
from martworks.operators.trim import quantile_trim  # noqa: E402
from martworks.functions import columns as fcols  # noqa: E402


@register(
    "a7_quantile_trim",
    """
WITH c AS (SELECT * FROM events WHERE event_type = 'click'),
b AS (SELECT quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.95) AS hi FROM c)
SELECT c.* FROM c, b WHERE c.value BETWEEN b.lo AND b.hi
""",
)
def q_a7_quantile_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = transform.filter_equals(load(spark, sf_dir, "events"), "event_type", "click")
    return round_doubles(quantile_trim(clicks, "value", 0.05, 0.95))


@register(
    "l1_top_n",
    """
SELECT * FROM orders WHERE o_totalprice IS NOT NULL
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""",
)
def q_l1_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.top_n(load(spark, sf_dir, "orders"), 10, "o_totalprice", tie_order=["o_orderkey"])


@register(
    "l2_extremes",
    """
SELECT * FROM (
    SELECT *, 'top' AS extreme_side,
           CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS extreme_rank
    FROM orders WHERE o_totalprice IS NOT NULL) WHERE extreme_rank <= 5
UNION ALL
SELECT * FROM (
    SELECT *, 'bottom' AS extreme_side,
           CAST(row_number() OVER (ORDER BY o_totalprice ASC, o_orderkey) AS INTEGER) AS extreme_rank
    FROM orders WHERE o_totalprice IS NOT NULL) WHERE extreme_rank <= 5
""",
)
def q_l2_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topn.extremes(load(spark, sf_dir, "orders"), 5, "o_totalprice", tie_order=["o_orderkey"])


# ---------------------------------------------------------------- merges

@register(
    "m1_dedupe_first",
    """
SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                 ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn
    FROM lineitem) WHERE rn = 1
""",
)
def q_m1_dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.dedupe_first(
        load(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"],
    )


_CUSTOMER_MERGE_SQL = """
WITH t AS (
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
           TIMESTAMP '2024-01-01 00:00:00' AS loaded_at
    FROM customer WHERE c_acctbal < 5000),
b AS (
    SELECT c_custkey, lower(c_name) AS c_name, c_nationkey, c_acctbal + 100 AS c_acctbal,
           c_mktsegment, 1 AS seq
    FROM customer WHERE c_acctbal >= 2500
    UNION ALL
    SELECT c_custkey, lower(c_name) AS c_name, c_nationkey, c_acctbal - 1 AS c_acctbal,
           'REVISED' AS c_mktsegment, 2 AS seq
    FROM customer WHERE c_nationkey < 5)
"""


def _customer_target_batch(spark: SparkSession, sf_dir: str):
    customer = load(spark, sf_dir, "customer")
    target = customer.where(F.col("c_acctbal") < 5000).withColumn(
        "loaded_at", transform.as_timestamp("2024-01-01 00:00:00")
    )
    cols = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    first = customer.where(F.col("c_acctbal") >= 2500).select(
        "c_custkey", F.lower("c_name").alias("c_name"), "c_nationkey",
        (F.col("c_acctbal") + 100).alias("c_acctbal"), "c_mktsegment", F.lit(1).alias("seq"),
    )
    second = customer.where(F.col("c_nationkey") < 5).select(
        "c_custkey", F.lower("c_name").alias("c_name"), "c_nationkey",
        (F.col("c_acctbal") - 1).alias("c_acctbal"), F.lit("REVISED").alias("c_mktsegment"),
        F.lit(2).alias("seq"),
    )
    return target, first.unionByName(second), cols


@register(
    "m2_upsert",
    _CUSTOMER_MERGE_SQL
    + """,
bl AS (SELECT * EXCLUDE (rn, seq) FROM (
    SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) AS rn FROM b)
    WHERE rn = 1),
bf AS (SELECT * EXCLUDE (rn, seq) FROM (
    SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY seq) AS rn FROM b)
    WHERE rn = 1)
SELECT t.* FROM t WHERE NOT EXISTS (SELECT 1 FROM bl WHERE bl.c_custkey = t.c_custkey)
UNION ALL
SELECT bl.c_custkey,
       CASE WHEN t.c_custkey IS NOT NULL THEN t.c_name ELSE bf.c_name END AS c_name,
       CASE WHEN t.c_custkey IS NOT NULL THEN t.c_nationkey ELSE bf.c_nationkey END AS c_nationkey,
       bl.c_acctbal, bl.c_mktsegment, TIMESTAMP '2024-02-01 00:00:00' AS loaded_at
FROM bl JOIN bf ON bl.c_custkey = bf.c_custkey
LEFT JOIN t ON bl.c_custkey = t.c_custkey
""",
)
def q_m2_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch, _ = _customer_target_batch(spark, sf_dir)
    out = merge.upsert(
        target, batch, ["c_custkey"], order_by=["seq"],
        update_cols=["c_acctbal", "c_mktsegment"],
        stamp=("loaded_at", "2024-02-01 00:00:00"),
    )
    return round_doubles(out)


@register(
    "m3_insert_ignore",
    _CUSTOMER_MERGE_SQL
    + """,
bf AS (SELECT * EXCLUDE (rn, seq) FROM (
    SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY seq) AS rn FROM b)
    WHERE rn = 1)
SELECT * FROM t
UNION ALL
SELECT bf.*, TIMESTAMP '2024-02-01 00:00:00' AS loaded_at FROM bf
WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.c_custkey = bf.c_custkey)
""",
)
def q_m3_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch, _ = _customer_target_batch(spark, sf_dir)
    batch = batch.withColumn("loaded_at", transform.as_timestamp("2024-02-01 00:00:00"))
    return round_doubles(merge.insert_ignore(target, batch, ["c_custkey"], order_by=["seq"]))


_EVENT_COLS = "event_id, ts, user_id, event_type, value, props"


@register(
    "m4_reload_day",
    f"""
WITH t AS (SELECT {_EVENT_COLS}, ts AS loaded_at FROM events),
b AS (
    SELECT event_id, ts, user_id, event_type, value + 1 AS value, props,
           TIMESTAMP '2024-01-20 06:00:00' AS loaded_at, 1 AS seq
    FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'
    UNION ALL
    SELECT event_id, ts, user_id, event_type, value + 2 AS value, props,
           TIMESTAMP '2024-01-20 06:00:00' AS loaded_at, 2 AS seq
    FROM events WHERE ts >= TIMESTAMP '2024-01-25 00:00:00'),
bf AS (SELECT * EXCLUDE (rn, seq) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY seq) AS rn FROM b) WHERE rn = 1),
kept AS (SELECT * FROM t WHERE loaded_at IS NULL OR CAST(loaded_at AS DATE) < DATE '2024-01-20')
SELECT * FROM kept
UNION ALL
SELECT * FROM bf WHERE NOT EXISTS (SELECT 1 FROM kept WHERE kept.event_id = bf.event_id)
""",
)
def q_m4_reload_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    target = events.withColumn("loaded_at", F.col("ts"))
    stamp = transform.as_timestamp("2024-01-20 06:00:00")
    ts = F.col("ts")
    b1 = events.where(ts >= transform.as_timestamp("2024-01-15 00:00:00")).withColumns(
        {"value": F.col("value") + 1, "loaded_at": stamp, "seq": F.lit(1)}
    )
    b2 = events.where(ts >= transform.as_timestamp("2024-01-25 00:00:00")).withColumns(
        {"value": F.col("value") + 2, "loaded_at": stamp, "seq": F.lit(2)}
    )
    out = merge.reload_day(
        target, b1.unionByName(b2), ["event_id"], as_of=transform.date(2024, 1, 20),
        order_by=["seq"],
    )
    return round_doubles(out)


_WM_TARGET = "SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-15 00:00:00'"


def _wm_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    return events.where(F.col("ts") < transform.as_timestamp("2024-01-15 00:00:00"))


_M6_SQL = f"""
SELECT *, false AS is_new FROM ({_WM_TARGET})
UNION ALL
SELECT *, true AS is_new FROM events WHERE ts > (SELECT MAX(ts) FROM ({_WM_TARGET}))
"""


def _incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.incremental_load(
        load(spark, sf_dir, "events"), _wm_target(spark, sf_dir), "ts",
        default=transform.datetime(1970, 1, 1), flag_col="is_new",
    )


@register("m6_incremental_load", _M6_SQL)
def q_m6_incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(_incremental(spark, sf_dir))


@register(
    "v3_load_report",
    f"""
SELECT COUNT(*) AS total_rows, MIN(ts) AS min_date, MAX(ts) AS max_date,
       CAST(SUM(CASE WHEN is_new THEN 1 ELSE 0 END) AS BIGINT) AS new_rows
FROM ({_M6_SQL})
""",
)
def q_v3_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_report(_incremental(spark, sf_dir), "ts", "is_new")


# ---------------------------------------------------------------- coercions

@register(
    "t3_parse_date",
    "SELECT event_id, CAST(ts AS DATE) AS noted_date FROM events",
)
def q_t3_parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    text = events.select("event_id", F.date_format("ts", "dd-MM-yyyy HH:mm").alias("noted_date"))
    return transform.parse_date(text, "noted_date", "dd-MM-yyyy HH:mm")


@register(
    "t4_coerce_timestamp",
    """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS start_time FROM events
""",
)
def q_t4_coerce_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    text = events.select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("not a time"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .alias("start_time"),
    )
    return transform.coerce_timestamp(text, ["start_time"])


@register(
    "t5_coerce_numeric",
    "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS amount FROM events",
)
def q_t5_coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    text = events.select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("n/a"))
        .otherwise(F.col("value").cast("string"))
        .alias("amount"),
    )
    return round_doubles(transform.coerce_numeric(text, ["amount"], "double"))


@register(
    "t6_to_float_int",
    """
WITH v AS (
    SELECT event_id,
           CASE WHEN event_type IN ('error', 'view') THEN NULL
                WHEN event_type = 'signup' THEN -value ELSE value END AS x
    FROM events)
SELECT event_id, ROUND(x, 6) AS as_float, CAST(trunc(x) AS INTEGER) AS as_int FROM v
""",
)
def q_t6_to_float_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    v = F.col("value").cast("string")
    kind = F.col("event_type")
    text = (
        F.when(kind == "error", F.lit("n/a"))
        .when(kind == "view", F.concat(v, F.lit("d")))
        .when(kind == "signup", F.concat(F.lit(" -"), v, F.lit(" ")))
        .otherwise(v)
    )
    out = events.select("event_id", text.alias("raw"))
    return round_doubles(
        out.select("event_id", fcols.to_float("raw").alias("as_float"), fcols.to_int("raw").alias("as_int"))
    )


@register(
    "t7_to_decimal",
    """
SELECT l_orderkey, l_linenumber,
       CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) * CAST(l_discount AS DECIMAL(4, 2))
            AS DECIMAL(10, 2)) AS discount_amount
FROM lineitem
""",
)
def q_t7_to_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    amount = fcols.to_decimal("l_extendedprice", 12, 2) * fcols.to_decimal("l_discount", 4, 2)
    return li.select("l_orderkey", "l_linenumber", fcols.to_decimal(amount, 10, 2).alias("discount_amount"))


@register(
    "t8_flatten_props",
    """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS props_k,
       CAST(json_object('k', CAST(json_extract(props, '$.k') AS INTEGER)) AS VARCHAR) AS props_json
FROM events
""",
)
def q_t8_flatten_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    parsed = events.select("event_id", F.from_json("props", "k INT").alias("props"))
    parsed = parsed.withColumn("props_json", F.col("props"))
    flat = transform.flatten_struct(parsed, "props", ["k"])
    return transform.to_json_columns(flat, ["props_json"]).select("event_id", "props_k", "props_json")


@register(
    "t10_join_array",
    "SELECT p_partkey, array_to_string(string_split(p_name, ' '), ', ') AS name_parts FROM part",
)
def q_t10_join_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    return part.select("p_partkey", fcols.join_array(F.split("p_name", " ")).alias("name_parts"))


@register(
    "t11_map_values",
    """
SELECT o_orderkey, o_orderstatus,
       CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'open' ELSE 'other' END
           AS status_category
FROM orders
""",
)
def q_t11_map_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey", "o_orderstatus",
        fcols.map_values("o_orderstatus", {"F": "fulfilled", "O": "open"}, "other").alias("status_category"),
    )


@register("t12_text_length", "SELECT doc_id, CAST(length(text) AS INTEGER) AS text_chars FROM documents")
def q_t12_text_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return docs.select("doc_id", fcols.text_length("text").alias("text_chars"))


@register(
    "t15_conform_customer",
    """
SELECT c_custkey AS cust_key, c_name AS name, c_nationkey AS nation_key,
       CAST(c_acctbal AS DECIMAL(12, 2)) AS acct_bal,
       COALESCE(c_mktsegment, 'UNKNOWN') AS mkt_segment,
       CAST(0 AS INTEGER) AS reports_count, false AS moderation_flag,
       TIMESTAMP '2024-03-01 00:00:00' AS loaded_at, 'tpch' AS source
FROM customer
""",
)
def q_t15_conform_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import types as T

    customer = load(spark, sf_dir, "customer")
    raw = transform.project_rename(
        customer,
        [("c_custkey", "Cust Key"), ("c_name", "Name"), ("c_nationkey", "Nation/Key"),
         ("c_acctbal", "Acct-Bal"), ("c_mktsegment", "Mkt Segment")],
    )
    df = transform.normalize_columns(raw)
    df = transform.add_audit_columns(df, transform.datetime(2024, 3, 1), "tpch")
    df = transform.add_missing_column(df, "reports_count", "int", None)
    schema = T.StructType([
        T.StructField("cust_key", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("nation_key", T.IntegerType()),
        T.StructField("acct_bal", T.DecimalType(12, 2)),
        T.StructField("mkt_segment", T.StringType()),
        T.StructField("reports_count", T.IntegerType()),
        T.StructField("moderation_flag", T.BooleanType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
        T.StructField("source", T.StringType()),
    ])
    return transform.conform(
        df, schema, {"reports_count": 0, "moderation_flag": False, "mkt_segment": "UNKNOWN"}
    )


@register(
    "v4_table_profile",
    """
SELECT column_name, CAST(ordinal_position AS INTEGER) AS ordinal_position,
       CASE data_type WHEN 'BIGINT' THEN 'BIGINT' WHEN 'INTEGER' THEN 'INTEGER'
                      WHEN 'DOUBLE' THEN 'FLOAT' WHEN 'VARCHAR' THEN 'VARCHAR(255)'
                      WHEN 'TIMESTAMP' THEN 'TIMESTAMP' WHEN 'DATE' THEN 'DATE'
                      WHEN 'BOOLEAN' THEN 'BOOLEAN' ELSE 'TEXT' END AS sql_type,
       (SELECT COUNT(*) FROM lineitem) AS row_count
FROM information_schema.columns WHERE table_name = 'lineitem'
""",
)
def q_v4_table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_profile(load(spark, sf_dir, "lineitem"))


# ---------------------------------------------------------------- sources and sinks
# Each writes whole tables to a fresh folder under the shared checkpoint folder and
# reads them back with the operator under test.

from martworks.session import is_folder, table_path, work_path  # noqa: E402
from martworks.sinks import writers  # noqa: E402
from martworks.sources import readers  # noqa: E402
from martworks.streaming.stream_load import read_target, run_stream_load  # noqa: E402


@register("s1_csv_roundtrip", "SELECT * FROM part")
def q_s1_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    path = work_path(spark, "s1-part-csv")
    writers.write_csv(part, path)
    return readers.read_csv(spark, path, schema=part.schema)


@register("s2_parquet_roundtrip", "SELECT * FROM lineitem")
def q_s2_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = load(spark, sf_dir, "lineitem")
    path = work_path(spark, "s2-lineitem")
    writers.write_parquet(lineitem, path, partition_by=["l_returnflag"])
    return readers.read_parquet(spark, path).select(*lineitem.columns)


@register("s3_json_records", "SELECT * FROM part")
def q_s3_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    # documents of at most 16 parts each: {"parts": [{...}, ...]}
    docs = part.groupBy(F.expr("p_partkey div 16").alias("doc")).agg(
        F.collect_list(F.struct(*part.columns)).alias("parts")
    )
    path = work_path(spark, "s3-part-json")
    docs.select("parts").write.mode("overwrite").json(path)
    return readers.read_json_records(spark, path, "parts", part.schema, multi_line=False)


@register("s4_xml_records", "SELECT * FROM part")
def q_s4_xml_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    path = work_path(spark, "s4-part-xml")
    part.write.mode("overwrite").format("xml").option("rowTag", "part").option(
        "rootTag", "parts"
    ).save(path)
    return readers.read_xml_records(spark, path, "part", part.schema)


@register("s5_collection_roundtrip", "SELECT * FROM events")
def q_s5_collection_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import types as T

    events = load(spark, sf_dir, "events")
    path = work_path(spark, "s5-events-jsonl")
    events.select(F.concat(F.lit("oid-"), F.col("event_id").cast("string")).alias("_id"), "*") \
        .write.mode("overwrite").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") \
        .json(path)
    schema = T.StructType([T.StructField("_id", T.StringType())] + events.schema.fields)
    return readers.read_collection(spark, path, schema)


@register("k3_append_by_name", "SELECT * FROM customer")
def q_k3_append_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load(spark, sf_dir, "customer")
    path = work_path(spark, "k3-customer")
    writers.write_parquet(customer.where(F.col("c_acctbal") < 5000), path)
    later = customer.where(~(F.col("c_acctbal") < 5000)).select(*reversed(customer.columns))
    writers.append_table(later, path, spark)
    return readers.read_parquet(spark, path)


@register("k4_full_refresh_table", "SELECT * FROM part")
def q_k4_full_refresh_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = load(spark, sf_dir, "part")
    path = work_path(spark, "k4-part-table")
    table = "mw_" + path.rsplit("-", 1)[-1]
    writers.full_refresh(part.where(F.col("p_size") < 10), table, path=path)
    writers.full_refresh(part, table, path=path)
    out = readers.read_table(spark, table)
    out.schema  # noqa: B018  (resolved before the catalog entry goes; the files stay)
    spark.sql(f"DROP TABLE {table}")
    return out


@register("m7_stream_load", "SELECT * FROM events")
def q_m7_stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    events_schema = load(spark, sf_dir, "events").schema
    target = work_path(spark, "m7-target")
    checkpoint = work_path(spark, "m7-checkpoint")
    source = table_path(sf_dir, "events")
    # a table is a folder of files, or one file beside the other tables
    where = (source, {}) if is_folder(spark, source) else (sf_dir, {"path_glob": "events.parquet"})
    for _ in range(2):  # the second run finds no new file and adds nothing
        run_stream_load(
            spark, where[0], events_schema, target, ["event_id"], checkpoint,
            order_by=["ts"], **where[1],
        )
    return read_target(spark, target, events_schema)


@register("m7_stream_seen_keys", "SELECT * FROM events")
def q_m7_stream_seen_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys seen are kept in the state store; the landing folder holds every event twice."""
    events = load(spark, sf_dir, "events")
    target, landing = work_path(spark, "m7-seen-target"), work_path(spark, "m7-landing")
    where = (target, ["event_id"], work_path(spark, "m7-seen-checkpoint"))
    events.write.parquet(landing)
    run_stream_load(spark, landing, events.schema, *where, seen="state")
    again = events.withColumn("value", F.lit(-1.0))
    again.write.mode("append").parquet(landing)
    run_stream_load(spark, landing, events.schema, *where, seen="state")
    return read_target(spark, target, events.schema)


# ---------------------------------------------------------------- end-to-end replication
# events exported as a movie_views document collection (nested device, interaction list,
# ISO text with 'Z'), with a second, later export repeating the 'error' events; the job
# reads the export (S5), keeps the first arrival per view id (M1), types and flattens it
# (T4/T5/T8/T9/T13/T15) and loads it by day reload (M4) into an empty table.

from datetime import datetime as _dt  # noqa: E402

from martworks import schemas as _schemas  # noqa: E402
from martworks.plans import jobs as _jobs  # noqa: E402

_ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"
_REPL_AS_OF = _dt(2024, 2, 1, 6, 0)


def _export_views(events: DataFrame, title: str) -> DataFrame:
    ts = F.col("ts")
    k = F.get_json_object("props", "$.k")
    return events.select(
        F.concat(F.lit("oid-"), F.col("event_id").cast("string")).alias("_id"),
        F.concat(F.lit("view_"), F.col("event_id").cast("string")).alias("view_id"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"),
        F.concat(F.lit("movie_"), k).alias("movie_id"),
        F.lit(title).alias("movie_title"),
        F.col("event_type").alias("genre"),
        F.date_format(ts, _ISO).alias("start_time"),
        F.date_format(ts + F.expr("INTERVAL 90 MINUTES"), _ISO).alias("end_time"),
        F.col("value").cast("int").alias("watch_duration_minutes"),
        (F.col("event_type") == "purchase").alias("completed"),
        F.struct(
            F.col("event_type").alias("type"), F.lit("web").alias("os"),
            F.lit(None).cast("string").alias("browser"),
        ).alias("device"),
        F.when(
            F.col("event_type") == "click",
            F.array(F.struct(F.lit("click").alias("type"), F.date_format(ts, _ISO).alias("timestamp"))),
        ).otherwise(F.array().cast("array<struct<type:string,timestamp:string>>")).alias("interactions"),
    )


def _export(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    events = load(spark, sf_dir, "events")
    base = work_path(spark, "p6-views-export")
    _export_views(events, "first").write.mode("overwrite").json(f"{base}/a")
    repeats = events.where(F.col("event_type") == "error")
    _export_views(repeats, "repeat").write.mode("overwrite").json(f"{base}/b")
    return _jobs.read_collections(spark, {"movie_views": f"{base}/*"})


def _replicated_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _export(spark, sf_dir)
    target = spark.createDataFrame([], _schemas.TARGET_TABLES["movie_views"])
    return _jobs.replicate_collections(raw, {"movie_views": target}, _REPL_AS_OF)["movie_views"]


def _replicated_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 as the daily job runs it: the replica is written (partitioned by load day) and
    the marts read the table, as the reference's mart jobs read the replicated tables."""
    path = work_path(spark, "p6-movie-views")
    _jobs.replicate_collections_into(spark, _export(spark, sf_dir), {"movie_views": path}, _REPL_AS_OF)
    return spark.read.parquet(path).drop("load_date")


_P6_SQL = """
SELECT 'view_' || CAST(event_id AS VARCHAR) AS view_id,
       'user_' || CAST(user_id AS VARCHAR) AS user_id,
       'movie_' || json_extract_string(props, '$.k') AS movie_id,
       'first' AS movie_title, event_type AS genre,
       date_trunc('second', ts) AS start_time,
       date_trunc('second', ts) + INTERVAL 90 MINUTE AS end_time,
       CAST(trunc(value) AS INTEGER) AS watch_duration_minutes,
       event_type = 'purchase' AS completed,
       event_type AS device_type, 'web' AS device_os,
       CASE WHEN event_type = 'click'
            THEN '[{"type":"click","timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '"}]'
            ELSE '[]' END AS interactions,
       TIMESTAMP '2024-02-01 06:00:00' AS loaded_at, 'mongodb' AS source
FROM events
"""


@register("p6_replicate_views", _P6_SQL)
def q_p6_replicate_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replicated_views(spark, sf_dir)


@register(
    "p7_activity_from_replica",
    f"""
WITH mv AS ({_P6_SQL})
SELECT user_id,
       COUNT(DISTINCT view_id) AS total_views,
       CAST(SUM(watch_duration_minutes) AS BIGINT) AS total_watch_time_minutes,
       ROUND(AVG(watch_duration_minutes), 6) AS avg_watch_duration,
       COUNT(DISTINCT movie_id) AS unique_movies_watched,
       MODE() WITHIN GROUP (ORDER BY genre) AS favorite_genre,
       ROUND(CAST(SUM(CASE WHEN completed THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) * 100, 6)
           AS completion_rate,
       MAX(start_time) AS last_activity_date
FROM mv GROUP BY user_id
""",
)
def q_p7_activity_from_replica(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(marts.mart_user_activity(_replicated_table(spark, sf_dir)))


# ---------------------------------------------------------------- joins (J1, J3) and merge counts

from martworks.operators import joins as _joins  # noqa: E402


@register(
    "j1_left_join_facts",
    """
WITH ev AS (SELECT user_id, COUNT(*) AS n_events FROM events GROUP BY user_id)
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, c.c_name, c.c_acctbal, ev.n_events
FROM orders o
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN ev ON o.o_custkey = ev.user_id
""",
)
def q_j1_left_join_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # both facts hold at most one row per key, so the join never multiplies rows
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    per_user = load(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"))
    joined = _joins.left_join_facts(orders, [(customer, "c_custkey"), (per_user, "user_id")], "o_custkey")
    return round_doubles(joined.select(
        "_base.o_orderkey", "_base.o_custkey", "_base.o_totalprice", "_f0.c_name", "_f0.c_acctbal",
        "_f1.n_events",
    ))


@register(
    "j3_anti_join",
    """
SELECT * FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = o.o_custkey)
""",
)
def q_j3_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    # orders of customers that have no events at all
    orders = load(spark, sf_dir, "orders")
    active = load(spark, sf_dir, "events").select(F.col("user_id").alias("o_custkey"))
    return round_doubles(_joins.anti_join(orders, active, ["o_custkey"]))


@register(
    "x14_merge_counts",
    _CUSTOMER_MERGE_SQL
    + """
SELECT CAST(COUNT(*) FILTER (WHERE t.c_custkey IS NULL) AS BIGINT) AS inserted,
       CAST(COUNT(*) FILTER (WHERE t.c_custkey IS NOT NULL) AS BIGINT) AS updated
FROM (SELECT DISTINCT c_custkey FROM b) k LEFT JOIN t ON k.c_custkey = t.c_custkey
""",
)
def q_x14_merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch, _ = _customer_target_batch(spark, sf_dir)
    return merge.merge_counts(target, batch, ["c_custkey"])


# ---------------------------------------------------------------- merges written in place (M3, M4)

from martworks.sinks import merge_writers as _mw  # noqa: E402

#: The given tables are small; a large target takes hundreds.
_KEY_BUCKETS = 8


@register(
    "m3_insert_ignore_in_place",
    _CUSTOMER_MERGE_SQL
    + """,
bf AS (SELECT * EXCLUDE (rn, seq) FROM (
    SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY seq) AS rn FROM b)
    WHERE rn = 1)
SELECT * FROM t
UNION ALL
SELECT bf.*, TIMESTAMP '2024-02-01 00:00:00' AS loaded_at FROM bf
WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.c_custkey = bf.c_custkey)
""",
)
def q_m3_insert_ignore_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch, _ = _customer_target_batch(spark, sf_dir)
    path = work_path(spark, "m3-customer")
    target.write.parquet(path)
    batch = batch.withColumn("loaded_at", transform.as_timestamp("2024-02-01 00:00:00"))
    _mw.insert_ignore_into(
        spark, batch, path, ["c_custkey"], order_by=["seq"], key_buckets=_KEY_BUCKETS
    )
    return round_doubles(spark.read.parquet(path))


@register(
    "m4_reload_day_in_place",
    "SELECT *, CAST(loaded_at AS DATE) AS load_date FROM ("
    + ORACLE_SQL["m4_reload_day"]
    + ")",
)
def q_m4_reload_day_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    path = work_path(spark, "m4-events")
    events.withColumns({"loaded_at": F.col("ts"), "load_date": F.to_date("ts")}).write.partitionBy(
        "load_date"
    ).parquet(path)
    stamp = transform.as_timestamp("2024-01-20 06:00:00")
    ts = F.col("ts")
    b1 = events.where(ts >= transform.as_timestamp("2024-01-15 00:00:00")).withColumns(
        {"value": F.col("value") + 1, "loaded_at": stamp, "seq": F.lit(1)}
    )
    b2 = events.where(ts >= transform.as_timestamp("2024-01-25 00:00:00")).withColumns(
        {"value": F.col("value") + 2, "loaded_at": stamp, "seq": F.lit(2)}
    )
    _mw.reload_day_into(
        spark, b1.unionByName(b2), path, ["event_id"], transform.date(2024, 1, 20),
        order_by=["seq"], key_buckets=_KEY_BUCKETS,
    )
    out = spark.read.parquet(path)
    return round_doubles(out.select(*events.columns, "loaded_at", "load_date"))


@register("m2_upsert_in_place", ORACLE_SQL["m2_upsert"])
def q_m2_upsert_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch, cols = _customer_target_batch(spark, sf_dir)
    path = work_path(spark, "m2-customer")
    # the target as stored: partitioned by a hash bucket of its key
    # buckets sized to the table (about 2k customers per bucket at sf0.1)
    target.withColumn("key_bucket", _mw.key_bucket(["c_custkey"], 8)).hint(
        "rebalance", "key_bucket"
    ).write.partitionBy("key_bucket").parquet(path)
    _mw.upsert_into(
        spark, batch, path, ["c_custkey"], order_by=["seq"],
        update_cols=["c_acctbal", "c_mktsegment"], stamp=("loaded_at", "2024-02-01 00:00:00"),
        buckets=8,
    )
    return round_doubles(spark.read.parquet(path).select(*cols, "loaded_at"))


from martworks.plans import registry_jobs  # noqa: E402,F401  (registers the job queries)
