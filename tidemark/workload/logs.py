"""Progress logs made from the supplied tables, in Spark and in SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import compact_log, latest_by_arrival

#: Events before this instant make up the table, those after it are changes to it.
HALF = "2024-01-16 00:00:00"

STATE_COLUMNS = ["pipeline_id", "stream_id", "offset_json", "offset_num", "metadata", "updated_at"]


def supplied(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_event_log(events: DataFrame) -> DataFrame:
    """Every event says that its user's stream was read up to it; every tenth is a delete."""
    return events.select(
        F.col("event_type").alias("pipeline_id"),
        F.concat(F.lit("user-"), F.col("user_id")).alias("stream_id"),
        F.col("event_id").cast("string").alias("offset_json"),
        F.col("event_id").alias("offset_num"),
        F.col("props").alias("metadata"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.col("ts").cast("timestamp").alias("updated_at"),
        F.when(F.col("event_id") % 10 == 0, "delete").otherwise("save").alias("op"),
        F.col("event_id").alias("seq"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_event_log(supplied(spark, sf_dir, "events"))


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders arrive by key, not by date: arrival and version disagree."""
    return supplied(spark, sf_dir, "orders").select(
        "o_custkey",
        F.col("o_orderkey").alias("offset_num"),
        F.col("o_orderpriority").alias("metadata"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        F.col("o_orderkey").alias("seq"),
    )


def lineitem_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest log: reading of suppliers' lines, one offset per line."""
    return supplied(spark, sf_dir, "lineitem").select(
        "l_suppkey",
        F.col("l_orderkey").alias("offset_num"),
        F.col("l_shipdate").cast("timestamp").alias("updated_at"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
    )


def first_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as it stood at half time."""
    log = event_log(spark, sf_dir)
    return compact_log(log.where(F.col("updated_at") < F.lit(HALF).cast("timestamp"))).select(
        *STATE_COLUMNS
    )


def second_half(spark: SparkSession, sf_dir: str, op: str = "save") -> DataFrame:
    """The saves (or deletes) from half time on."""
    log = event_log(spark, sf_dir)
    late = log.where((F.col("updated_at") >= F.lit(HALF).cast("timestamp")) & (F.col("op") == op))
    return late.select(*STATE_COLUMNS, "seq")


def late_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys whose last event from half time on is a delete."""
    log = event_log(spark, sf_dir).where(F.col("updated_at") >= F.lit(HALF).cast("timestamp"))
    last = latest_by_arrival(log.select("pipeline_id", "stream_id", F.col("op") == "delete", "seq").toDF(
        "pipeline_id", "stream_id", "deleted", "seq"
    ))
    return last.where("deleted").select("pipeline_id", "stream_id")


def customer_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer, and as many keys that nobody has."""
    known = supplied(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return known.unionByName(known.select((F.col("o_custkey") + 1000000000).alias("o_custkey")))


def order_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current order per customer, by arrival."""
    return latest_by_arrival(order_log(spark, sf_dir), ["o_custkey"]).drop("seq")


# The same in SQL, as common table expressions to build on.

EV_LOG = """ev_log AS (
    SELECT event_type AS pipeline_id, 'user-' || user_id AS stream_id,
           CAST(event_id AS VARCHAR) AS offset_json, event_id AS offset_num,
           props AS metadata, ts AS created_at, ts AS updated_at,
           CASE WHEN event_id % 10 = 0 THEN 'delete' ELSE 'save' END AS op,
           event_id AS seq
    FROM events)"""

STATE_PART = """ev_state AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY pipeline_id, stream_id ORDER BY seq DESC) AS n
        FROM ev_log) WHERE n = 1 AND op <> 'delete')"""

EV_STATE = f"{EV_LOG}, {STATE_PART}"

ORD_LOG = """ord_log AS (
    SELECT o_custkey, o_orderkey AS offset_num, o_orderpriority AS metadata,
           o_orderdate AS updated_at, o_orderkey AS seq FROM orders)"""

ORD_TABLE = ORD_LOG + """, ord_table AS (
    SELECT o_custkey, offset_num, metadata, updated_at FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY seq DESC) AS n
        FROM ord_log) WHERE n = 1)"""

LI_LOG = """li_log AS (
    SELECT l_suppkey, l_orderkey AS offset_num, l_shipdate AS updated_at,
           l_orderkey * 8 + l_linenumber AS seq FROM lineitem)"""

CUSTOMER_KEYS = """keys AS (
    SELECT c_custkey AS o_custkey FROM customer
    UNION ALL SELECT c_custkey + 1000000000 FROM customer)"""

HALVES = EV_LOG + f""", old AS (
    SELECT pipeline_id, stream_id, offset_json, offset_num, metadata, updated_at FROM (
        SELECT *, row_number() OVER (PARTITION BY pipeline_id, stream_id ORDER BY seq DESC) AS n
        FROM ev_log WHERE updated_at < TIMESTAMP '{HALF}') WHERE n = 1 AND op <> 'delete'),
late AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY pipeline_id, stream_id ORDER BY seq DESC) AS n
        FROM ev_log WHERE updated_at >= TIMESTAMP '{HALF}' AND op = 'save') WHERE n = 1),
late_gone AS (
    SELECT pipeline_id, stream_id FROM (
        SELECT *, row_number() OVER (PARTITION BY pipeline_id, stream_id ORDER BY seq DESC) AS n
        FROM ev_log WHERE updated_at >= TIMESTAMP '{HALF}') WHERE n = 1 AND op = 'delete'),
gone AS (
    SELECT DISTINCT pipeline_id, stream_id FROM ev_log
    WHERE updated_at >= TIMESTAMP '{HALF}' AND op = 'delete')"""
