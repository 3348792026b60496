"""JN queries."""

from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark.workload.logs import (
    CUSTOMER_KEYS,
    ORD_TABLE,
    as_event_log,
    customer_keys,
    order_table,
    supplied,
)
from tidemark.workload.registry import query


@query("jn1_load_many", f"""WITH {ORD_TABLE}, {CUSTOMER_KEYS}
SELECT k.o_custkey, t.offset_num, t.metadata, t.updated_at
FROM keys k LEFT JOIN ord_table t ON k.o_custkey = t.o_custkey""")
def _(spark, sf_dir):
    return ops.load_many(order_table(spark, sf_dir), customer_keys(spark, sf_dir), ["o_custkey"])


@query("jn2_existing", f"""WITH {ORD_TABLE}, {CUSTOMER_KEYS}
SELECT o_custkey FROM keys WHERE o_custkey IN (SELECT o_custkey FROM ord_table)""")
def _(spark, sf_dir):
    return ops.existing(order_table(spark, sf_dir), customer_keys(spark, sf_dir), ["o_custkey"])


@query("jn3_missing", f"""WITH {ORD_TABLE}, {CUSTOMER_KEYS}
SELECT o_custkey FROM keys WHERE o_custkey NOT IN (SELECT o_custkey FROM ord_table)""")
def _(spark, sf_dir):
    return ops.missing(order_table(spark, sf_dir), customer_keys(spark, sf_dir), ["o_custkey"])


# Reading of each user's stream stopped on a day of its own; some never started.
STOPPED = """stopped AS (
    SELECT event_type AS pipeline_id, 'user-' || user_id AS stream_id, max(event_id) AS offset_num
    FROM events
    WHERE ts < TIMESTAMP '2024-01-01 00:00:00' + (user_id % 10) * INTERVAL 3 DAY
    GROUP BY event_type, user_id)"""


def stopped(spark, sf_dir):
    """Offsets at which reading of the events stopped."""
    events = supplied(spark, sf_dir, "events")
    stop = F.timestamp_add(
        "DAY", (F.col("user_id") % 10).cast("int") * 3, F.lit("2024-01-01").cast("timestamp_ntz")
    )
    read = as_event_log(events.where(F.col("ts") < stop))
    return ops.latest_by_arrival(read.select("pipeline_id", "stream_id", "offset_num", "seq"))


def source(spark, sf_dir):
    """The event records to be read, with the key of their stream."""
    events = supplied(spark, sf_dir, "events")
    return events.select(
        F.col("event_type").alias("pipeline_id"),
        F.concat(F.lit("user-"), F.col("user_id")).alias("stream_id"),
        "event_id",
        "value",
    )


RESUMED = f"""WITH {STOPPED}, source AS (
    SELECT event_type AS pipeline_id, 'user-' || user_id AS stream_id, event_id, value FROM events)
SELECT s.pipeline_id, s.stream_id, s.event_id, s.value
FROM source s LEFT JOIN stopped c ON s.pipeline_id = c.pipeline_id AND s.stream_id = c.stream_id
WHERE c.offset_num IS NULL OR s.event_id > c.offset_num"""


@query("jn4_resume", RESUMED)
def _(spark, sf_dir):
    return ops.resume(source(spark, sf_dir), stopped(spark, sf_dir), "event_id")


@query("jn4_resume_conversations", """WITH read AS (
    SELECT conv_id, max(turn) AS offset_num FROM conversations WHERE role = 'user' GROUP BY conv_id)
SELECT s.conv_id, s.turn, s.role FROM conversations s LEFT JOIN read r ON s.conv_id = r.conv_id
WHERE r.offset_num IS NULL OR s.turn > r.offset_num""")
def _(spark, sf_dir):
    turns = supplied(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    read = turns.where(F.col("role") == "user").groupBy("conv_id").agg(
        F.max("turn").alias("offset_num")
    )
    return ops.resume(turns, read, "turn", ["conv_id"])
