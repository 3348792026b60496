"""TTL queries: every save lives a while, or as long as its user says."""

from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark.plans import scratch_path
from tidemark.workload.logs import EV_LOG, event_log
from tidemark.workload.registry import query

#: After the last event, so that the table is made of all of them.
AS_OF = "2024-02-01 00:00:00"

#: How long a save counts: twelve days.
TTL = 12 * 86400

DAY_TABLE = EV_LOG + f""", stamped AS (
    SELECT pipeline_id, stream_id, offset_num, updated_at, op,
           updated_at + INTERVAL {TTL} SECOND AS expires_at,
           row_number() OVER (PARTITION BY pipeline_id, stream_id ORDER BY seq DESC) AS n
    FROM ev_log),
ttl_table AS (
    SELECT pipeline_id, stream_id, offset_num, updated_at, op, expires_at
    FROM stamped WHERE n = 1 AND op <> 'delete')"""


def day_table(spark, sf_dir):
    """The current row of every key, with the end of its life; deleted keys have none."""
    log = event_log(spark, sf_dir).select(
        "pipeline_id", "stream_id", "offset_num", "updated_at", "op", "seq"
    )
    return ops.compact_log(ops.stamp_expiry(log, TTL)).drop("seq")


@query("ttl1_stamp_expiry", """
SELECT event_id, ts + INTERVAL 3600 SECOND AS expires_at FROM events""")
def _(spark, sf_dir):
    stamped = ops.stamp_expiry(event_log(spark, sf_dir), 3600)
    return stamped.select(F.col("seq").alias("event_id"), "expires_at")


@query("ttl1_stamp_expiry_per_row", """
SELECT event_id, CASE WHEN user_id % 3 <> 0
                      THEN TIMESTAMP '2024-02-01' + to_seconds((user_id % 5 - 1) * 60) END AS expires_at
FROM events""")
def _(spark, sf_dir):
    user = F.substring("stream_id", 6, 20).cast("bigint")
    ttl = F.when(user % 3 != 0, (user % 5 - 1) * 60)
    log = event_log(spark, sf_dir).withColumn("ttl", ttl)
    stamped = ops.stamp_expiry(log, "ttl", as_of="2024-02-01")
    return stamped.select(F.col("seq").alias("event_id"), "expires_at")


@query("ttl2_live", f"""WITH {DAY_TABLE}
SELECT * FROM ttl_table WHERE expires_at IS NULL OR expires_at > TIMESTAMP '{AS_OF}'""")
def _(spark, sf_dir):
    return ops.live(day_table(spark, sf_dir), AS_OF)


@query("ttl2_live_at_boundary", f"""WITH {DAY_TABLE}, edge AS (
    SELECT max(expires_at) AS at FROM ttl_table)
SELECT t.* FROM ttl_table t, edge WHERE expires_at >= edge.at""")
def _(spark, sf_dir):
    # The last instant at which any row expires: alive under this rule only.
    table = day_table(spark, sf_dir)
    edge = table.agg(F.max("expires_at").alias("at"))
    return ops.live(table, edge.scalar(), boundary="live")


@query("ttl3_purge_kept", f"""WITH {DAY_TABLE}
SELECT * FROM ttl_table WHERE expires_at > TIMESTAMP '{AS_OF}'""")
def _(spark, sf_dir):
    kept, _, _ = ops.write_purged(day_table(spark, sf_dir), scratch_path(spark, "purged"), AS_OF)
    return kept


@query("ttl3_purge_purged", f"""WITH {DAY_TABLE}
SELECT * FROM ttl_table WHERE expires_at <= TIMESTAMP '{AS_OF}'""")
def _(spark, sf_dir):
    _, purged, _ = ops.write_purged(day_table(spark, sf_dir), scratch_path(spark, "purged"), AS_OF)
    return purged


@query("ttl4_list_live", f"""WITH {DAY_TABLE}
SELECT * FROM ttl_table WHERE expires_at > TIMESTAMP '{AS_OF}' AND pipeline_id = 'view'""")
def _(spark, sf_dir):
    return ops.list_live(day_table(spark, sf_dir), AS_OF, ("pipeline_id", "view"))
