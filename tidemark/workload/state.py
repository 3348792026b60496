"""AGG, WIN and SRT queries."""

from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark.workload.logs import (
    EV_LOG,
    EV_STATE,
    LI_LOG,
    ORD_LOG,
    event_log,
    lineitem_log,
    order_log,
    supplied,
)
from tidemark.workload.registry import query

_LAST_EVENT = f"""WITH {EV_LOG}
SELECT pipeline_id, stream_id, offset_json, offset_num, metadata, created_at, updated_at, op, seq
FROM (SELECT *, row_number() OVER (PARTITION BY pipeline_id, stream_id ORDER BY seq DESC) AS n
      FROM ev_log) WHERE n = 1"""


@query("agg1_latest_by_arrival", _LAST_EVENT)
def _(spark, sf_dir):
    return ops.latest_by_arrival(event_log(spark, sf_dir))


@query("agg1_latest_by_arrival_lineitem", f"""WITH {LI_LOG}
SELECT l_suppkey, arg_max(offset_num, seq) AS offset_num, max(seq) AS seq
FROM li_log GROUP BY l_suppkey""")
def _(spark, sf_dir):
    log = lineitem_log(spark, sf_dir).select("l_suppkey", "offset_num", "seq")
    return ops.latest_by_arrival(log, ["l_suppkey"])


@query("agg1_latest_turn", """
SELECT conv_id, max(turn) AS turn, arg_max(role, turn) AS role, arg_max(text, turn) AS text
FROM conversations GROUP BY conv_id""")
def _(spark, sf_dir):
    return ops.latest_by_arrival(supplied(spark, sf_dir, "conversations"), ["conv_id"], "turn")


@query("agg2_latest_by_version", f"""WITH {ORD_LOG}
SELECT o_custkey, offset_num, metadata, updated_at, seq FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY updated_at DESC, seq DESC) AS n
    FROM ord_log) WHERE n = 1""")
def _(spark, sf_dir):
    return ops.latest_by_version(order_log(spark, sf_dir), ["o_custkey"])


@query("agg2_latest_by_version_lineitem", f"""WITH {LI_LOG}
SELECT l_suppkey, offset_num, updated_at, seq FROM (
    SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY updated_at DESC, seq DESC) AS n
    FROM li_log) WHERE n = 1""")
def _(spark, sf_dir):
    return ops.latest_by_version(lineitem_log(spark, sf_dir), ["l_suppkey"])


def _narrow_log(spark, sf_dir):
    return event_log(spark, sf_dir).select("pipeline_id", "stream_id", "op", "seq")


@query("agg3_count_checkpoints", f"""WITH {EV_STATE}
SELECT count(*) AS n_checkpoints FROM ev_state""")
def _(spark, sf_dir):
    return ops.count_checkpoints(ops.compact_log(_narrow_log(spark, sf_dir)))


@query("agg3_count_checkpoints_by_pipeline", f"""WITH {EV_STATE}
SELECT pipeline_id, count(*) AS n_checkpoints FROM ev_state GROUP BY pipeline_id""")
def _(spark, sf_dir):
    return ops.count_checkpoints(ops.compact_log(_narrow_log(spark, sf_dir)), "pipeline_id")


@query("agg4_list_streams", f"""WITH {EV_STATE} SELECT DISTINCT stream_id FROM ev_state""")
def _(spark, sf_dir):
    return ops.list_streams(ops.compact_log(_narrow_log(spark, sf_dir)))


@query("agg5_list_subkeys", f"""WITH {EV_STATE}
SELECT DISTINCT pipeline_id AS "partition" FROM ev_state WHERE stream_id = 'user-8'""")
def _(spark, sf_dir):
    table = ops.compact_log(event_log(spark, sf_dir).select("pipeline_id", "stream_id", "op", "seq"))
    return ops.list_subkeys(table.withColumn("partition", F.col("pipeline_id")), "user-8")


@query("agg5_list_subkeys_from_keys", """
SELECT DISTINCT substr(key, length('ck:user-8:') + 1) AS "partition" FROM (
    SELECT 'ck:user-' || user_id || ':' || event_type AS key FROM events)
WHERE starts_with(key, 'ck:user-8:')""")
def _(spark, sf_dir):
    keyed = ops.with_key(event_log(spark, sf_dir), "colon", "ck", ["stream_id", "pipeline_id"])
    return ops.list_subkeys(keyed.select("key"), "user-8", key="key", prefix="ck:")


@query("agg6_duplicate_keys", f"""WITH {EV_LOG}
SELECT pipeline_id, stream_id, count(*) AS n_rows FROM ev_log
GROUP BY pipeline_id, stream_id HAVING count(*) > 1""")
def _(spark, sf_dir):
    return ops.duplicate_keys(event_log(spark, sf_dir))


def _newest(n: int) -> str:
    return f"""WITH {EV_LOG}
SELECT pipeline_id, stream_id, offset_num, op, seq FROM (
    SELECT *, row_number() OVER (PARTITION BY pipeline_id, stream_id ORDER BY seq DESC) AS n
    FROM ev_log) WHERE n <= {n}"""


@query("win1_keep_last_1", _newest(1))
def _(spark, sf_dir):
    log = event_log(spark, sf_dir)
    return ops.keep_last_n(log.select("pipeline_id", "stream_id", "offset_num", "op", "seq"), n=1)


@query("win1_keep_last_3", _newest(3))
def _(spark, sf_dir):
    log = event_log(spark, sf_dir)
    return ops.keep_last_n(log.select("pipeline_id", "stream_id", "offset_num", "op", "seq"), n=3)


@query("win1_keep_last_1500_of_pipeline", f"""WITH {EV_LOG}
SELECT pipeline_id, stream_id, offset_num, seq FROM (
    SELECT *, row_number() OVER (PARTITION BY pipeline_id ORDER BY seq DESC) AS n
    FROM ev_log) WHERE n <= 1500""")
def _(spark, sf_dir):
    log = event_log(spark, sf_dir).select("pipeline_id", "stream_id", "offset_num", "seq")
    return ops.keep_last_n(log, ["pipeline_id"], n=1500, spread=True)


@query("srt1_ordered_by_time", f"""WITH {EV_STATE}
SELECT pipeline_id, stream_id, offset_num, updated_at,
       row_number() OVER (ORDER BY updated_at, pipeline_id, stream_id) AS position
FROM ev_state""")
def _(spark, sf_dir):
    table = ops.compact_log(event_log(spark, sf_dir)).select(
        "pipeline_id", "stream_id", "offset_num", "updated_at"
    )
    return ops.ordered_list(table, ["updated_at", "pipeline_id", "stream_id"], "position")


@query("srt1_ordered_by_key", f"""WITH {EV_STATE}
SELECT pipeline_id, stream_id, offset_num,
       row_number() OVER (ORDER BY pipeline_id, stream_id) AS position FROM ev_state""")
def _(spark, sf_dir):
    table = ops.compact_log(event_log(spark, sf_dir)).select("pipeline_id", "stream_id", "offset_num")
    return ops.ordered_list(table, ["pipeline_id", "stream_id"], "position")


@query("srt1_ordered_orders", f"""WITH {ORD_LOG}
SELECT o_custkey, offset_num, row_number() OVER (ORDER BY updated_at DESC, seq) AS position
FROM ord_log""")
def _(spark, sf_dir):
    order = [F.desc("updated_at"), "seq"]
    listed = ops.ordered_list(order_log(spark, sf_dir).drop("metadata"), order, "position")
    return listed.select("o_custkey", "offset_num", "position")


@query("srt2_limited_list", f"""WITH {EV_STATE}
SELECT pipeline_id, stream_id, offset_num, updated_at FROM ev_state
ORDER BY updated_at DESC, pipeline_id, stream_id LIMIT 50""")
def _(spark, sf_dir):
    table = ops.compact_log(event_log(spark, sf_dir)).select(
        "pipeline_id", "stream_id", "offset_num", "updated_at"
    )
    return ops.limited_list(table, 50, [F.desc("updated_at"), "pipeline_id", "stream_id"])


@query("srt3_list_all", f"""WITH {EV_STATE}
SELECT pipeline_id, stream_id, offset_json, offset_num, metadata, created_at, updated_at, op, seq
FROM ev_state""")
def _(spark, sf_dir):
    return ops.list_all(ops.compact_log(event_log(spark, sf_dir)))
