"""FLT queries: whole-log scans with one predicate."""

from tidemark import operators as ops
from tidemark.functions import prefix_end
from tidemark.workload.logs import EV_LOG, EV_STATE, event_log
from tidemark.workload.registry import query

_KEYED = EV_LOG + """, keyed AS (
    SELECT 'cp:' || pipeline_id || ':' || stream_id AS key, offset_num, seq FROM ev_log)"""


def _keyed(spark, sf_dir):
    log = ops.with_key(event_log(spark, sf_dir), "colon", "cp")
    return log.select("key", "offset_num", "seq")


@query("flt1_by_key", f"""WITH {EV_STATE}
SELECT pipeline_id, stream_id, offset_num, metadata, updated_at FROM ev_state
WHERE pipeline_id = 'view' AND stream_id = 'user-7'""")
def _(spark, sf_dir):
    table = ops.compact_log(event_log(spark, sf_dir))
    found = ops.by_key(table, pipeline_id="view", stream_id="user-7")
    return found.select("pipeline_id", "stream_id", "offset_num", "metadata", "updated_at")


@query("flt2_by_group", f"""WITH {EV_STATE}
SELECT pipeline_id, stream_id, offset_num, metadata, updated_at FROM ev_state
WHERE pipeline_id = 'click'""")
def _(spark, sf_dir):
    table = ops.compact_log(event_log(spark, sf_dir))
    return ops.by_group(table, "pipeline_id", "click").select(
        "pipeline_id", "stream_id", "offset_num", "metadata", "updated_at"
    )


@query("flt3_by_prefix", f"""WITH {_KEYED}
SELECT key, offset_num, seq FROM keyed WHERE starts_with(key, 'cp:click:user-1')""")
def _(spark, sf_dir):
    return ops.by_prefix(_keyed(spark, sf_dir), "cp:click:user-1")


@query("flt4_by_key_range", f"""WITH {_KEYED}
SELECT key, offset_num, seq FROM keyed WHERE key >= 'cp:purchase:' AND key < 'cp:purchase;'""")
def _(spark, sf_dir):
    prefix = "cp:purchase:"
    return ops.by_key_range(_keyed(spark, sf_dir), prefix, prefix_end(prefix))


@query("flt5_by_like", rf"""WITH {_KEYED}
SELECT key, offset_num, seq FROM keyed WHERE key LIKE 'cp:signup:user-_0%' ESCAPE '\'""")
def _(spark, sf_dir):
    return ops.by_pattern(_keyed(spark, sf_dir), "cp:signup:user-_0%", "like")


@query("flt5_by_glob", f"""WITH {_KEYED}
SELECT key, offset_num, seq FROM keyed WHERE key LIKE 'cp:error:%'""")
def _(spark, sf_dir):
    return ops.by_pattern(_keyed(spark, sf_dir), "cp:error:*", "glob")


@query("flt5_by_glob_class", f"""WITH {_KEYED}
SELECT key, offset_num, seq FROM keyed WHERE regexp_full_match(key, 'cp:[ev].*:user-1.')""")
def _(spark, sf_dir):
    return ops.by_pattern(_keyed(spark, sf_dir), "cp:[ev]*:user-1?", "glob")


@query("flt5_by_contains", f"""WITH {_KEYED}
SELECT key, offset_num, seq FROM keyed WHERE contains(key, 'sign')""")
def _(spark, sf_dir):
    return ops.by_pattern(_keyed(spark, sf_dir), "sign", "contains")


@query("flt6_by_payload_field", f"""WITH {EV_LOG}, payloads AS (
    SELECT seq, to_json(struct_pack(pipeline_id := pipeline_id, stream_id := stream_id)) AS data
    FROM ev_log)
SELECT seq FROM payloads WHERE json_extract_string(data, '$.pipeline_id') = 'error'""")
def _(spark, sf_dir):
    encoded = ops.encode_payloads(event_log(spark, sf_dir), extra=["pipeline_id"])
    return ops.by_payload_field(encoded, "pipeline_id", "error").select("seq")
