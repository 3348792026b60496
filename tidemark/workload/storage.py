"""SRC queries: round trips through the shared folder."""

from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark import sources, streaming
from tidemark.plans import scratch_path
from tidemark.schema import PROGRESS
from tidemark.table import ProgressTable
from tidemark.workload.logs import (
    EV_LOG,
    EV_STATE,
    HALF,
    HALVES,
    STATE_PART,
    event_log,
    first_half,
    second_half,
)
from tidemark.workload.registry import query
from tidemark.workload.streams import run_to_end

_FIELDS = ["pipeline_id", "stream_id", "offset_json", "offset_num", "metadata", "updated_at"]
_SQL_FIELDS = "pipeline_id, stream_id, offset_json, offset_num, replace(metadata, ' ', '') AS metadata, updated_at"


def _written(spark, sf_dir) -> str:
    path = scratch_path(spark, "files")
    sources.write_checkpoint_files(ops.compact_log(event_log(spark, sf_dir)), path)
    return path


@query("src1_read_checkpoint_files", f"""WITH {EV_STATE} SELECT {_SQL_FIELDS} FROM ev_state""")
def _(spark, sf_dir):
    good, _ = sources.read_checkpoint_files(spark, _written(spark, sf_dir))
    return good.select(*_FIELDS)


@query("src1_read_one_pipeline", f"""WITH {EV_STATE}
SELECT {_SQL_FIELDS} FROM ev_state WHERE pipeline_id = 'click'""")
def _(spark, sf_dir):
    good, _ = sources.read_checkpoint_files(spark, _written(spark, sf_dir), "click")
    return good.select(*_FIELDS)


def _objects(spark, sf_dir):
    """Current rows of two groups of pipelines, each to be written as one object per key."""
    rows = ops.compact_log(event_log(spark, sf_dir)).withColumn("checkpoint_id", F.col("stream_id"))
    early = F.col("pipeline_id").isin("click", "view")
    return rows.where(early), rows.where(~early)


@query("src1_read_objects", f"""WITH {EV_STATE}
SELECT stream_id AS checkpoint_id, {_SQL_FIELDS} FROM ev_state""")
def _(spark, sf_dir):
    path = scratch_path(spark, "objects")
    for rows in _objects(spark, sf_dir):
        sources.write_checkpoint_objects(rows, path)
    good, _ = sources.read_checkpoint_files(spark, path, layout="objects")
    return good.select("checkpoint_id", *_FIELDS)


@query("src1_stream_objects", f"""WITH {EV_STATE}
SELECT stream_id AS checkpoint_id, {_SQL_FIELDS} FROM ev_state""")
def _(spark, sf_dir):
    # The stream is stopped and started again between the groups; what it has read does not come again.
    path, state = scratch_path(spark, "objects"), scratch_path(spark, "state")
    lists, out = scratch_path(spark, "lists"), scratch_path(spark, "arrived")
    for rows in _objects(spark, sf_dir):
        sources.write_checkpoint_objects(rows, path)
        good, _ = sources.stream_checkpoint_files(spark, path, lists=lists)
        arrived = good.select("checkpoint_id", *_FIELDS)
        with sources.many_files(spark):
            run_to_end(streaming.stream_append(arrived, out, state))
    return spark.read.schema(arrived.schema).parquet(out)


@query("src1_read_partitions", """
SELECT 'user-' || user_id AS stream_id, event_type AS "partition", max(event_id) AS offset_num,
       max(ts) + INTERVAL 3600 SECOND AS expires_at
FROM events GROUP BY user_id, event_type""")
def _(spark, sf_dir):
    # The grain is stream and partition; expiry travels with the payload.
    log = event_log(spark, sf_dir).withColumn("partition", F.col("pipeline_id"))
    keys = ["stream_id", "partition"]
    last = log.groupBy(*keys).agg(F.max("seq").alias("offset_num"), F.max("updated_at").alias("updated_at"))
    table = ops.stamp_expiry(last, 3600).select(
        "*",
        F.lit("all").alias("pipeline_id"),
        F.col("offset_num").cast("string").alias("offset_json"),
        F.lit(None).cast("string").alias("metadata"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )
    path = scratch_path(spark, "files")
    sources.write_checkpoint_files(table, path, key_cols=keys)
    good, _ = sources.read_checkpoint_files(spark, path, key_cols=keys)
    return good.select(*keys, "offset_num", "expires_at")


@query("src2_write_checkpoint_files", f"""WITH {HALVES}, {STATE_PART}
SELECT {_SQL_FIELDS} FROM old WHERE pipeline_id <> 'view'
UNION ALL SELECT {_SQL_FIELDS} FROM ev_state WHERE pipeline_id = 'view'""")
def _(spark, sf_dir):
    # One pipeline is written again; the others stay as they were at half time.
    path = scratch_path(spark, "files")
    half = first_half(spark, sf_dir).withColumn("created_at", F.col("updated_at"))
    sources.write_checkpoint_files(half, path)
    now = ops.by_group(ops.compact_log(event_log(spark, sf_dir)), "pipeline_id", "view")
    sources.write_checkpoint_files(now, path)
    good, _ = sources.read_checkpoint_files(spark, path)
    return good.select(*_FIELDS)


@query("src3_ensure_table", f"""WITH {EV_STATE}
SELECT pipeline_id, stream_id, offset_json, offset_num, metadata, updated_at FROM ev_state""")
def _(spark, sf_dir):
    location = scratch_path(spark, "table")
    name = location.rsplit("/", 1)[1].replace("-", "_")
    sources.ensure_table(spark, name, location=location)
    rows = ops.compact_log(event_log(spark, sf_dir))
    typed = [
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in PROGRESS
    ]
    rows.select(*typed).write.insertInto(name)
    return sources.ensure_table(spark, name, location=location).select(*_FIELDS)


@query("src4_append_log", f"""WITH {EV_LOG}
SELECT pipeline_id, stream_id, offset_json, offset_num, metadata, updated_at, op, seq FROM ev_log""")
def _(spark, sf_dir):
    path = scratch_path(spark, "log")
    log = event_log(spark, sf_dir)
    sources.append_log(log.where(F.col("op") == "save"), path)
    sources.append_log(log.where(F.col("op") == "delete"), path)
    return sources.read_log(spark, path).select(*_FIELDS, "op", "seq")


@query("src5_read_payload_table", f"""WITH {EV_STATE}
SELECT pipeline_id || '::' || stream_id AS key, stream_id, offset_json, offset_num, updated_at
FROM ev_state""")
def _(spark, sf_dir):
    path = scratch_path(spark, "payloads")
    keyed = ops.with_key(ops.compact_log(event_log(spark, sf_dir)), "double_colon")
    ops.encode_payloads(keyed).select("key", "data").write.parquet(path)
    good, _ = sources.read_payload_table(spark.read.parquet(path))
    return good.select("key", "stream_id", "offset_json", "offset_num", "updated_at")


@query("table_save_compact_delete", f"""WITH {HALVES}, saved AS (
    SELECT *, row_number() OVER (PARTITION BY pipeline_id, stream_id ORDER BY seq DESC) AS m
    FROM ev_log WHERE op = 'save' OR updated_at < TIMESTAMP '2024-01-16')
SELECT s.pipeline_id, s.stream_id, s.offset_num, s.seq FROM saved s
WHERE s.m = 1 AND s.op = 'save' AND NOT EXISTS (
    SELECT 1 FROM ev_log d WHERE d.pipeline_id = s.pipeline_id AND d.stream_id = s.stream_id
    AND d.op = 'delete' AND d.updated_at >= TIMESTAMP '2024-01-16' AND d.seq > s.seq)""")
def _(spark, sf_dir):
    table = ProgressTable(spark, scratch_path(spark, "progress"))
    log = event_log(spark, sf_dir)
    table.append(log.where(F.col("updated_at") < F.lit(HALF).cast("timestamp")))
    table.save(second_half(spark, sf_dir))
    table.compact()
    table.delete(second_half(spark, sf_dir, "delete"), "2024-02-01")
    return table.read().select("pipeline_id", "stream_id", "offset_num", "seq")
