"""MUT queries: the table at half time, changed by what came after."""

from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark import sources
from tidemark.plans import scratch_path
from tidemark.table import ProgressTable
from tidemark.workload.logs import (
    EV_LOG,
    EV_STATE,
    HALVES,
    STATE_COLUMNS,
    event_log,
    first_half,
    late_deletes,
    second_half,
)
from tidemark.workload.registry import query

_COLUMNS = ", ".join(STATE_COLUMNS)


def _and_deleted(select: str, tables: str = HALVES) -> str:
    """The rows of a query without those whose key is deleted in the end."""
    return f"""WITH {tables}
SELECT * FROM ({select}) r WHERE NOT EXISTS (
    SELECT 1 FROM late_gone g WHERE g.pipeline_id = r.pipeline_id AND g.stream_id = r.stream_id)"""


_UPSERTED = _and_deleted(f"""
SELECT {_COLUMNS} FROM old o WHERE NOT EXISTS (
    SELECT 1 FROM late l WHERE l.pipeline_id = o.pipeline_id AND l.stream_id = o.stream_id)
UNION ALL SELECT {_COLUMNS} FROM late""")


@query("mut1_upsert", _UPSERTED)
def _(spark, sf_dir):
    put = ops.upsert(first_half(spark, sf_dir), second_half(spark, sf_dir))
    return ops.delete_keys(put, late_deletes(spark, sf_dir))


@query("mut2_merge_columns", _and_deleted("""
SELECT coalesce(o.pipeline_id, l.pipeline_id) AS pipeline_id,
       coalesce(o.stream_id, l.stream_id) AS stream_id,
       o.offset_json,
       CASE WHEN l.seq IS NOT NULL THEN l.offset_num ELSE o.offset_num END AS offset_num,
       CASE WHEN l.seq IS NULL THEN o.metadata WHEN l.seq % 3 = 0 THEN NULL ELSE l.metadata END
           AS metadata,
       o.updated_at
FROM old o FULL JOIN late l ON o.pipeline_id = l.pipeline_id AND o.stream_id = l.stream_id"""))
def _(spark, sf_dir):
    changes = second_half(spark, sf_dir).withColumn(
        "metadata", F.when(F.col("seq") % 3 != 0, F.col("metadata"))
    )
    merged = ops.merge_columns(first_half(spark, sf_dir), changes, ["offset_num", "metadata"])
    return ops.delete_keys(merged, late_deletes(spark, sf_dir))


@query("mut3_delete_keys", f"""WITH {HALVES}
SELECT {_COLUMNS} FROM old o WHERE NOT EXISTS (
    SELECT 1 FROM gone g WHERE g.pipeline_id = o.pipeline_id AND g.stream_id = o.stream_id)""")
def _(spark, sf_dir):
    return ops.delete_keys(first_half(spark, sf_dir), second_half(spark, sf_dir, "delete"))


@query("mut4_delete_report", f"""WITH {HALVES}
SELECT g.pipeline_id, g.stream_id, o.offset_num IS NOT NULL AS deleted
FROM gone g LEFT JOIN old o ON g.pipeline_id = o.pipeline_id AND g.stream_id = o.stream_id""")
def _(spark, sf_dir):
    requested = second_half(spark, sf_dir, "delete").select("pipeline_id", "stream_id").distinct()
    return ops.delete_report(first_half(spark, sf_dir), requested)


_HISTORY_LEFT = f"""WITH {HALVES}
SELECT pipeline_id, stream_id, offset_num, op, seq, updated_at FROM ev_log e
WHERE NOT (EXISTS (SELECT 1 FROM gone g
                   WHERE g.pipeline_id = e.pipeline_id AND g.stream_id = e.stream_id)
           AND e.updated_at BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20')"""


@query("mut5_delete_history", _HISTORY_LEFT)
def _(spark, sf_dir):
    log = event_log(spark, sf_dir).select(
        "pipeline_id", "stream_id", "offset_num", "op", "seq", "updated_at"
    )
    keys = second_half(spark, sf_dir, "delete")
    return ops.delete_history(log, keys, start="2024-01-05", stop="2024-01-20")


@query("mut5_delete_history_files", _HISTORY_LEFT)
def _(spark, sf_dir):
    log = event_log(spark, sf_dir).select(
        "pipeline_id", "stream_id", "offset_num", "op", "seq", "updated_at"
    )
    path = scratch_path(spark, "log")
    # A log grows in time order: each file holds some days.
    log.repartitionByRange(F.to_date("updated_at")).write.parquet(path)
    keys = second_half(spark, sf_dir, "delete")
    sources.delete_history_files(
        spark, path, keys, start="2024-01-05", stop="2024-01-20", schema=log.schema
    )
    return sources.read_log(spark, path, log.schema)


@query("mut6_clear_pipeline", f"""WITH {EV_STATE}
SELECT pipeline_id, stream_id, offset_num FROM ev_state WHERE pipeline_id <> 'error'""")
def _(spark, sf_dir):
    table = ops.compact_log(event_log(spark, sf_dir)).select("pipeline_id", "stream_id", "offset_num")
    return ops.clear(table, "error")


@query("mut6_clear_all", f"""WITH {EV_STATE}
SELECT pipeline_id, count(*) AS n_before, CAST(0 AS BIGINT) AS n_left FROM ev_state GROUP BY pipeline_id""")
def _(spark, sf_dir):
    # What a stored table holds before and after.
    table = ProgressTable(spark, scratch_path(spark, "progress"))
    log = event_log(spark, sf_dir)
    table.append(log)
    before = ops.count_checkpoints(table.read(), "pipeline_id")
    last = log.agg(F.max("seq").alias("seq"))
    table.clear("2024-02-01", seq=last.first().seq + 1)
    after = ops.count_checkpoints(table.read(), "pipeline_id").withColumnRenamed("n_checkpoints", "n_left")
    return before.withColumnRenamed("n_checkpoints", "n_before").join(after, "pipeline_id", "left").select(
        "pipeline_id", "n_before", F.coalesce("n_left", F.lit(0)).cast("bigint").alias("n_left")
    )


@query("mut7_update_offset", _and_deleted("""
SELECT o.pipeline_id, o.stream_id,
       CASE WHEN l.seq IS NOT NULL THEN l.offset_json ELSE o.offset_json END AS offset_json,
       CASE WHEN l.seq IS NOT NULL THEN l.offset_num ELSE o.offset_num END AS offset_num,
       o.metadata,
       CASE WHEN l.seq IS NOT NULL THEN TIMESTAMP '2024-02-01' ELSE o.updated_at END AS updated_at
FROM old o LEFT JOIN late l ON o.pipeline_id = l.pipeline_id AND o.stream_id = l.stream_id"""))
def _(spark, sf_dir):
    moved = ops.update_offset(
        first_half(spark, sf_dir), second_half(spark, sf_dir), as_of="2024-02-01"
    )
    return ops.delete_keys(moved, late_deletes(spark, sf_dir))


@query("mut8_replace_all", _and_deleted(f"""
SELECT {_COLUMNS} FROM copies c WHERE NOT EXISTS (
    SELECT 1 FROM late l WHERE l.pipeline_id = c.pipeline_id AND l.stream_id = c.stream_id)
UNION ALL SELECT {_COLUMNS} FROM late""", f"""{HALVES}, copies AS (
    SELECT e.* FROM ev_log e JOIN old o ON e.pipeline_id = o.pipeline_id AND e.stream_id = o.stream_id
    WHERE e.updated_at < TIMESTAMP '2024-01-16' AND e.op = 'save')"""))
def _(spark, sf_dir):
    # Every save so far of the keys that are there at half time: a table that repeats keys.
    saves = event_log(spark, sf_dir).where("updated_at < '2024-01-16' AND op = 'save'")
    known = first_half(spark, sf_dir).select("pipeline_id", "stream_id")
    copies = saves.join(known, ["pipeline_id", "stream_id"], "left_semi").select(*STATE_COLUMNS)
    put = ops.replace_all(copies, second_half(spark, sf_dir))
    return ops.delete_keys(put, late_deletes(spark, sf_dir))


@query("mut9_compact_log", f"""WITH {EV_STATE}
SELECT pipeline_id, stream_id, offset_json, offset_num, metadata, created_at, updated_at, op, seq
FROM ev_state""")
def _(spark, sf_dir):
    return ops.compact_log(event_log(spark, sf_dir))


@query("mut9_compact_log_narrow", f"""WITH {EV_LOG}
SELECT pipeline_id, stream_id, offset_num, updated_at FROM (
    SELECT *, row_number() OVER (PARTITION BY pipeline_id, stream_id ORDER BY seq DESC) AS n
    FROM ev_log) WHERE n = 1 AND op <> 'delete'""")
def _(spark, sf_dir):
    # Fixed-width columns only: a hash aggregate.
    log = event_log(spark, sf_dir).select(
        "pipeline_id", "stream_id", "offset_num", "updated_at", "op", "seq"
    )
    return ops.compact_log(log).drop("op", "seq")
