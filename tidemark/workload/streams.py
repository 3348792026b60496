"""STR and EXT queries: the event table read as a stream, checked against its batch twin."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark import sources, streaming
from tidemark.plans import scratch_path
from tidemark.table import ProgressTable
from tidemark.workload.logs import EV_LOG, EV_STATE, as_event_log
from tidemark.workload.lookups import RESUMED, source, stopped
from tidemark.workload.registry import query


#: Micro-batches of each stream, and files of each.
BATCHES = 5
FILES = 8


def event_stream(spark, sf_dir):
    # Numbered by a remainder of the event's number, so that each micro-batch holds events from
    # all over the order; a batch is several files, each the work of a task of its own.
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    path = scratch_path(spark, "arrivals")
    batch = F.pmod(F.col("event_id"), F.lit(BATCHES))
    spread = batch * FILES + F.pmod(F.xxhash64("event_id"), F.lit(FILES))
    events.repartitionByRange(BATCHES * FILES, spread).write.parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", FILES).parquet(path)


def run_to_end(writer) -> None:
    """Work through what is there and stop."""
    running = writer.trigger(availableNow=True).start()
    running.awaitTermination()


@contextmanager
def state_settings(spark):
    """RocksDB state, which need not fit into the memory of the executors."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(
        name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
    try:
        yield
    finally:
        spark.conf.set(name, before)


@query("str1_stream_upsert", f"""WITH {EV_STATE}
SELECT pipeline_id, stream_id, offset_json, offset_num, metadata, updated_at, seq FROM ev_state""")
def _(spark, sf_dir):
    table = ProgressTable(spark, scratch_path(spark, "progress"))
    log = as_event_log(event_stream(spark, sf_dir))
    run_to_end(streaming.stream_upsert(log, table, scratch_path(spark, "state"), compact_every=2))
    return table.read().select(
        "pipeline_id", "stream_id", "offset_json", "offset_num", "metadata", "updated_at", "seq"
    )


@query("str1_stream_upsert_buckets", f"""WITH {EV_STATE}
SELECT pipeline_id, stream_id, offset_json, offset_num, metadata, updated_at, seq FROM ev_state""")
def _(spark, sf_dir):
    # Batches beside a snapshot in buckets, twice folded into it.
    table = ProgressTable(spark, scratch_path(spark, "progress"), buckets=8)
    log = as_event_log(event_stream(spark, sf_dir))
    run_to_end(streaming.stream_upsert(log, table, scratch_path(spark, "state"), compact_every=2))
    return table.read().select(
        "pipeline_id", "stream_id", "offset_json", "offset_num", "metadata", "updated_at", "seq"
    )


@query("str2_track", """
SELECT event_type AS pipeline_id, 'user-' || user_id AS stream_id,
       max(event_id) AS offset_num, max(ts) AS updated_at
FROM events GROUP BY event_type, user_id""")
def _(spark, sf_dir):
    table = ProgressTable(spark, scratch_path(spark, "progress"))
    log = as_event_log(event_stream(spark, sf_dir))
    run_to_end(
        streaming.track(log, table, "offset_num", "updated_at", scratch_path(spark, "state"))
    )
    return table.read().select("pipeline_id", "stream_id", "offset_num", "updated_at")


@query("str3_resume_stream", RESUMED)
def _(spark, sf_dir):
    saved = scratch_path(spark, "stopped")
    stopped(spark, sf_dir).write.parquet(saved)
    records = event_stream(spark, sf_dir).select(
        F.col("event_type").alias("pipeline_id"),
        F.concat(F.lit("user-"), F.col("user_id")).alias("stream_id"),
        "event_id",
        "value",
    )
    unread = streaming.resume_stream(records, spark.read.parquet(saved), "event_id")
    path = scratch_path(spark, "unread")
    run_to_end(streaming.stream_append(unread, path, scratch_path(spark, "state")))
    return spark.read.schema(source(spark, sf_dir).schema).parquet(path)


@query("str3_resume_batches", RESUMED)
def _(spark, sf_dir):
    # The offsets are those of an aggregate, computed anew beside each batch.
    records = event_stream(spark, sf_dir).select(
        F.col("event_type").alias("pipeline_id"),
        F.concat(F.lit("user-"), F.col("user_id")).alias("stream_id"),
        "event_id",
        "value",
    )
    path = scratch_path(spark, "unread")

    def write(unread, batch_id):
        unread.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    run_to_end(
        streaming.resume_to(
            records, stopped(spark, sf_dir), "event_id", write, scratch_path(spark, "state")
        )
    )
    return spark.read.schema(source(spark, sf_dir).schema).parquet(path).drop("batch_id")


@query("str4_latest_stream", f"""WITH {EV_LOG}
SELECT pipeline_id, stream_id, offset_num, op, seq FROM (
    SELECT *, row_number() OVER (PARTITION BY pipeline_id, stream_id ORDER BY seq DESC) AS n
    FROM ev_log) WHERE n = 1""")
def _(spark, sf_dir):
    log = as_event_log(event_stream(spark, sf_dir))
    live = streaming.latest_stream(
        log.select("pipeline_id", "stream_id", "offset_num", "op", "seq")
    )
    path = scratch_path(spark, "latest")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    with state_settings(spark):
        run_to_end(
            streaming.stream_to(live, write, scratch_path(spark, "state")).outputMode("update")
        )
    return ops.latest_by_arrival(spark.read.parquet(path).drop("batch_id"))


@query("str5_ttl_state", f"""
WITH {EV_STATE}, now AS (SELECT max(ts) AS last FROM events)
SELECT pipeline_id, stream_id, offset_num, updated_at + INTERVAL 172800 SECOND AS expires_at
FROM ev_state, now WHERE updated_at + INTERVAL 172800 SECOND > now.last""")
def _(spark, sf_dir):
    wheel = streaming.ExpiryWheel(spark, scratch_path(spark, "wheel"), step_seconds=21600)
    log = as_event_log(event_stream(spark, sf_dir))
    run_to_end(streaming.wheel_state(log, wheel, 172800, scratch_path(spark, "state"), fold_every=2))
    now = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.max("ts").cast("timestamp").alias("at"))
    return wheel.live(now.scalar()).select("pipeline_id", "stream_id", "offset_num", "expires_at")


_CHANGE_EVENTS = f"""WITH {EV_LOG}
SELECT pipeline_id, stream_id, '{{"event":"checkpoint_saved","pipeline_id":' || to_json(pipeline_id)
       || ',"stream_id":' || to_json(stream_id) || ',"offset":' || offset_json || '}}' AS event
FROM ev_log WHERE op = 'save'"""


@query("str6_change_events", _CHANGE_EVENTS)
def _(spark, sf_dir):
    events = streaming.change_events(as_event_log(event_stream(spark, sf_dir)))
    path = scratch_path(spark, "notified")
    run_to_end(streaming.stream_append(events, path, scratch_path(spark, "state")))
    return spark.read.parquet(path)


@query("str6_change_events_batch", _CHANGE_EVENTS)
def _(spark, sf_dir):
    return streaming.change_events(as_event_log(spark.read.parquet(f"{sf_dir}/events.parquet")))


@query("str7_stream_append", f"""WITH {EV_LOG}
SELECT pipeline_id, stream_id, offset_json, offset_num, metadata, created_at, updated_at, op, seq
FROM ev_log""")
def _(spark, sf_dir):
    log = as_event_log(event_stream(spark, sf_dir))
    path = scratch_path(spark, "log")
    run_to_end(streaming.stream_append(log, path, scratch_path(spark, "state"), ["pipeline_id"]))
    return sources.read_log(spark, path, log.schema).select(*log.columns)


@query("ext1_stream_to", """
SELECT event_type AS pipeline_id, count(*) AS n_events, max(event_id) AS offset_num
FROM events GROUP BY event_type""")
def _(spark, sf_dir):
    path = scratch_path(spark, "custom")

    def write(batch, batch_id):
        (
            batch.groupBy("pipeline_id")
            .agg(F.count(F.lit(1)).alias("n"), F.max("offset_num").alias("offset_num"))
            .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        )

    log = as_event_log(event_stream(spark, sf_dir))
    run_to_end(streaming.stream_to(log, write, scratch_path(spark, "state")))
    return spark.read.parquet(path).groupBy("pipeline_id").agg(
        F.sum("n").alias("n_events"), F.max("offset_num").alias("offset_num")
    )
