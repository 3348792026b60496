"""Streams in several micro-batches against their batch twins."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import ProgressTable, streaming
from tidemark import operators as ops
from tidemark.plans import scratch_path
from tidemark.workload.streams import run_to_end, state_settings

EVENT = "pipeline_id string, stream_id string, offset_json string, offset_num long, updated_at timestamp, op string, seq long"


@pytest.fixture(scope="module")
def log_path(spark):
    """Six files of events, to be read two at a time; one stream has a third of them."""
    path = scratch_path(spark, "events")
    rows = spark.range(0, 600, 1, 6).selectExpr(
        "concat('p', id % 2) AS pipeline_id",
        "IF(id % 3 = 0, 'hot', concat('s', id % 7)) AS stream_id",
        "CAST(id AS STRING) AS offset_json", "id AS offset_num",
        "timestamp_seconds(1704067200 + id * 60) AS updated_at",
        "IF(id % 10 = 9, 'delete', 'save') AS op", "id AS seq",
    )
    rows.write.parquet(path)
    return path


@pytest.fixture
def batch(spark, log_path):
    return spark.read.schema(EVENT).parquet(log_path)


@pytest.fixture
def stream(spark, log_path):
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 2).parquet(log_path)


@pytest.fixture
def state(spark):
    return scratch_path(spark, "state")


def test_upsert_stream_is_the_compacted_log(spark, stream, batch, path, state, rows_of):
    table = ProgressTable(spark, path)
    run_to_end(streaming.stream_upsert(stream, table, state, compact_every=2))
    columns = ["pipeline_id", "stream_id", "offset_num", "updated_at", "seq"]
    assert rows_of(table.read(), *columns) == rows_of(ops.compact_log(batch), *columns)
    assert len(table.batches()) == 1


def test_a_stream_run_again_from_the_start_changes_nothing(spark, stream, path, state, rows_of):
    table = ProgressTable(spark, path)
    run_to_end(streaming.stream_upsert(stream, table, state))
    first = rows_of(table.read(), "stream_id", "offset_num", "seq")
    run_to_end(streaming.stream_upsert(stream, table, state))
    run_to_end(streaming.stream_upsert(stream, table, scratch_path(spark, "state")))
    assert rows_of(table.read(), "stream_id", "offset_num", "seq") == first


def test_a_replayed_batch_replaces_itself(spark, stream, path, state, rows_of):
    table = ProgressTable(spark, path)
    failures = []

    def fail_once(batch, batch_id):
        if batch_id == 1 and not failures:
            failures.append(batch_id)
            raise RuntimeError("lost")

    def run():
        run_to_end(
            streaming.track(stream, table, "offset_num", "updated_at", state, process=fail_once)
        )

    with pytest.raises(Exception, match="lost"):
        run()
    # The failed batch has not moved any offset.
    assert len(table.batches()) == 1
    run()
    assert len(table.batches()) == 3
    furthest = spark.range(600).selectExpr(
        "concat('p', id % 2) AS p", "IF(id % 3 = 0, 'hot', concat('s', id % 7)) AS s", "id"
    ).groupBy("p", "s").agg(F.max("id"))
    assert rows_of(table.read(), "pipeline_id", "stream_id", "offset_num") == rows_of(furthest)


def test_resumed_stream_is_the_resumed_batch(spark, stream, batch, path, state, rows_of):
    table = batch.where("seq < 200 + length(stream_id) * 40").groupBy("pipeline_id", "stream_id").agg(
        F.max("offset_num").alias("offset_num")
    ).where("stream_id <> 's3'")
    run_to_end(streaming.stream_append(
        streaming.resume_stream(stream, table, "offset_num"), path, state
    ))
    expected = ops.resume(batch, table, "offset_num")
    assert rows_of(spark.read.schema(EVENT).parquet(path)) == rows_of(expected)


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_stream_resumed_by_batches_is_the_resumed_batch(spark, stream, batch, path, state, rows_of, adaptive):
    """Beside an aggregate; one batch fails after it was written, and comes again."""
    table = batch.where("seq < 200 + length(stream_id) * 40").groupBy("pipeline_id", "stream_id").agg(
        F.max("offset_num").alias("offset_num")
    ).where("stream_id <> 's3'")
    calls = []

    def write(unread, batch_id):
        unread.write.mode("overwrite").parquet(f"{path}/b={batch_id}")
        calls.append(batch_id)
        if calls == [0, 1]:
            raise RuntimeError("lost")

    def run():
        run_to_end(streaming.resume_to(stream, table, "offset_num", write, state))

    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        with pytest.raises(Exception, match="lost"):
            run()
        run()
        assert spark.conf.get("spark.sql.adaptive.enabled") == adaptive
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert calls == [0, 1, 1, 2]
    expected = ops.resume(batch, table, "offset_num")
    assert rows_of(spark.read.schema(EVENT).parquet(path).drop("b")) == rows_of(expected)


def test_offsets_without_an_order_are_refused_in_batches(spark, stream, state):
    table = spark.sql("SELECT 'p0' AS pipeline_id, 'hot' AS stream_id, NULL AS offset_num, '\"x\"' AS offset_json")
    with pytest.raises(Exception, match="no order to resume"):
        run_to_end(streaming.resume_to(stream, table, "offset_num", lambda rows, n: rows.count(), state))
    with pytest.raises(Exception, match="has no order"):
        run_to_end(streaming.resume_to(stream, table, "offset_json", lambda rows, n: rows.count(), f"{state}-2"))


def test_latest_stream_is_the_latest_batch(spark, stream, batch, path, state, rows_of):
    def write(rows, batch_id):
        rows.write.mode("overwrite").parquet(f"{path}/b={batch_id}")

    run_to_end(
        streaming.stream_to(streaming.latest_stream(stream), write, state).outputMode("complete")
    )
    last = max(int(r.b) for r in spark.read.parquet(path).select("b").distinct().collect())
    assert rows_of(spark.read.schema(EVENT).parquet(f"{path}/b={last}")) == rows_of(
        ops.latest_by_arrival(batch)
    )


def test_change_events(spark, stream, batch, path, state, rows_of):
    run_to_end(streaming.stream_append(streaming.change_events(stream), path, state))
    written = spark.read.parquet(path)
    assert rows_of(written, "event") == rows_of(streaming.change_events(batch), "event")
    assert written.count() == 540
    event = json.loads(written.where("event LIKE '%\"offset\":42}'").first().event)
    assert event == {"event": "checkpoint_saved", "pipeline_id": "p0", "stream_id": "hot", "offset": 42}


def test_append_and_custom_writer(spark, stream, batch, path, state, rows_of):
    run_to_end(streaming.stream_append(stream, path, state, ["pipeline_id"]))
    assert rows_of(spark.read.schema(EVENT).parquet(path)) == rows_of(batch)
    seen = []
    run_to_end(streaming.stream_to(
        stream, lambda rows, n: seen.append((n, rows.count())), scratch_path(spark, "state")
    ))
    assert seen == [(0, 200), (1, 200), (2, 200)]


def test_state_that_expires(spark, path, state):
    """Late saves, deletes, ties in time, events without a time; one batch comes twice."""
    start = 1_700_000_000
    batches = [
        [("kept", 1, 0, "save", 1), ("tied", 1, 60, "save", 2), ("gone", 1, 60, "save", 3)],
        [("tied", 2, 60, "save", 5), ("gone", 2, 90, "delete", 6), ("kept", 9, 30, "save", 4), ("none", 1, None, "save", 7)],
        [("tied", 7, 300, "save", 4), ("over", 1, -5000, "save", 8), ("gone", 3, 80, "save", 2)],
    ]
    source, aside = f"{path}/source", []
    for n, rows in enumerate(batches):
        spark.createDataFrame(
            [("p", k, o, None if t is None else start + t, op, seq) for k, o, t, op, seq in rows],
            "pipeline_id string, stream_id string, offset_num long, t long, op string, seq long",
        ).withColumn("updated_at", F.timestamp_seconds("t")).drop("t").coalesce(1).write.parquet(f"{source}/{n}")
    schema = "pipeline_id string, stream_id string, offset_num long, op string, seq long, updated_at timestamp"
    table = ProgressTable(spark, f"{path}/table")
    for n in (0, 1, 2, 2):
        stream = spark.readStream.schema(schema).parquet(f"{source}/[0-{n}]")
        run_to_end(
            streaming.ttl_state(
                stream, table, 1800, state,
                aside=lambda rows, batch_id: aside.extend(r.stream_id for r in rows.collect()), compact_every=2,
            )
        )
    now = F.timestamp_seconds(F.lit(start + 1000))
    live = streaming.live_state(table, now).select("stream_id", "offset_num", F.unix_seconds("expires_at").alias("e"))
    assert sorted((r.stream_id, r.offset_num, r.e - start) for r in live.collect()) == [
        ("kept", 9, 1830), ("tied", 2, 1860),
    ]
    assert aside == ["none"]


def event_files(spark, folder, batches, start=1_700_000_000):
    """One file per batch of ``stream, offset, seconds, op, seq``."""
    for n, rows in enumerate(batches):
        spark.createDataFrame(
            [("p", k, o, None if t is None else start + t, op, seq) for k, o, t, op, seq in rows],
            "pipeline_id string, stream_id string, offset_num long, t long, op string, seq long",
        ).withColumn("updated_at", F.timestamp_seconds("t")).drop("t").coalesce(1).write.parquet(f"{folder}/{n}")


TIMED = "pipeline_id string, stream_id string, offset_num long, op string, seq long, updated_at timestamp"


@pytest.mark.parametrize("fold_every", [None, 2])
def test_wheel_keeps_what_is_live_and_no_more(spark, path, state, fold_every):
    """A stream past the time to live: late saves, deletes, an end that comes before an earlier one."""
    start, ttl = 1_700_000_000, 1800
    batches = [
        [("kept", 1, 0, "save", 1), ("tied", 1, 60, "save", 2), ("gone", 1, 60, "save", 3), ("back", 1, 600, "save", 9)],
        [("tied", 2, 60, "save", 5), ("gone", 2, 90, "delete", 6), ("kept", 9, 30, "save", 4), ("back", 2, 30, "save", 10)],
        [("tied", 7, 300, "save", 4), ("over", 1, -5000, "save", 8), ("gone", 3, 80, "save", 2)],
        [("late", 1, 2000, "save", 20)],
        [("late", 2, 9000, "save", 21), ("new", 1, 8000, "save", 22)],
    ]
    wheel = streaming.ExpiryWheel(spark, f"{path}/wheel", step_seconds=60)
    event_files(spark, f"{path}/source", batches)

    def held(at):
        now = F.timestamp_seconds(F.lit(start + at))
        return sorted((r.stream_id, r.offset_num) for r in wheel.live(now).collect())

    def run(n):
        stream = spark.readStream.schema(TIMED).parquet(f"{path}/source/[0-{n}]")
        run_to_end(streaming.wheel_state(stream, wheel, ttl, state, fold_every=fold_every))

    for n in (0, 1, 2, 2):
        run(n)
    assert held(1000) == [("back", 2), ("kept", 9), ("tied", 2)]
    # The last event of "back" ends before the one it replaced, which must not show again.
    assert held(1840) == [("tied", 2)] and held(1900) == []
    run(3)
    assert held(2000) == [("late", 1)]
    run(4)
    assert held(9000) == [("late", 2), ("new", 1)]
    stored = spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/wheel")
    assert sorted(r.stream_id for r in stored.collect()) == ["late", "new"]


def test_wheel_batches_that_come_again(spark, path):
    """Also one that has replaced the folders it was made of."""
    rows = lambda n: spark.sql(
        f"SELECT 'p' AS pipeline_id, 's' || id AS stream_id, {n} AS offset_num, timestamp'2024-01-01' AS updated_at, "
        f"'save' AS op, {n} AS seq, IF(id = 0, NULL, timestamp'2024-01-02') AS expires_at FROM range({n}, {n + 3})"
    )
    wheel = streaming.ExpiryWheel(spark, path)
    for n in (0, 1, 2, 2):
        wheel.add(rows(n), n, whole=n == 2)
    assert sorted((r.stream_id, r.offset_num) for r in wheel.events().collect()) == [("s0", 0), ("s1", 1), ("s2", 2), ("s3", 2), ("s4", 2)]
    assert wheel.drop_ended("2024-01-01 23:00:00") == 0 and wheel.drop_ended("2025-01-01") == 1
    assert [r.stream_id for r in wheel.live("2025-01-01").collect()] == ["s0"]


def test_wheel_folders_are_one_file_and_none_that_is_over_is_written(spark, path):
    rows = spark.sql(
        "SELECT 'p' AS pipeline_id, 's' || id AS stream_id, id AS offset_num, timestamp'2024-01-01' AS updated_at, "
        "'save' AS op, id AS seq, timestamp_seconds(3600 * (id % 6)) AS expires_at FROM range(120)"
    ).repartition(6)
    wheel = streaming.ExpiryWheel(spark, path)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merging)
    spark.conf.set(merging, "false")
    try:
        wheel.add(rows, 0)
        # The end of hour 2 has come, that of hour 3 has not.
        wheel.add(rows, 1, as_of="1970-01-01 03:59:59")
    finally:
        spark.conf.set(merging, before)
    folders = [{d.name: len(list(d.glob("*.parquet"))) for d in Path(path, f"part={n}").glob("until=*")} for n in (0, 1)]
    assert folders[0] == {f"until={n}": 1 for n in range(6)}
    assert folders[1] == {f"until={n}": 1 for n in range(3, 6)}
    assert wheel.drop_ended("1970-01-01 03:59:59") == 3 and wheel.events().count() == 60


@pytest.mark.parametrize("bad", [("k", 1, 0, "save", None), ("k", 1, 0, "remove", 7), (None, 1, 0, "save", 7)])
@pytest.mark.parametrize("kind", ["upsert", "ttl", "wheel"])
def test_bad_events_fail_their_batch(spark, path, state, kind, bad):
    """Also where a good event of the same key comes later."""
    event_files(spark, f"{path}/source", [[bad, ("k", 2, 60, "save", 9)]])
    stream = spark.readStream.schema(TIMED).parquet(f"{path}/source/0")
    table = ProgressTable(spark, f"{path}/table")
    wheel = streaming.ExpiryWheel(spark, f"{path}/wheel")
    start = {
        "upsert": lambda: streaming.stream_upsert(stream, table, state),
        "ttl": lambda: streaming.ttl_state(stream, table, 60, state),
        "wheel": lambda: streaming.wheel_state(stream, wheel, 60, state),
    }[kind]
    with pytest.raises(Exception, match="an event"):
        run_to_end(start())
    assert not table.batches() and wheel.events().count() == 0
