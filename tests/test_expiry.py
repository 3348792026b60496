import datetime as dt

import pytest

from tidemark import operators as ops

NOW = dt.datetime(2024, 1, 15)
SECOND = dt.timedelta(seconds=1)


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("pipe1", "never", None), ("pipe1", "past", NOW - SECOND), ("pipe1", "edge", NOW),
         ("pipe2", "future", NOW + SECOND)],
        "pipeline_id string, stream_id string, expires_at timestamp",
    )


def streams(df):
    return {r.stream_id for r in df.collect()}


def test_boundary(table):
    assert streams(ops.live(table, NOW)) == {"never", "future"}
    assert streams(ops.live(table, NOW, "live")) == {"never", "edge", "future"}
    assert streams(ops.live(table, "2024-01-15 00:00:00")) == {"never", "future"}
    with pytest.raises(ValueError):
        ops.live(table, NOW, "maybe")


@pytest.mark.parametrize("boundary", ["expired", "live"])
def test_kept_and_purged_make_up_the_table(table, rows_of, boundary):
    kept, purged = ops.purge_expired(table, NOW, boundary)
    assert rows_of(kept) == rows_of(ops.live(table, NOW, boundary))
    assert rows_of(kept.unionByName(purged)) == rows_of(table)


@pytest.mark.parametrize("boundary", ["expired", "live"])
def test_purged_in_one_pass(spark, table, rows_of, path, boundary):
    kept, purged, counts = ops.write_purged(table, path, NOW, boundary)
    for found, expected in zip((kept, purged), ops.purge_expired(table, NOW, boundary)):
        assert found.columns == table.columns and rows_of(found) == rows_of(expected)
    assert counts == {"kept": kept.count(), "purged": purged.count()}
    # Each of the two reads its own folder.
    plan = purged._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(expired" in plan
    with pytest.raises(ValueError):
        ops.write_purged(ops.mark_expired(table, NOW), path, NOW)


def test_purging_reads_the_table_once(spark, table, path):
    source, seen = f"{path}/table", spark.sparkContext.accumulator(0)
    table.repartition(1).write.parquet(source)

    def look(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    ops.write_purged(spark.read.parquet(source).mapInArrow(look, table.schema), f"{path}/out", NOW)
    assert seen.value == 4


def test_list_live(table):
    assert streams(ops.list_live(table, NOW)) == {"never", "future"}
    assert streams(ops.list_live(table, NOW, ("pipeline_id", "pipe2"))) == {"future"}


def test_stamping(spark):
    rows = spark.createDataFrame(
        [("a", 60, NOW), ("b", -1, NOW), ("c", None, NOW), ("d", 0, NOW)],
        "stream_id string, ttl int, updated_at timestamp",
    )
    per_row = {r.stream_id: r.expires_at for r in ops.stamp_expiry(rows, "ttl").collect()}
    assert per_row == {"a": NOW + 60 * SECOND, "b": NOW - SECOND, "c": None, "d": NOW}
    assert streams(ops.live(ops.stamp_expiry(rows, "ttl"), NOW)) == {"a", "c"}
    later = NOW + 5 * SECOND
    fixed = {r.expires_at for r in ops.stamp_expiry(rows, 3600, as_of=later).collect()}
    assert fixed == {later + 3600 * SECOND}
    assert {r.expires_at for r in ops.stamp_expiry(rows, None).collect()} == {None}


def test_every_save_refreshes_and_the_last_one_decides(spark):
    log = spark.createDataFrame(
        [("s", 100, NOW, 1), ("s", 10, NOW + 50 * SECOND, 2)],
        "stream_id string, ttl int, updated_at timestamp, seq long",
    )
    last = ops.latest_by_arrival(ops.stamp_expiry(log, "ttl"), ["stream_id"])
    assert last.first().expires_at == NOW + 60 * SECOND
    assert ops.live(last, NOW + 70 * SECOND).count() == 0
