"""Changes to small tables, against dictionaries, with and without broadcasts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import operators as ops

TABLE = "pipeline_id string, stream_id string, offset_json string, offset_num long, metadata string, updated_at timestamp"
OLD = dt.datetime(2024, 3, 1, 8)
NEW = dt.datetime(2024, 3, 2, 9, 30)


@pytest.fixture(params=["broadcast", "shuffle"])
def joins(request, spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    if request.param == "shuffle":
        spark.conf.set(name, "-1")
    yield request.param
    spark.conf.set(name, before)


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [
            ("pipe1", "stream1", "10", 10, '{"env":"prod"}', OLD),
            ("pipe1", "stream2", "20", 20, None, OLD),
            ("pipe2", "stream1", "99", 99, "{}", OLD),
        ],
        TABLE,
    )


@pytest.fixture
def changes(spark):
    return spark.createDataFrame(
        [
            ("pipe1", "stream1", "11", 11, "{}", NEW, 5),
            ("pipe1", "stream1", "12", 12, None, NEW, 9),
            ("pipe3", "stream7", "1", 1, '{"a":1}', NEW, 2),
            ("pipe1", "stream1", "7", 7, "{}", NEW, 1),
        ],
        TABLE + ", seq long",
    )


def keys(spark, *pairs):
    return spark.createDataFrame(list(pairs), "pipeline_id string, stream_id string")


def test_upsert_replaces_whole_rows_and_the_last_change_wins(table, changes, joins, rows_of):
    got = rows_of(ops.upsert(table, changes), "pipeline_id", "stream_id", "offset_num", "metadata")
    assert got == [
        ("pipe1", "stream1", 12, None),
        ("pipe1", "stream2", 20, None),
        ("pipe2", "stream1", 99, "{}"),
        ("pipe3", "stream7", 1, '{"a":1}'),
    ]


def test_upsert_twice_is_upsert_once(table, changes, joins, rows_of):
    once = ops.upsert(table, changes)
    assert rows_of(ops.upsert(once, changes)) == rows_of(once)


def test_upsert_of_nothing_and_into_nothing(table, changes, joins, rows_of):
    assert rows_of(ops.upsert(table, changes.limit(0))) == rows_of(table)
    assert ops.upsert(table.limit(0), changes).count() == 2


def test_merge_keeps_other_columns_and_a_new_null_wins(table, changes, joins, rows_of):
    got = rows_of(
        ops.merge_columns(table, changes, ["offset_num", "metadata"]),
        "pipeline_id", "stream_id", "offset_json", "offset_num", "metadata", "updated_at",
    )
    assert got == [
        ("pipe1", "stream1", "10", 12, None, OLD),
        ("pipe1", "stream2", "20", 20, None, OLD),
        ("pipe2", "stream1", "99", 99, "{}", OLD),
        ("pipe3", "stream7", None, 1, '{"a":1}', None),
    ]


def test_merge_keeps_an_old_expiry(spark, joins, rows_of):
    table = spark.createDataFrame([("p", 1, 50)], "stream_id string, offset_num long, expires_at long")
    changes = spark.createDataFrame([("p", 2, 1)], "stream_id string, offset_num long, seq long")
    merged = ops.merge_columns(table, changes, ["offset_num"], ["stream_id"])
    assert rows_of(merged) == [("p", 2, 50)]
    put = ops.upsert(table, changes, ["stream_id"])
    assert rows_of(put) == [("p", 2, None)]


def test_delete_and_report(spark, table, joins, rows_of):
    asked = keys(spark, ("pipe1", "stream1"), ("nope", "stream1"))
    left = ops.delete_keys(table, asked)
    assert rows_of(left, "pipeline_id", "stream_id") == [("pipe1", "stream2"), ("pipe2", "stream1")]
    assert rows_of(ops.delete_report(table, asked)) == [
        ("nope", "stream1", False), ("pipe1", "stream1", True),
    ]
    assert rows_of(ops.delete_keys(left, asked)) == rows_of(left)
    twice = table.unionByName(table)
    assert ops.delete_report(twice, asked).count() == 2


def test_update_offset_touches_two_columns_of_known_keys(table, changes, joins, rows_of):
    got = rows_of(
        ops.update_offset(table, changes, NEW),
        "pipeline_id", "stream_id", "offset_json", "offset_num", "metadata", "updated_at",
    )
    assert got == [
        ("pipe1", "stream1", "12", 12, '{"env":"prod"}', NEW),
        ("pipe1", "stream2", "20", 20, None, OLD),
        ("pipe2", "stream1", "99", 99, "{}", OLD),
    ]


def test_clear(table, rows_of):
    assert rows_of(ops.clear(table)) == []
    assert ops.clear(table).columns == table.columns
    assert rows_of(ops.clear(table, "pipe1"), "pipeline_id") == [("pipe2",)]


def test_delete_history_by_key_and_time(spark, joins):
    log = spark.range(100).selectExpr(
        "CASE WHEN id % 10 < 7 THEN 'hot' ELSE 'cold' END AS stream_id", "id AS seq",
        "timestamp_seconds(id) AS updated_at",
    )
    gone = spark.createDataFrame([("hot",), ("unknown",)], "stream_id string")
    start, stop = dt.datetime(1970, 1, 1, 0, 0, 10), dt.datetime(1970, 1, 1, 0, 1)
    left = ops.delete_history(log, gone, ["stream_id"], start, stop)
    assert sorted(r.seq for r in left.collect()) == [
        i for i in range(100) if i % 10 >= 7 or not 10 <= i <= 60
    ]
    assert left.columns == log.columns
    all_gone = ops.delete_history(log, gone, ["stream_id"])
    assert sorted(r.seq for r in all_gone.collect()) == [i for i in range(100) if i % 10 >= 7]


def test_replace_all_removes_every_copy(spark, joins, rows_of):
    # A key with a third of all rows, all of them alike.
    copies = spark.range(300).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 50) END AS stream_id", "1L AS offset_num"
    )
    changes = spark.createDataFrame(
        [("hot", 2, 1), ("hot", 3, 2), ("s4", 9, 1)], "stream_id string, offset_num long, seq long"
    )
    got = ops.replace_all(copies, changes, ["stream_id"])
    kept = copies.where("stream_id NOT IN ('hot', 's4')")
    expected = sorted(rows_of(kept) + [("hot", 3), ("s4", 9)])
    assert rows_of(got) == expected


def test_tombstones_remove_keys_and_leave_other_groups(spark, rows_of):
    log = spark.createDataFrame(
        [("etl", "s1", 42, "save", 1), ("etl", "s2", 99, "save", 2),
         ("etl", "s1", None, "delete", 3), ("other", "s9", 1, "save", 4)],
        "pipeline_id string, stream_id string, offset_num long, op string, seq long",
    )
    table = ops.compact_log(log)
    assert rows_of(table, "pipeline_id", "stream_id", "offset_num") == [
        ("etl", "s2", 99), ("other", "s9", 1),
    ]
    assert rows_of(ops.by_group(table, "pipeline_id", "etl"), "stream_id") == [("s2",)]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_one_result_at_every_size(spark, rows_of, threshold):
    """Repeated and null keys, with sides that Spark broadcasts and sides that it does not."""
    table = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), (None, 3, "z"), ("b", 4, "w")], "k string, v long, m string"
    )
    changes = spark.createDataFrame(
        [("a", 10, "c", 1), ("a", 11, None, 2), ("new", 13, "d", 1)],
        "k string, v long, m string, seq long",
    )
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, threshold)
    try:
        put = [(None, 3, "z"), ("a", 11, None), ("b", 4, "w"), ("new", 13, "d")]
        assert rows_of(ops.upsert(table, changes, ["k"])) == put
        assert rows_of(ops.replace_all(table, changes, ["k"])) == put
        assert rows_of(ops.merge_columns(table, changes, ["v"], ["k"])) == [
            (None, 3, "z"), ("a", 11, "x"), ("a", 11, "y"), ("b", 4, "w"), ("new", 13, None),
        ]
        again = ops.merge_columns(ops.merge_columns(table, changes, ["v"], ["k"]), changes, ["v"], ["k"])
        assert again.count() == 5
        assert rows_of(ops.delete_keys(table, changes, ["k"])) == [(None, 3, "z"), ("b", 4, "w")]
        assert rows_of(ops.delete_history(table, changes, ["k"])) == [(None, 3, "z"), ("b", 4, "w")]
        with pytest.raises(Exception, match="without a key"):
            ops.upsert(table, table.withColumn("seq", F.lit(1)), ["k"]).collect()
        asked = changes.select("k").distinct()
        assert rows_of(ops.delete_report(table, asked, ["k"])) == [
            ("a", True), ("new", False),
        ]
    finally:
        spark.conf.set(name, before)


def test_clear_keeps_rows_without_a_group(spark, rows_of):
    table = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "g string, v long")
    assert rows_of(ops.clear(table, "a", "g")) == [(None, 2), ("b", 3)]
