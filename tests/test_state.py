"""Current state from logs, against plain replays of small ones."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark.plans import newest_rows

SCHEMA = "pipeline_id string, stream_id string, offset_num long, metadata string, op string, version long, seq long"


def replay(events):
    table = {}
    for p, s, offset, metadata, op, version, seq in sorted(events, key=lambda e: e[6]):
        if op == "delete":
            table.pop((p, s), None)
        else:
            table[p, s] = (offset, metadata)
    return sorted((p, s, o, m) for (p, s), (o, m) in table.items())


def random_log(seed, n=400):
    rng = random.Random(seed)
    order = rng.sample(range(10 * n), n)
    return [
        (f"p{rng.randrange(3)}", f"s{rng.randrange(20)}", rng.randrange(1000),
         rng.choice([None, "{}", '{"a":1}']), rng.choice(["save", "save", "save", "delete"]),
         rng.randrange(40), seq)
        for seq in order
    ]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10_000))
def test_compacted_log_is_the_replayed_table(spark, seed):
    events = random_log(seed)
    log = spark.createDataFrame(events, SCHEMA).repartition(5)
    got = ops.compact_log(log).select("pipeline_id", "stream_id", "offset_num", "metadata")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(replay(events), key=repr)


def test_narrow_and_wide_rows_agree(spark, rows_of):
    log = spark.createDataFrame(random_log(7), SCHEMA)
    columns = ["pipeline_id", "stream_id", "offset_num", "version", "seq"]
    wide = ops.latest_by_arrival(log)
    narrow = ops.latest_by_arrival(log.select(*columns))
    assert rows_of(wide, *columns) == rows_of(narrow)
    assert "HashAggregate" in narrow._jdf.queryExecution().executedPlan().toString()


def test_a_null_in_the_last_event_is_kept(spark):
    log = spark.createDataFrame(
        [("p", "s", 1, "{}", "save", 1, 1), ("p", "s", None, None, "save", 2, 2)], SCHEMA
    )
    for columns in (log.columns, ["pipeline_id", "stream_id", "offset_num", "seq"]):
        assert ops.latest_by_arrival(log.select(*columns)).first().offset_num is None


def test_highest_version_wins_however_late(spark, rows_of):
    events = random_log(3)
    expected = {}
    for p, s, offset, _, _, version, seq in events:
        expected[p, s] = max(expected.get((p, s), (-1, -1, -1)), (version, seq, offset))
    got = ops.latest_by_version(spark.createDataFrame(events, SCHEMA), version="version")
    assert rows_of(got, "pipeline_id", "stream_id", "version", "seq", "offset_num") == sorted(
        (*key, *value) for key, value in expected.items()
    )


def test_keep_last_n_with_one_hot_key(spark):
    # One key holds most of the rows; a list longer than the built-in limit is cut in steps.
    events = spark.range(0, 30_000, 1, 16).selectExpr(
        "CASE WHEN id % 10 < 8 THEN 'hot' ELSE concat('k', id % 7) END AS key", "id AS seq"
    )
    everything = {}
    for r in events.collect():
        everything.setdefault(r.key, []).append(r.seq)
    for n in (1, 16, 17, 1000, 1001, 5000):
        got = {}
        for r in newest_rows(events, ["key"], ["seq"], n).collect():
            got.setdefault(r.key, []).append(r.seq)
        assert {k: sorted(v) for k, v in got.items()} == {
            k: sorted(v)[-n:] for k, v in everything.items()
        }


def test_lists_have_one_plan_and_are_cut_before_the_shuffle(spark):
    log = spark.createDataFrame(random_log(1), SCHEMA)
    for n in (2, 200, 2000):
        plan = ops.keep_last_n(log, n=n)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1
        if n <= 1000:
            assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_counts_streams_and_subkeys(spark, rows_of):
    table = spark.createDataFrame(
        [("orders", "0", 10), ("orders", "1", 20), ("other", "0", 5)],
        "stream_id string, partition string, offset_num long",
    )
    assert ops.count_checkpoints(table).first().n_checkpoints == 3
    assert rows_of(ops.count_checkpoints(table, "stream_id")) == [("orders", 2), ("other", 1)]
    assert ops.count_checkpoints(table.limit(0)).first().n_checkpoints == 0
    assert rows_of(ops.list_streams(table)) == [("orders",), ("other",)]
    assert rows_of(ops.list_subkeys(table, "orders")) == [("0",), ("1",)]
    assert rows_of(ops.list_subkeys(table, "unknown")) == []
    keyed = ops.with_key(table, "colon", "ck", ["stream_id", "partition"])
    assert rows_of(ops.list_subkeys(keyed, "orders", key="key", prefix="ck:")) == [("0",), ("1",)]


def test_duplicate_keys(spark, rows_of):
    table = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "stream_id string, n int")
    assert rows_of(ops.duplicate_keys(table, ["stream_id"])) == [("a", 2)]


def test_positions_are_those_of_the_order(spark):
    table = spark.range(0, 5000, 1, 7).selectExpr("(id * 7919) % 1000 AS a", "id AS b")
    listed = ops.ordered_list(table, ["a", "b"], "position").collect()
    assert [r.position for r in sorted(listed, key=lambda r: (r.a, r.b))] == list(range(1, 5001))


def test_ordered_and_limited_lists(spark):
    table = spark.createDataFrame([("b", 2), ("a", 1), ("c", 0)], "k string, n int")
    assert [r.k for r in ops.ordered_list(table, ["k"]).collect()] == ["a", "b", "c"]
    assert [r.k for r in ops.limited_list(table, 2, ["n"]).collect()] == ["c", "a"]
    assert ops.list_all(table).count() == 3


@pytest.mark.parametrize("n", [1, 1001, 2500, 100_000])
def test_newest_rows_by_selection(spark, rows_of, n):
    """Against numbering: uneven keys and orders, negative and repeated numbers, keys with nulls."""
    log = spark.sql("""
        SELECT IF(id % 2 = 0, 'hot', IF(id % 11 = 1, NULL, concat('s', id % 3))) AS stream_id, 'p' AS pipeline_id,
               CASE WHEN id = 7 THEN 9223372036854775807 WHEN id = 9 THEN -9223372036854775808
                    ELSE id * id - 5000 END AS seq, id
        FROM range(0, 6000, 1, 4)""")
    for rows in (log, log.where("id not in (7, 9)"), log.where("false"), log.withColumn("seq", F.col("id").cast("int"))):
        number = F.row_number().over(Window.partitionBy("pipeline_id", "stream_id").orderBy(F.desc("seq")))
        expected = rows.withColumn("_n", number).where(F.col("_n") <= n).drop("_n")
        found = newest_rows(rows, ["pipeline_id", "stream_id"], ["seq"], n, spread=True)
        assert found.columns == rows.columns
        assert rows_of(found, "id") == rows_of(expected, "id")
