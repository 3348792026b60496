import datetime as dt

import pytest
from test_state import random_log, replay

from tidemark import KEY_COLS, ProgressTable

T0 = dt.datetime(2024, 3, 1, 8)
EVENT = "pipeline_id string, stream_id string, offset_json string, offset_num long, metadata string, updated_at timestamp, seq long"


@pytest.fixture(params=[None, 5], ids=["ranges", "buckets"])
def table(spark, path, request):
    return ProgressTable(spark, path, buckets=request.param)


def saves(spark, *rows):
    return spark.createDataFrame(
        [(p, s, str(o), o, "{}", T0, seq) for p, s, o, seq in rows], EVENT
    )


def keys(spark, *rows):
    return spark.createDataFrame(list(rows), "pipeline_id string, stream_id string, seq long")


def state(table):
    return sorted(tuple(r) for r in table.read().select(*KEY_COLS, "offset_num").collect())


def test_save_load_delete(spark, table, rows_of):
    assert state(table) == []
    table.save(saves(spark, ("p", "a", 1, 1), ("p", "b", 2, 2), ("q", "a", 3, 3)))
    table.save(saves(spark, ("p", "a", 9, 4)))
    assert state(table) == [("p", "a", 9), ("p", "b", 2), ("q", "a", 3)]
    asked = keys(spark, ("p", "a", 0), ("p", "zz", 0))
    assert rows_of(table.load(asked), "stream_id", "offset_num") == [("a", 9), ("zz", None)]
    assert rows_of(table.exists(asked), "stream_id") == [("a",)]
    assert rows_of(table.load_key(pipeline_id="q", stream_id="a"), "offset_num") == [(3,)]
    assert rows_of(table.list_group("pipeline_id", "p"), "stream_id") == [("a",), ("b",)]
    table.delete(keys(spark, ("p", "a", 5), ("p", "unknown", 6)), T0)
    assert state(table) == [("p", "b", 2), ("q", "a", 3)]
    assert table.load_key(pipeline_id="p", stream_id="a").count() == 0
    assert table.exists(asked).count() == 0
    # A save that comes in late stays deleted; a newer one brings the key back.
    table.save(saves(spark, ("p", "a", 7, 4)))
    assert ("p", "a", 7) not in state(table)
    table.save(saves(spark, ("p", "a", 8, 7)))
    assert ("p", "a", 8) in state(table)


def test_update_offset_and_clear(spark, table, rows_of):
    table.save(saves(spark, ("p", "a", 1, 1), ("q", "a", 3, 2)))
    later = T0 + dt.timedelta(hours=1)
    changes = saves(spark, ("p", "a", 5, 3), ("p", "a", 6, 4), ("p", "zz", 7, 5)).drop("metadata", "updated_at")
    table.update_offset(changes, later)
    assert rows_of(table.read(), *KEY_COLS, "offset_json", "metadata", "updated_at") == [
        ("p", "a", "6", "{}", later), ("q", "a", "3", "{}", T0),
    ]
    table.clear(later, 10, "p")
    assert state(table) == [("q", "a", 3)]
    table.clear(later, 11)
    assert state(table) == []


def test_a_batch_written_again_replaces_itself(spark, table):
    for _ in range(2):
        table.save(saves(spark, ("p", "a", 1, 1)), batch_id=0)
    assert len(table.batches()) == 1 and state(table) == [("p", "a", 1)]


def test_compacting_changes_nothing_but_the_files(spark, table, path):
    events = random_log(11, 200)
    log = [(p, s, str(o), o, m, T0, seq, op) for p, s, o, m, op, _, seq in events]
    for part in range(4):
        table.append(spark.createDataFrame(log[part::4], EVENT + ", op string"))
        if part % 2:
            before = state(table)
            table.compact()
            assert state(table) == before and table.batches() == []
    assert state(table) == sorted((p, s, o) for p, s, o, _ in replay(events))
    # Deletes are kept, so an older save read once more does not bring a key back.
    table.append(spark.createDataFrame(log, EVENT + ", op string"))
    assert state(table) == sorted((p, s, o) for p, s, o, _ in replay(events))
    table.vacuum()
    assert state(table) == sorted((p, s, o) for p, s, o, _ in replay(events))
    assert len(table._children(f"{path}/snapshot")) == 1
    table.compact(drop_deletes_before=T0 + dt.timedelta(seconds=1))
    assert table.spark.read.parquet(f"{path}/snapshot/version=2").where("op = 'delete'").count() == 0
    assert state(table) == sorted((p, s, o) for p, s, o, _ in replay(events))


def test_unfinished_writes_are_not_read(spark, table, path):
    import os

    table.save(saves(spark, ("p", "a", 1, 1)), batch_id=0)
    table.save(saves(spark, ("p", "b", 2, 2)), batch_id=1)
    os.remove(f"{path}/batch/batch/batch_id=1/_SUCCESS")
    assert state(table) == [("p", "a", 1)]
    table.compact()
    os.remove(f"{path}/snapshot/version=0/_SUCCESS")
    assert state(table) == [("p", "a", 1)]
    table.compact()
    assert state(table) == [("p", "a", 1)]


@pytest.mark.parametrize("table", [None], indirect=True)
def test_a_compacted_table_is_read_without_a_shuffle(spark, table):
    table.save(saves(spark, *[("p", f"s{i}", i, i) for i in range(200)]))
    table.compact()

    def plan():
        return table.read()._jdf.queryExecution().executedPlan().toString()

    assert "Exchange" not in plan()
    table.save(saves(spark, ("p", "s7", 1000, 1000), ("p", "s8", 0, 1), ("p", "new", 5, 1001)))
    # Rows of untouched keys pass through a broadcast join.
    assert "LeftAnti" in plan()
    got = dict((s, o) for _, s, o in state(table))
    assert len(got) == 201 and (got["s7"], got["s8"], got["new"]) == (1000, 8, 5)


def test_large_batches_are_merged_by_a_shuffle(spark, table, no_broadcast):
    table.save(saves(spark, *[("p", f"s{i}", i, i) for i in range(50)]))
    table.compact()
    table.save(saves(spark, ("p", "s7", 1000, 1000), ("p", "s8", 0, 1)))
    got = dict((s, o) for _, s, o in state(table))
    assert len(got) == 50 and (got["s7"], got["s8"]) == (1000, 8)


def test_resume_from_a_table(spark, table, rows_of):
    table.save(saves(spark, ("p", "a", 3, 1)))
    source = spark.createDataFrame(
        [("p", "a", 3), ("p", "a", 4), ("p", "b", 0)], "pipeline_id string, stream_id string, at long"
    )
    assert rows_of(table.resume(source, "at"), "stream_id", "at") == [("a", 4), ("b", 0)]


def test_events_need_a_key_and_an_order(spark, table, rows_of):
    rows = saves(spark, ("p", "a", 3, 1))
    with pytest.raises(ValueError, match="seq"):
        table.save(rows.drop("seq"))
    with pytest.raises(ValueError, match="op"):
        table.append(rows)
    table.save(rows.drop("offset_json"))
    assert rows_of(table.read(), "offset_json", "offset_num") == [("3", 3)]


@pytest.mark.parametrize(
    ("row", "message"),
    [
        (("p", "a", 1, "save", None), "without seq"),
        (("p", None, 1, "save", 1), "without stream_id"),
        (("p", "a", 1, None, 1), "without op"),
        (("p", "a", 1, "sav", 1), "unknown kind"),
    ],
)
def test_events_that_would_be_lost_are_refused(spark, table, row, message):
    events = spark.createDataFrame([row], "pipeline_id string, stream_id string, offset_num long, op string, seq long")
    with pytest.raises(Exception, match=message):
        table.append(events)
    assert state(table) == []


def test_unknown_columns_are_refused(spark, table):
    with pytest.raises(ValueError, match="colour"):
        table.save(saves(spark, ("p", "a", 1, 1)).selectExpr("*", "'red' AS colour"))


def test_tables_do_not_depend_on_success_markers(spark, table):
    name = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set(name, "false")
    try:
        table.save(saves(spark, ("p", "a", 1, 1)))
        table.compact()
        table.save(saves(spark, ("p", "a", 2, 2)))
    finally:
        conf.unset(name)
    assert state(table) == [("p", "a", 2)]


def test_batches_without_a_query_are_not_named(spark):
    from tidemark.streaming.sinks import _writer_name

    with pytest.raises(RuntimeError):
        _writer_name(spark.range(1))


def test_tables_change_their_layout(spark, path):
    """From ranges to buckets, to more of them, and back; each snapshot is read by its own number."""
    rows = [("p", f"s{k}", k, k) for k in range(50)]
    ProgressTable(spark, path).save(saves(spark, *rows))
    for n, buckets in enumerate([None, 3, 3, 8, None, 2]):
        table = ProgressTable(spark, path, buckets=buckets)
        table.save(saves(spark, ("p", f"s{n}", 1000 + n, 1000 + n), ("q", f"t{n}", n, 2000 + n)))
        table.compact()
        # A reader that knows of no buckets, and late events of either kind.
        late = saves(spark, ("p", f"s{n}", 7, 500), ("q", f"t{n}", 8, 500))
        ProgressTable(spark, path).save(late)
        held = state(ProgressTable(spark, path))
        assert held == state(ProgressTable(spark, path, buckets=99))
        assert [o for p, s, o in held if p == "q"] == list(range(n + 1))
        assert len(held) == 50 + n + 1 and ("p", f"s{n}", 1000 + n) in held
        table.vacuum()
    assert state(ProgressTable(spark, path)) == held


def test_buckets_are_read_once_and_stay_where_they_are(spark, path, no_broadcast):
    table = ProgressTable(spark, path, buckets=6)
    rows = spark.range(0, 5000, 1, 3).selectExpr(
        "'p' AS pipeline_id", "concat('s', id) AS stream_id", "id AS offset_num", "id AS seq"
    )
    table.save(rows)
    table.compact()
    table.save(rows.where("offset_num % 9 = 0").selectExpr("pipeline_id", "stream_id", "-offset_num AS offset_num", "seq + 9000 AS seq"))

    def plan():
        found = table.read()
        assert found.where("offset_num < 0").count() == 555
        return found._jdf.queryExecution().executedPlan().toString()

    text = plan()
    # One shuffle of the batch for its last events, one into the buckets, none of the snapshot.
    assert text.count("Bucketed: true") == 1 and text.count("FileScan parquet") == 2
    assert text.count("Exchange hashpartitioning") == 2
    snapshot_side = text.split("Exchange")[0]
    assert "SortMergeJoin" in snapshot_side and "Bucketed: true" in snapshot_side
    table.compact()
    files = [f for f in spark.read.parquet(f"{path}/snapshot/version=1").inputFiles()]
    assert len(files) == 6 and table.batches() == []
    assert "Exchange" not in plan()
    table.save(rows.limit(1).selectExpr("pipeline_id", "stream_id", "offset_num", "99999 AS seq"))
    assert table.read().where("offset_num < 0").count() >= 554
