import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark import sources, streaming
from tidemark.workload.streams import run_to_end

T0 = dt.datetime(2024, 3, 1, 8)
TABLE = "pipeline_id string, stream_id string, offset_json string, metadata string, created_at timestamp, updated_at timestamp"


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("007", "s1", "10", '{"a":1}', T0, T0), ("007", "s2", '{"pos":1}', None, None, T0),
         ("a b/c=é", "s1", "99", "{}", T0, T0)],
        TABLE,
    )


def columns(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


def test_files_come_back_as_written(spark, table, path):
    sources.write_checkpoint_files(table, path)
    good, bad = sources.read_checkpoint_files(spark, path)
    assert bad.count() == 0
    assert columns(good, "pipeline_id", "stream_id", "offset_json", "metadata", "updated_at") == [
        ("007", "s1", "10", '{"a":1}', T0), ("007", "s2", '{"pos":1}', "{}", T0),
        ("a b/c=é", "s1", "99", "{}", T0),
    ]
    one, _ = sources.read_checkpoint_files(spark, path, "007")
    assert columns(one, "stream_id") == [("s1",), ("s2",)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pipeline_id" in plan
    none, _ = sources.read_checkpoint_files(spark, path, "unknown")
    assert none.count() == 0


def test_writing_a_pipeline_again_leaves_the_others(spark, table, path):
    sources.write_checkpoint_files(table, path)
    changed = table.where("pipeline_id = '007' AND stream_id = 's1'").withColumn("offset_json", F.lit("11"))
    sources.write_checkpoint_files(changed, path)
    good, _ = sources.read_checkpoint_files(spark, path)
    assert columns(good, "pipeline_id", "stream_id", "offset_num") == [
        ("007", "s1", 11), ("a b/c=é", "s1", 99),
    ]


def test_expiry_is_stored_with_the_payload(spark, table, path):
    stamped = ops.stamp_expiry(table, 60)
    sources.write_checkpoint_files(stamped, path, expiry="expires_at")
    good, _ = sources.read_checkpoint_files(spark, path)
    assert {r.expires_at for r in good.collect()} == {T0 + dt.timedelta(seconds=60)}


def test_a_large_pipeline_is_split_and_small_ones_are_not(spark, path):
    rows = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 5)).alias("pipeline_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("stream_id"),
        F.col("id").cast("string").alias("offset_json"), F.lit("{}").alias("metadata"),
        F.lit(T0).alias("created_at"), F.lit(T0).alias("updated_at"),
    )
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "1MB")
    try:
        sources.write_checkpoint_files(rows, path)
    finally:
        spark.conf.set(name, before)

    def files(pipeline):
        return [f for f in os.listdir(f"{path}/pipeline_id={pipeline}") if f.startswith("part-")]

    assert len(files("hot")) > 1
    assert sources.read_checkpoint_files(spark, path)[0].count() == 60_000


def test_object_tree(spark, path):
    record = {"stream_id": "s", "offset": 1, "metadata": {}, "created_at": T0.isoformat(), "updated_at": T0.isoformat()}
    for pipeline, key, body in [
        ("pipe 1", "ck-1", json.dumps(record, indent=2)), ("pipe 1", "ck-2", json.dumps({**record, "offset": "x"})),
        ("pipe2", "ck-1", json.dumps(record)), ("pipe2", "broken", "{"),
    ]:
        os.makedirs(f"{path}/{pipeline}", exist_ok=True)
        with open(f"{path}/{pipeline}/{key}.json", "w") as out:
            out.write(body)
    with open(f"{path}/pipe2/notes.txt", "w") as out:
        out.write("not a checkpoint")
    good, bad = sources.read_checkpoint_files(spark, path, layout="objects")
    assert columns(good, "pipeline_id", "checkpoint_id", "offset_json") == [
        ("pipe 1", "ck-1", "1"), ("pipe 1", "ck-2", '"x"'), ("pipe2", "ck-1", "1"),
    ]
    assert columns(bad, "pipeline_id", "checkpoint_id", "data") == [("pipe2", "broken", "{")]
    one, _ = sources.read_checkpoint_files(spark, path, "pipe 1", layout="objects")
    assert columns(one, "checkpoint_id") == [("ck-1",), ("ck-2",)]
    with pytest.raises(ValueError):
        sources.read_checkpoint_files(spark, path, layout="zip")


def test_ensure_table_creates_once(spark, tmp_path):
    place = str(tmp_path / "t")
    table = sources.ensure_table(spark, "ensured", location=place)
    assert table.columns[:3] == ["pipeline_id", "stream_id", "partition"] and table.count() == 0
    spark.sql("INSERT INTO ensured (pipeline_id, stream_id, offset_json, updated_at) VALUES ('p','s','1',timestamp'2024-01-01')")
    assert sources.ensure_table(spark, "ensured", location=place).count() == 1
    with pytest.raises(ValueError):
        sources.ensure_table(spark, "other", ["nope"])


def test_ensure_table_by_path(spark, path):
    table = sources.ensure_table(spark, path, ["stream_id"])
    assert table.count() == 0 and "expires_at" in table.columns
    spark.createDataFrame([("p", "s")], "pipeline_id string, stream_id string").write.mode("append").parquet(path)
    assert sources.ensure_table(spark, path).count() == 1


def test_bucketed_tables_join_without_a_shuffle(spark, no_broadcast):
    for name in ("bucketed_a", "bucketed_b"):
        sources.ensure_table(spark, name, buckets=4)
        spark.sql(f"INSERT INTO {name} (pipeline_id, stream_id, offset_json, updated_at) SELECT 'p', CAST(id AS STRING), '1', timestamp'2024-01-01' FROM range(50)")
    kept = ops.delete_keys(spark.table("bucketed_a"), spark.table("bucketed_b").where("stream_id < '3'"))
    assert "Exchange" not in kept._jdf.queryExecution().executedPlan().toString()
    assert kept.count() == 50 - len([i for i in range(50) if str(i) < "3"])


def test_log_appends_keep_what_is_there(spark, path):
    log = spark.createDataFrame(
        [("p", "s", "1", 1, T0, "save", 1)],
        "pipeline_id string, stream_id string, offset_json string, offset_num long, updated_at timestamp, op string, seq long",
    )
    sources.append_log(log, path)
    sources.append_log(log.withColumn("seq", F.lit(2)), path)
    assert columns(sources.read_log(spark, path), "stream_id", "seq") == [("s", 1), ("s", 2)]


def test_payload_table(spark):
    table = spark.createDataFrame(
        [("k1", bytearray(b'{"stream_id":"s","offset":1,"updated_at":"2024-01-01T00:00:00"}')), ("k2", None)],
        "key string, data binary",
    )
    good, bad = sources.read_payload_table(table)
    assert columns(good, "key", "offset_num") == [("k1", 1)]
    assert columns(bad, "key") == [("k2",)]


def test_sorted_tables_hold_key_ranges(spark, path):
    rows = spark.range(0, 20_000, 1, 8).selectExpr("'p' AS pipeline_id", "md5(CAST(id AS STRING)) AS stream_id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sources.write_sorted(rows, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    per_file = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(
        F.min("stream_id").alias("lo"), F.max("stream_id").alias("hi")
    ).orderBy("lo").collect()
    assert len(per_file) == 4
    assert all(a.hi < b.lo for a, b in zip(per_file, per_file[1:]))


def test_jdbc_options():
    plain = sources.jdbc_options("jdbc:x:y", "t", driver="d.D")
    assert plain == {"url": "jdbc:x:y", "dbtable": "t", "fetchsize": "10000", "driver": "d.D"}
    split = sources.jdbc_options("u", "t", partition_column="id", lower=0, upper=100, partitions=8)
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "8"
    with pytest.raises(ValueError):
        sources.jdbc_options("u", "t", partition_column="id")


def test_names_of_objects_are_taken_as_they_are(spark, path):
    record = json.dumps({"stream_id": "s", "offset": 1, "created_at": None, "updated_at": T0.isoformat()})
    names = [("p+1", "a+b c"), ("p 1", "50%"), ("p*", "x*y"), ("p[1]", "z"), ("px", "w")]
    for pipeline, key in names:
        os.makedirs(f"{path}/{pipeline}", exist_ok=True)
        with open(f"{path}/{pipeline}/{key}.json", "w") as out:
            out.write(record)
    good, _ = sources.read_checkpoint_files(spark, path, layout="objects")
    assert columns(good, "pipeline_id", "checkpoint_id") == sorted(names)
    for pipeline, key in names:
        one, _ = sources.read_checkpoint_files(spark, path, pipeline, layout="objects")
        assert columns(one, "checkpoint_id") == [(key,)]


def test_all_key_columns_and_expiry_survive(spark, path):
    rows = spark.createDataFrame(
        [("p", "s", "0", "1", T0), ("p", "s", "1", "2", None)],
        "pipeline_id string, stream_id string, partition string, offset_json string, expires_at timestamp",
    ).selectExpr("*", "CAST(NULL AS STRING) AS metadata", "TIMESTAMP '2024-01-01' AS created_at", "TIMESTAMP '2024-01-01' AS updated_at")
    sources.write_checkpoint_files(rows, path)
    good, _ = sources.read_checkpoint_files(spark, path, key_cols=["pipeline_id", "stream_id", "partition"])
    got = sorted((r.partition, r.offset_json, r.expires_at is None) for r in good.collect())
    assert got == [("0", "1", False), ("1", "2", True)]


def objects_of(spark, names, offset=1):
    rows = [(p, k, f"s-{k}", str(offset), offset, '{"a":1}') for p, k in names]
    return spark.createDataFrame(
        rows, "pipeline_id string, checkpoint_id string, stream_id string, offset_json string, offset_num long, metadata string"
    ).withColumns({"created_at": F.lit("2024-01-01").cast("timestamp"), "updated_at": F.lit("2024-01-02").cast("timestamp")})


ODD_NAMES = [("pipe 1", "a+b"), ("pipe 1", "50%"), ("pipe 1", "%2F"), ("p{2}", "ключ"), ("p{2}", "x?=*"), ("p{2}", "a.b_c")]


def test_objects_are_read_as_they_were_written(spark, path, rows_of):
    written = objects_of(spark, ODD_NAMES).repartition(3)
    sources.write_checkpoint_objects(written, path)
    good, bad = sources.read_checkpoint_files(spark, path, layout="objects")
    names = ["pipeline_id", "checkpoint_id", "stream_id", "offset_num", "metadata", "created_at", "updated_at"]
    assert rows_of(good, *names) == rows_of(written, *names) and bad.count() == 0
    # One object is written again; the others stay.
    sources.write_checkpoint_objects(objects_of(spark, ODD_NAMES[:1], 7), path)
    assert rows_of(good, "offset_num") == [(1,)] * 5 + [(7,)]
    sources.write_checkpoint_objects(written.where("false"), path)
    assert good.count() == 6


@pytest.mark.parametrize("name", [None, "", "a/b", "..", ".hidden", "_hidden"])
@pytest.mark.parametrize("at", [0, 1])
def test_objects_that_no_reader_would_find_are_refused(spark, path, name, at):
    key = ("p", name) if at else (name, "k")
    with pytest.raises(Exception, match="no object can have"):
        sources.write_checkpoint_objects(objects_of(spark, [key]), path)


def test_new_objects_come_once(spark, path, tmp_path, rows_of):
    """Over three runs of the stream: odd names, nothing new, new ones beside a bad one."""
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    seen = []

    def run():
        good, _ = sources.stream_checkpoint_files(spark, path, files_per_batch=4)
        rows = good.select("pipeline_id", "checkpoint_id", "offset_num")
        run_to_end(streaming.stream_to(rows, lambda batch, n: seen.append([tuple(r) for r in batch.collect()]), state))

    sources.write_checkpoint_objects(objects_of(spark, ODD_NAMES), path)
    run()
    assert [len(rows) for rows in seen] == [4, 2]
    assert sorted(sum(seen, [])) == sorted((p, k, 1) for p, k in ODD_NAMES)
    run()
    assert len(seen) == 2
    sources.write_checkpoint_objects(objects_of(spark, [("new", "k"), ("p{2}", "k")], 5), path)
    with open(f"{path}/new/broken.json", "w") as file:
        file.write("{")
    run()
    assert sorted(sum(seen[2:], [])) == [("new", "k", 5), ("p{2}", "k", 5)]
    _, bad = sources.stream_checkpoint_files(spark, path)
    run_to_end(streaming.stream_append(bad, out, f"{state}-bad"))
    assert rows_of(spark.read.parquet(out)) == [("new", "broken", "{")]


def test_many_objects_take_few_tasks_to_look_up_and_several_to_write(spark, path, tmp_path):
    jobs, cores = spark.sparkContext.statusTracker(), spark.sparkContext.defaultParallelism
    sizes = lambda group: [
        jobs.getStageInfo(s).numTasks for j in jobs.getJobIdsForGroup(group) for s in jobs.getJobInfo(j).stageIds if jobs.getStageInfo(s)
    ]
    number = 8 * cores + 40
    spark.sparkContext.setJobGroup("objects", "objects")
    sources.write_checkpoint_objects(objects_of(spark, [("p", f"k{n}") for n in range(number)]).coalesce(1), path)
    assert max(sizes("objects")) >= cores
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    with sources.many_files(spark):
        good, _ = sources.stream_checkpoint_files(spark, path)
        running = streaming.stream_append(good, str(tmp_path / "out"), str(tmp_path / "state")).trigger(availableNow=True).start()
        running.awaitTermination()
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    assert spark.read.parquet(str(tmp_path / "out")).count() == number
    found = sizes(str(running.runId))
    assert found and max(found) <= 4 * cores


LOG = "pipeline_id string, stream_id string, seq long, updated_at timestamp"


@pytest.fixture
def days(spark, path):
    """A log of ten files for two pipelines, one of which has a name that paths must escape."""
    rows = [(p, f"s{k}", 10 * day + k, T0 + dt.timedelta(days=day)) for day in range(5) for k in range(4) for p in ("a b=%1", "c")]
    for day in range(5):
        some = spark.createDataFrame([r for r in rows if r[3] == T0 + dt.timedelta(days=day)], LOG)
        sources.append_log(some.coalesce(1), path, ["pipeline_id"])
    return rows


def _files(path):
    return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def _delete(spark, path, **period):
    schema = spark.createDataFrame([], LOG).schema
    gone = spark.createDataFrame([("a b=%1", "s1"), ("c", "unknown"), (None, "s1")], "pipeline_id string, stream_id string")
    return sources.delete_history_files(spark, path, gone, partition_by=["pipeline_id"], schema=schema, **period)


def test_deletion_rewrites_only_files_with_hits(spark, days, path, no_broadcast):
    before = _files(path)
    start = T0 + dt.timedelta(days=2)
    assert _delete(spark, path, start=start) == 3
    after = _files(path)
    # Two files of the one pipeline and all of the other are as they were.
    assert len(before & after) == 7 and len(before - after) == 3
    left = [r for r in days if not (r[:2] == ("a b=%1", "s1") and r[3] >= start)]
    assert columns(spark.read.parquet(path), "pipeline_id", "stream_id", "seq", "updated_at") == sorted(left)
    assert not [d for d in os.listdir(path) if d.startswith("_rewrite")]
    # Nothing is left to do, so nothing is written.
    assert _delete(spark, path, start=start) == 0 and _files(path) == after


@pytest.mark.parametrize("broken", ["move", "remove"])
def test_broken_rewrites_are_finished(spark, days, path, monkeypatch, broken):
    from tidemark.sources import rewrites

    whole = rewrites._finish

    def stop(spark, path, place):
        if broken == "remove":
            folder = next(d for d in sorted(os.listdir(os.path.join(place, "rows"))) if d.startswith("pipeline_id"))
            rows = os.path.join(place, "rows", folder)
            for file in os.listdir(rows):
                os.rename(os.path.join(rows, file), os.path.join(path, folder, file))
        raise KeyboardInterrupt

    monkeypatch.setattr(rewrites, "_finish", stop)
    with pytest.raises(KeyboardInterrupt):
        _delete(spark, path)
    # No row is missing, whatever was done of it.
    seen = {(r.stream_id, r.seq) for r in spark.read.parquet(path).collect()}
    assert seen == {(r[1], r[2]) for r in days}
    monkeypatch.setattr(rewrites, "_finish", whole)
    os.makedirs(os.path.join(path, "_rewrite-begun", "rows"))
    assert sources.finish_rewrites(spark, path) == 1 and sources.finish_rewrites(spark, path) == 0
    left = sorted((r[1], r[2], r[0]) for r in days if r[:2] != ("a b=%1", "s1"))
    assert sorted((r.stream_id, r.seq, r.pipeline_id) for r in spark.read.parquet(path).collect()) == left
    assert not [d for d in os.listdir(path) if d.startswith("_rewrite")]


def test_the_driver_holds_no_list_of_objects(spark, path):
    sources.write_checkpoint_objects(objects_of(spark, [("p", f"k{n}") for n in range(300)]), path)
    good, bad = sources.read_checkpoint_files(spark, path, layout="objects")
    assert good.count() == 300 and bad.count() == 0
    assert not [f for f in good.inputFiles() if f.endswith(".json")]


def odd_tree(path):
    record = json.dumps({"stream_id": "s", "offset": 1, "created_at": None, "updated_at": T0.isoformat()})
    for name in [
        "top.json", "p/k.json", "p/.k.json", "p/_k.json", "p/_k=1.json", "p/k.json._COPYING_", "p/k.txt", "p/empty.json",
        "p/deep/er/k.json", "_hidden/k.json", ".hidden/k.json", "_a=b/k.json", "_metadata/k.json", "p/_metadata.json",
    ]:
        os.makedirs(os.path.dirname(f"{path}/{name}"), exist_ok=True)
        with open(f"{path}/{name}", "w") as out:
            out.write("" if "empty" in name else record)
    os.makedirs(f"{path}/p/folder.json")
    os.symlink(f"{path}/nowhere", f"{path}/p/broken.json")


def test_trees_hold_what_spark_finds_in_them(spark, path):
    odd_tree(path)
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").format("binaryFile")
    found = sorted(tuple(r.path.removesuffix(".json").split("/")[-2:]) for r in reader.load(path).select("path").collect())
    assert ("er", "k") in found and ("data", "top") in found and len(found) == 6
    for place in (path, f"file:{path}/", path[:-1] + "?"):
        good, bad = sources.read_checkpoint_files(spark, place, layout="objects")
        assert columns(good, "pipeline_id", "checkpoint_id") == found and bad.count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        sources.read_checkpoint_files(spark, path, "unknown", layout="objects")


def test_objects_are_bytes_whatever_they_are_called(spark, path):
    os.makedirs(f"{path}/p")
    with open(f"{path}/p/k.gz", "wb") as out:
        out.write(b"{\xff")
    _, bad = sources.read_checkpoint_files(spark, path, layout="objects", suffix=".gz")
    assert [bytes(r[0]) for r in bad.select(F.col("data").cast("binary")).collect()] == [b"{\xff"]


def test_new_objects_come_once_by_lists(spark, path, tmp_path, rows_of):
    state, lists = str(tmp_path / "state"), str(tmp_path / "lists")
    seen = []

    def run(state=state):
        good, _ = sources.stream_checkpoint_files(spark, path, files_per_batch=4, lists=lists)
        rows = good.select("pipeline_id", "checkpoint_id", "offset_num")
        run_to_end(streaming.stream_to(rows, lambda batch, n: seen.append([tuple(r) for r in batch.collect()]), state))

    sources.write_checkpoint_objects(objects_of(spark, ODD_NAMES), path)
    run()
    assert [len(rows) for rows in seen] == [4, 2]
    assert sorted(sum(seen, [])) == sorted((p, k, 1) for p, k in ODD_NAMES)
    # What the driver's log of the source names are lists.
    log = "".join(open(f"{state}/sources/0/{n}").read() for n in os.listdir(f"{state}/sources/0") if n.isdigit())
    assert log.count("/lists/") == 2 and ".json" not in log
    run()
    assert len(seen) == 2
    sources.write_checkpoint_objects(objects_of(spark, [("new", "k"), ("p{2}", "k"), ("new", "gone")], 5), path)
    with open(f"{path}/new/broken.json", "w") as file:
        file.write("{")
    assert sources.list_new_objects(spark, path, lists) == 4 and sources.list_new_objects(spark, path, lists) == 0
    # Gone between listing and reading.
    os.remove(f"{path}/new/gone.json")
    run()
    assert sorted(sum(seen[2:], [])) == [("new", "k", 5), ("p{2}", "k", 5)]
    # Another stream over the same lists has read nothing yet.
    seen.clear()
    run(f"{state}-other")
    assert len(sum(seen, [])) == 8
    out = str(tmp_path / "out")
    _, bad = sources.stream_checkpoint_files(spark, path, lists=lists)
    run_to_end(streaming.stream_append(bad, out, f"{state}-bad"))
    assert rows_of(spark.read.parquet(out)) == [("new", "broken", "{")]
    with pytest.raises(ValueError, match="cannot list"):
        sources.stream_checkpoint_files(spark, path[:-1] + "?", lists=lists)
