"""Plans of the registered queries: nothing that breaks when the tables grow."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark import streaming
from tidemark import ProgressTable
from tidemark.plans import latest, scratch_path
from tidemark.workload import all_queries
from tidemark.workload.streams import run_to_end

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no supplied tables")

#: One number per partition, per group or per table is all that comes together here.
GATHERS_FEW_ROWS = {
    "agg3_count_checkpoints", "srt1_ordered_by_key", "srt1_ordered_by_time", "srt1_ordered_orders",
}


BATCH = sorted(n for n in all_queries() if not n.startswith(("str", "ext", "src", "table")))
CASES = [(n, "10MB") for n in BATCH] + [(n, "-1") for n in BATCH if n.startswith(("jn", "mut"))]


@pytest.mark.parametrize(("name", "threshold"), CASES)
def test_no_pairwise_joins_and_no_single_partition(spark, name, threshold):
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, threshold)
    try:
        plan = all_queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(conf, before)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan
    if name not in GATHERS_FEW_ROWS:
        # A subquery may gather one row; the rows themselves never come together.
        main = plan.split("===== Subqueries")[0]
        assert "SinglePartition" not in main.split("Subquery")[0]


def test_scans_read_the_columns_they_need(spark):
    plan = all_queries()["agg1_latest_by_arrival_lineitem"](spark, SF_DIR)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_linenumber:int>" in text
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_narrow_compaction_does_not_sort(spark):
    plan = all_queries()["mut9_compact_log_narrow"](spark, SF_DIR)
    assert "Sort" not in plan._jdf.queryExecution().executedPlan().toString()


def test_one_shuffle_per_lookup(spark):
    # The stopped offsets are aggregated (one shuffle); the source itself stays put.
    plan = all_queries()["jn4_resume"](spark, SF_DIR)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Exchange hashpartitioning") == 1


def test_versions_are_aggregated_without_a_sort(spark):
    plan = all_queries()["agg2_latest_by_version_lineitem"](spark, SF_DIR)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in text and text.count("HashAggregate") == 2


def test_one_plan_for_every_n(spark):
    names = [n for n in all_queries() if n.startswith("win1_")]
    windows = {
        n: all_queries()[n](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString().count("Window [") for n in names
    }
    assert set(windows.values()) == {1}


@pytest.fixture
def hot(spark):
    """A log in which one stream has two thirds of the rows, beside settings that make a third
    of a megabyte a skewed partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    path = scratch_path(spark, "hot")
    spark.range(0, 200_000, 1, 8).selectExpr(
        "'p' AS pipeline_id", "IF(id % 3 < 2, 'hot', concat('s', id % 500)) AS stream_id", "id AS offset_num",
        "CAST(id AS STRING) AS offset_json", "id AS seq", "timestamp_seconds(id) AS updated_at", "sha2(CAST(id AS STRING), 256) AS pad",
    ).write.parquet(path)
    yield spark.read.parquet(path)
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


KEYS = ["pipeline_id", "stream_id"]

BESIDE_AN_AGGREGATE = {
    "resume": lambda log, changes: ops.resume(log, ops.latest_by_arrival(changes), "offset_num"),
    "upsert": lambda log, changes: ops.upsert(log.drop("seq"), changes),
    "replace_all": lambda log, changes: ops.replace_all(log.drop("seq"), changes),
    "merge_columns": lambda log, changes: ops.merge_columns(log.drop("seq"), changes, ["offset_num"]),
    "update_offset": lambda log, changes: ops.update_offset(log.drop("seq"), changes, "2024-01-01"),
    "delete_keys": lambda log, changes: ops.delete_keys(log, changes.select(*KEYS).distinct()),
    "keep_last_n": lambda log, changes: ops.keep_last_n(log, n=50_000, spread=True),
}


@pytest.mark.parametrize("name", BESIDE_AN_AGGREGATE)
def test_hot_keys_are_split_beside_an_aggregate(spark, hot, rows_of, name):
    changes = hot.where("seq % 50 = 0").select(*KEYS, "offset_num", "offset_json", "seq")
    found = BESIDE_AN_AGGREGATE[name](hot, changes)
    split = rows_of(found)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert split == rows_of(BESIDE_AN_AGGREGATE[name](hot, changes))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_only_the_edge_of_the_newest_rows_is_numbered(hot, monkeypatch):
    numbered = []

    def count_first(rows, *args):
        numbered.append(rows.groupBy("stream_id").count().agg(F.max("count")).first()[0])
        return whole(rows, *args)

    whole = latest._numbered
    monkeypatch.setattr(latest, "_numbered", count_first)
    found = ops.keep_last_n(hot, n=50_000, spread=True)
    assert found.count() == found.select("seq").distinct().count() == 50_000 + 200_000 // 3
    # A cell is the order's span by 2 to the power of 16, rounded up to a power of two.
    assert len(numbered) == 1 and 0 < numbered[0] <= 4


def test_a_hot_stream_is_split_in_its_batch(spark, hot):
    """Its offsets come from an aggregate that is not broadcast."""
    path = scratch_path(spark, "arrivals")
    hot.select(*KEYS, "offset_num", "pad").write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    table = hot.where("seq % 50 = 0").groupBy(*KEYS).agg((F.max("offset_num") / 2).cast("long").alias("offset_num"))
    plans, counts = [], []

    def write(unread, batch_id):
        counts.append(len(unread.collect()))
        plans.append(unread._jdf.queryExecution().executedPlan().toString())

    run_to_end(streaming.resume_to(stream, table, "offset_num", write, scratch_path(spark, "state")))
    assert "SortMergeJoin(skew=true)" in plans[0]
    assert sum(counts) == ops.resume(spark.read.parquet(path), table, "offset_num").count()


def rows_scanned(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))


def test_absent_keys_read_no_row_group(spark, path):
    """A key between the smallest and the largest of its file, in a column without a dictionary."""
    rows = spark.range(0, 100_000, 1, 4).selectExpr(
        "'p' AS pipeline_id", "sha2(CAST(id AS STRING), 256) AS stream_id", "id AS offset_num", "id AS seq",
    )
    table = ProgressTable(spark, path)
    table.save(rows)
    table.compact()
    absent, there = F.sha2(F.lit("no number"), 256), F.sha2(F.lit("77"), 256)
    absent, there = spark.range(1).select(absent, there).first()
    assert rows_scanned(table.load_key(pipeline_id="p", stream_id=absent)) == 0
    assert [r.offset_num for r in table.load_key(pipeline_id="p", stream_id=there).collect()] == [77]
    # It is the filter that does this, not the ranges of the files.
    plain = spark.read.option("parquet.filter.bloom.enabled", "false").parquet(f"{path}/snapshot/version=0")
    assert rows_scanned(plain.where(F.col("stream_id") == absent)) > 0
