import pytest
from pyspark.sql import functions as F

from tidemark import operators as ops
from tidemark.plans import fits_broadcast, join_on_keys, narrow_to_keys


@pytest.fixture
def table(spark):
    return spark.createDataFrame(
        [("a", 10, "10"), ("b", 0, "0"), ("c", None, "null")],
        "stream_id string, offset_num long, offset_json string",
    )


@pytest.fixture
def source(spark):
    return spark.range(1, 61).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 3 = 1 THEN 'c' ELSE concat('new', id % 4) END AS stream_id",
        "id AS at", "id * 2 AS value",
    )


def expected(source):
    stop = {"a": 10, "b": 0}
    return sorted(
        (r.stream_id, r.at, r.value) for r in source.collect() if r.at > stop.get(r.stream_id, -1)
    )


def check_lookups(spark, table, rows_of):
    keys = spark.createDataFrame([("a",), ("zz",)], "stream_id string")
    assert rows_of(ops.load_many(table, keys, ["stream_id"])) == [("a", 10, "10"), ("zz", None, None)]
    assert rows_of(ops.existing(table, keys, ["stream_id"])) == [("a",)]
    assert rows_of(ops.missing(table, keys, ["stream_id"])) == [("zz",)]


def test_load_exists_missing(spark, table, rows_of):
    check_lookups(spark, table, rows_of)


def test_load_exists_missing_shuffled(spark, table, rows_of, no_broadcast):
    check_lookups(spark, table, rows_of)


def test_presence_reads_key_columns_only(spark, path):
    spark.range(1000).selectExpr("id AS k", "md5(CAST(id AS STRING)) AS data").write.parquet(path)
    found = ops.existing(spark.read.parquet(path), spark.range(5).withColumnRenamed("id", "k"), ["k"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "k#" in plan and "data#" not in plan


def test_resume_is_strictly_after_the_offset(source, table, rows_of):
    assert rows_of(ops.resume(source, table, "at", ["stream_id"])) == expected(source)


def test_resume_with_a_large_table(source, table, rows_of, no_broadcast):
    assert rows_of(ops.resume(source, table, "at", ["stream_id"])) == expected(source)


def test_resume_refuses_offsets_without_order(spark, source, table):
    text = spark.createDataFrame(
        [("a", None, '"tok-1"')], "stream_id string, offset_num long, offset_json string"
    )
    with pytest.raises(Exception, match="no order"):
        ops.resume(source, text, "at", ["stream_id"]).collect()
    # Only where the source has records of that stream.
    other = text.selectExpr("'elsewhere' AS stream_id", "offset_num", "offset_json")
    assert ops.resume(source, other, "at", ["stream_id"]).count() == 60
    with pytest.raises(TypeError):
        ops.resume(source, table, "stream_id", ["stream_id"])


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_keys_with_a_null_match_nothing(spark, rows_of, no_broadcast, how):
    left = spark.range(90).selectExpr("IF(id % 3 = 0, NULL, id % 4) AS k", "id AS v")
    right = spark.createDataFrame([(1, 10), (None, 20)], "k long, w long")
    assert rows_of(join_on_keys(left, right, ["k"], how)) == rows_of(left.join(right, ["k"], how))


def test_hot_keys_are_split_whatever_their_number(spark, no_broadcast):
    # 15,000 keys of 30 rows, all in the same few partitions.
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = [k for k in range(400_000) if k % 20 == 0][:15_000]
        keys = spark.createDataFrame([(k,) for k in hot], "k long")
        placed = keys.where(F.pmod(F.hash("k"), F.lit(40)) < 3)
        log = placed.join(spark.range(30), how="cross").selectExpr("k", "md5(CAST(id AS STRING)) AS v")
        table = keys.selectExpr("k", "k AS w")
        left = ops.delete_history(log, table.where("w < 0"), ["k"])
        joined = log.join(table, "k", "left")
        assert joined.count() == log.count() == left.count()
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_size_checks(spark, path, no_broadcast):
    small = spark.range(10)
    assert not fits_broadcast(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert fits_broadcast(small)
    assert not fits_broadcast(spark.range(10**9))
    large = spark.range(10**9)
    assert "LeftSemi" in narrow_to_keys(large, small, ["id"])._jdf.queryExecution().toString()
    assert narrow_to_keys(large, large, ["id"]) is large
