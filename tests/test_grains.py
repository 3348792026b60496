"""Save, overwrite, load, delete and list for every shape of key."""

import datetime as dt

import pytest

from tidemark import operators as ops

T0 = dt.datetime(2024, 1, 1, 12)

GRAINS = {
    "stream": (["stream_id"], [("stream-1",), ("stream-2",)]),
    "pipeline": (["pipeline_id"], [("pipe-es-1",), ("pipe-es-2",)]),
    "checkpoint": (["checkpoint_id"], [("cp-1",), ("cp-2",)]),
    "pipeline and stream": (["pipeline_id", "stream_id"], [("pipe1", "a"), ("pipe1", "b"), ("pipe2", "a")]),
    "pipeline and checkpoint": (["pipeline_id", "checkpoint_id"], [("pipe-1", "ckpt-1"), ("pipe-1", "ckpt-2")]),
    "pipeline and source": (["pipeline_id", "source_id"], [("pipe1", "src1"), ("pipe2", "src1")]),
    "stream and partition": (["stream_id", "partition"], [("events", "0"), ("events", "1"), ("other", "0")]),
    "stream and number": (["stream_id", "partition"], [("orders", 0), ("orders", 1)]),
    "three parts": (["pipeline_id", "stream_id", "partition"], [("p", "s", "0"), ("p", "s", "1"), ("p", "t", "0")]),
}


@pytest.mark.parametrize("grain", GRAINS)
def test_the_contract_holds(spark, rows_of, grain):
    key_cols, keys = GRAINS[grain]
    types = ", ".join(f"{c} {'int' if isinstance(v, int) else 'string'}" for c, v in zip(key_cols, keys[0]))
    schema = f"{types}, offset_json string, offset_num long, metadata string, updated_at timestamp, seq long"

    def saves(*rows):
        return spark.createDataFrame(
            [(*key, str(offset), offset, '{"source":"kafka"}', T0, seq) for key, offset, seq in rows], schema
        )

    empty = saves((keys[0], 0, 0)).drop("seq").limit(0)
    assert ops.count_checkpoints(empty).first().n_checkpoints == 0
    table = ops.upsert(empty, saves(*[(k, 10 * i, i) for i, k in enumerate(keys, 1)]), key_cols)
    table = ops.upsert(table, saves((keys[0], 99, 50)), key_cols)
    expected = {k: 10 * i for i, k in enumerate(keys, 1)} | {keys[0]: 99}
    assert rows_of(table, *key_cols, "offset_num") == sorted((*k, o) for k, o in expected.items())
    assert ops.duplicate_keys(table, key_cols).count() == 0

    found = ops.by_key(table, **dict(zip(key_cols, keys[0]))).collect()
    assert [(r.offset_num, r.metadata) for r in found] == [(99, '{"source":"kafka"}')]
    unknown = tuple(-1 if isinstance(v, int) else "missing" for v in keys[0])
    asked = spark.createDataFrame([keys[0], unknown], types)
    assert ops.by_key(table, **dict(zip(key_cols, unknown))).count() == 0
    assert rows_of(ops.load_many(table, asked, key_cols), *key_cols, "offset_num") == sorted(
        [(*keys[0], 99), (*unknown, None)], key=lambda r: r[:-1]
    )

    group = keys[0][0]
    assert ops.by_group(table, key_cols[0], group).count() == len([k for k in keys if k[0] == group])
    left = ops.delete_keys(table, asked, key_cols)
    assert rows_of(left, *key_cols) == sorted(k for k in keys if k != keys[0])
    assert rows_of(ops.delete_report(table, asked, key_cols)) == sorted(
        [(*keys[0], True), (*unknown, False)]
    )
