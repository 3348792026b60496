"""Payloads, offsets, metadata and times."""

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark import operators as ops

T0 = dt.datetime(2024, 3, 1, 8, 0, 0, 123456)
RECORD = "stream_id string, offset_json string, metadata string, created_at timestamp, updated_at timestamp"


def decode(spark, *payloads, mode="permissive", extra=()):
    return ops.decode_payloads(
        spark.createDataFrame([(p,) for p in payloads], "data string"), mode=mode, extra=extra
    )


def test_payload_is_the_five_field_record(spark):
    row = spark.createDataFrame(
        [("s/1 \"q\"\n", '{"partition":0,"pos":100}', '{"env":"prod"}', T0, T0)], RECORD
    )
    assert json.loads(ops.encode_payloads(row).first().data) == {
        "stream_id": 's/1 "q"\n',
        "offset": {"partition": 0, "pos": 100},
        "metadata": {"env": "prod"},
        "created_at": "2024-03-01T08:00:00.123456",
        "updated_at": "2024-03-01T08:00:00.123456",
    }


def test_payload_defaults_and_extra_fields(spark):
    rows = spark.createDataFrame(
        [("s", "42", None, None, T0, "p", dt.datetime(2024, 1, 1, 0, 0, 0, 500000)),
         ("s", "42", None, None, T0, None, None)],
        RECORD + ", pipeline_id string, expires_at timestamp",
    )
    first, second = [
        json.loads(r.data)
        for r in ops.encode_payloads(rows, extra=["pipeline_id"], expiry="expires_at").collect()
    ]
    assert first["metadata"] == {} and first["created_at"] is None
    assert first["pipeline_id"] == "p" and first["_expires_at"] == 1704067200.5
    assert second["pipeline_id"] is None and "_expires_at" not in second


offsets = st.recursive(
    st.none() | st.booleans() | st.integers(-2**70, 2**70) | st.floats(allow_nan=False, allow_infinity=False)
    | st.text(st.characters(codec="utf-8", exclude_characters="\0"), max_size=8),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.sampled_from("bca"), inner, max_size=3),
    max_leaves=6,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(offsets, min_size=20, max_size=40))
def test_any_offset_survives_a_round_trip(spark, values):
    rows = spark.createDataFrame(
        [(f"s{i}", json.dumps(v), "{}", T0, T0) for i, v in enumerate(values)], RECORD
    )
    good, bad = ops.decode_payloads(ops.encode_payloads(rows).select("data"))
    got = {r.stream_id: r for r in good.collect()}
    assert bad.count() == 0
    for i, value in enumerate(values):
        row = got[f"s{i}"]
        assert json.loads(row.offset_json) == value
        integral = isinstance(value, int) and not isinstance(value, bool) and abs(value) < 2**63
        assert row.offset_num == (value if integral else None)
        assert (row.created_at, row.updated_at) == (T0, T0)


def test_text_offsets_stay_apart_from_numbers(spark):
    good, _ = decode(
        spark,
        '{"stream_id":"a","offset":"42","updated_at":"2024-01-01T00:00:00"}',
        '{"stream_id":"b","offset":42,"updated_at":"2024-01-01T00:00:00"}',
    )
    assert {r.stream_id: (r.offset_json, r.offset_num) for r in good.collect()} == {
        "a": ('"42"', None), "b": ("42", 42),
    }


def test_python_dumps_with_and_without_fraction(spark):
    record = {"stream_id": "s", "offset": 1, "metadata": {"a": [1, "x"]}, "created_at": None}
    good, bad = decode(
        spark,
        json.dumps({**record, "updated_at": dt.datetime(2024, 1, 1).isoformat()}),
        json.dumps({**record, "updated_at": T0.isoformat(), "created_at": T0.isoformat()}),
        json.dumps({**record, "updated_at": "2024-01-01T02:00:00+02:00"}),
    )
    assert bad.count() == 0
    assert sorted(r.updated_at for r in good.collect()) == [
        dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), T0,
    ]
    assert {r.metadata for r in good.collect()} == {'{"a":[1,"x"]}'}


BAD = [
    None,
    "",
    "{",
    "[1,2]",
    '{"offset":1,"updated_at":"2024-01-01T00:00:00"}',
    '{"stream_id":"s","updated_at":"2024-01-01T00:00:00"}',
    '{"stream_id":"s","offset":1}',
    '{"stream_id":"s","offset":1,"updated_at":"yesterday"}',
    '{"stream_id":"s","offset":1,"updated_at":"2024-01-01T00:00:00","created_at":"soon"}',
]


def test_bad_payloads_are_kept_apart(spark):
    fine = '{"stream_id":"s","offset":null,"updated_at":"2024-01-01T00:00:00"}'
    good, bad = decode(spark, fine, *BAD)
    assert [r.offset_json for r in good.collect()] == ["null"]
    assert sorted(str(r.data) for r in bad.collect()) == sorted(map(str, BAD))


@pytest.mark.parametrize("payload", BAD)
def test_failfast_fails(spark, payload):
    good, _ = decode(spark, payload, mode="failfast")
    with pytest.raises(Exception, match="unreadable payload"):
        good.collect()


def test_failfast_reads_good_rows_and_bytes(spark):
    data = '{"stream_id":"é","offset":7,"updated_at":"2024-01-01T00:00:00","pipeline_id":"p"}'
    rows = spark.createDataFrame([(bytearray(data, "utf-8"), 1)], "data binary, key int")
    good, bad = ops.decode_payloads(rows, mode="failfast", extra=["pipeline_id"])
    row = good.first()
    assert (row.stream_id, row.offset_num, row.pipeline_id, row.key) == ("é", 7, "p", 1)
    assert bad.count() == 0


def test_offsets_in_three_kinds(spark):
    def run(kind, *values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, offset string")
        rows = ops.normalise_offsets(df, kind).orderBy("i").collect()
        return [(r.offset_json, r.offset_num) for r in rows]

    assert run("json", "42", "-7", '"42"', "4.5", '{"a":1}', "99999999999999999999", None) == [
        ("42", 42), ("-7", -7), ('"42"', None), ("4.5", None), ('{"a":1}', None),
        ("99999999999999999999", None), (None, None),
    ]
    assert run("text", "42", 'a"b', None) == [('"42"', None), ('"a\\"b"', None), (None, None)]
    assert run("int", "42", "x", None) == [("42", 42), (None, None), (None, None)]
    with pytest.raises(ValueError):
        run("other", "1")


def test_metadata_rules(spark):
    rows = spark.createDataFrame([(0, None), (1, "{}"), (2, '{"a":1}')], "i int, metadata string")

    def run(**rules):
        return [r.metadata for r in ops.normalise_metadata(rows, **rules).orderBy("i").collect()]

    assert run(write="empty_object") == ["{}", "{}", '{"a":1}']
    assert run(write="empty_as_null") == [None, None, '{"a":1}']
    assert run(write="null_only") == [None, "{}", '{"a":1}']
    assert run(write="json_null") == ["null", "{}", '{"a":1}']
    assert run(read="empty_object") == ["{}", "{}", '{"a":1}']
    assert run(read="keep_null") == [None, "{}", '{"a":1}']
    assert run(write="json_null", read="keep_null") == [None, "{}", '{"a":1}']
    for wrong in ({"write": "x"}, {"read": "x"}):
        with pytest.raises(ValueError):
            run(**wrong)


def test_times_in_all_forms(spark):
    row = spark.createDataFrame(
        [("2024-03-01T08:00:00.123456", 1709280000.123456, 1709280000, 1709280000123, T0, "never")],
        "iso string, s double, si long, ms long, native timestamp, wrong string",
    )
    for column, fmt in [("iso", "iso"), ("s", "epoch_s"), ("si", "epoch_s"), ("ms", "epoch_ms"),
                        ("native", "native"), ("wrong", "iso")]:
        row = ops.normalise_times(row, column, fmt)
    got = row.first()
    assert (got.iso, got.s, got.native, got.wrong) == (T0, T0, T0, None)
    assert got.si == T0.replace(microsecond=0) and got.ms == T0.replace(microsecond=123000)


def test_stamping_and_side_columns(spark):
    rows = spark.createDataFrame([(1, T0, None), (2, None, "{}")], "i int, updated_at timestamp, metadata string")
    now = dt.datetime(2024, 5, 1)
    assert {r.updated_at for r in ops.stamp_updated_at(rows, now).collect()} == {now}
    kept = ops.stamp_updated_at(rows, now, "if_null").orderBy("i").collect()
    assert [r.updated_at for r in kept] == [T0, now]
    assert {r.payload for r in ops.with_payload_column(rows).collect()} == {"{}"}
    assert [r.id for r in ops.with_copied_column(rows, "id", "i").orderBy("i").collect()] == [1, 2]
    stored = rows.selectExpr("i", "i AS _id", "i AS _rev", "i AS expires_at")
    assert ops.strip_system_fields(stored, also=["expires_at"]).columns == ["i"]
