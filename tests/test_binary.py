"""Batch converters: errors value by value, routed rows only, no Python on other routes."""

import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventlake import constants as C
from eventlake.operators import binary as B
from eventlake.operators.decode import decode
from eventlake.plans.pipeline import run
from eventlake.sources.metadata import ROUTE_SCHEMA, local_table
from tests.test_properties import _meta


def raw(spark, values, topic="t_click"):
    rows = [("kafka-a:9092", "etl", topic, 0, i, None, None, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "server string, consumer_group string, topic string, partition int, offset bigint, "
                                       "timestamp timestamp_ntz, key binary, value binary")


def routes(spark, name, topic="t_click"):
    return local_table(spark, [("kafka-a:9092", topic, name, None, None)], ROUTE_SCHEMA)


def test_packed_events(spark):
    good = struct.pack(">qqqH", 7, 1704162245123, -1250, 1)
    values = [good, good[:-1], struct.pack(">qqqH", 7, 0, 0, 3), None, b"", b'{"EventID":"j"}', b"12", struct.pack(">qqqH", 1, 1 << 62, 5, 0)]
    got = {r.offset: (r.body_text, r.decode_error) for r in decode(raw(spark, values), routes(spark, "packedEvent")).collect()}
    assert got[0] == ('{"EventID":"click","LoginID":"u7","Time":"2024-01-02 02:24:05.123","Amount":-12.5}', None)
    assert got[1][0] is None and got[1][1] == C.DECODE_ERROR_PREFIX + "26 bytes expected, found 25"
    assert got[2][1].endswith("unknown event code") and got[3] == (None, None)
    assert got[4][1].endswith("found 0") and got[5] == ('{"EventID":"j"}', None) and "not a JSON object" in got[6][1]
    assert got[7][0] is None and got[7][1]  # a time that cannot be written: only this value is in error


def test_errors_reach_the_invalid_output(spark):
    good = struct.pack(">qqqH", 7, 1704162245123, 1250, 1)
    meta = _meta(spark)
    meta.routes = routes(spark, "packedEvent")
    res = run(raw(spark, [good, b"xx", good]), meta)
    assert [(r.offset, r.distinct_id, r.event, r.time) for r in res.main().orderBy("offset").collect()] == [
        (0, "u7", "click", 1704162245123 - 8 * 3600_000), (2, "u7", "click", 1704162245123 - 8 * 3600_000)]
    assert [(r.offset, r.error_reason) for r in res.invalid().collect()] == [(1, C.DECODE_ERROR_PREFIX + "26 bytes expected, found 2")]


def test_no_python_on_other_routes(spark):
    plain = decode(raw(spark, [b"{}"]), routes(spark, "csvConverter"))
    assert "Python" not in plain._jdf.queryExecution().executedPlan().toString()
    both = decode(raw(spark, [b"{}"]), routes(spark, "packedEvent", "t_other"))
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert both.count() == 1  # the record of another route takes the other branch


def test_a_raising_converter_fails_value_by_value():
    def upper(values):
        return pa.array([v.decode().upper() for v in values.to_pylist()]), pa.nulls(len(values), pa.string())

    texts, errors = B._guarded(upper, pa.array([b"a", b"\xff", b"c"]))
    assert texts.to_pylist() == ["A", None, "C"] and errors[1].as_py().startswith("UnicodeDecodeError") and errors[0].as_py() is None
    texts, errors = B._guarded(lambda v: (pa.array(["x"]), pa.array([None], pa.string())), pa.array([b"a", b"b"]))
    assert texts.to_pylist() == ["x", "x"] and errors.null_count == 2


@pytest.mark.parametrize("name", ["shout"])
def test_own_batch_converter(spark, name):
    def shout(values):
        return pa.array(['{"EventID":"%s"}' % v.decode().upper() for v in values.to_pylist()]), pa.nulls(len(values), pa.string())

    B.register_batch_converter(name, shout)
    try:
        got = decode(raw(spark, [b"hey", b"\xff\xfe"]), routes(spark, name)).select("body_text", "decode_error").orderBy("offset").collect()
        assert got[0].body_text == '{"EventID":"HEY"}' and "UnicodeDecodeError" in got[1].decode_error
    finally:
        del B.BATCH_CONVERTERS[name]


def test_empty(spark):
    assert decode(raw(spark, []), routes(spark, "packedEvent")).select(F.col("body_text")).collect() == []
