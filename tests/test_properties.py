import json

from pyspark.sql import functions as F

from eventlake.config import PipelineConfig
from eventlake.operators.metadata import Metadata
from eventlake.plans.pipeline import transform
from tests.conftest import raw_rows


def _meta(spark, rules=(), projects="p1"):
    ss = spark.createDataFrame(
        [("kafka-a:9092", "etl", "", "t_click", p, 1, 0) for p in projects.split(",")],
        "source_server_port string, source_group_id string, source_sasl_jaas string, source_topic string, "
        "sink_project_id string, valid_flag int, debug_mode_flag int")
    task = spark.createDataFrame([(p, 1) for p in projects.split(",")], "name string, project_status int")
    tr = spark.createDataFrame(list(rules), "id int, sink_project_id string, input_field string, "
                                            "output_field string, output_type string, valid_flag int")
    return Metadata(ss, task, tr, None)


def _props(spark, bodies, rules=(), projects="p1", config=None):
    parts = transform(raw_rows(spark, bodies), _meta(spark, rules, projects), config or PipelineConfig())
    rows = parts.orderBy("offset", "part_index").select(F.to_json("properties").alias("p")).collect()
    return [json.loads(r.p) for r in rows]


BASE = '"EventID":"view","LoginID":"u1","Time":"2024-01-01 00:00:00"'


def test_flatten_document_order_last_wins(spark):
    p = _props(spark, [
        "{" + BASE + ',"A":1,"a":2}',
        "{" + BASE + ',"a":2,"A":1}',
        "{" + BASE + ',"x":1,"o":{"x":2}}',
        "{" + BASE + ',"o":{"x":2},"x":1}',
    ])
    assert [q["a"] for q in p[:2]] == [2, 1]
    assert [q["x"] for q in p[2:]] == [2, 1]


def test_flatten_text_object_arrays_nulls(spark):
    body = "{" + BASE + ',"T":"{\\"Inner\\":{\\"Deep\\":5}}","Arr":[1,2],"TA":"[1,2]","N":null,"E":"","B":true}'
    q = _props(spark, [body])[0]
    assert q["deep"] == 5 and "inner" not in q and "t" not in q
    assert "arr" not in q and q["ta"] == "[1,2]"
    assert "n" not in q and "e" not in q and q["b"] is True


def test_flatten_duplicate_keys_in_one_object(spark):
    q = _props(spark, ["{" + BASE + ',"d":1,"d":2}'])[0]
    assert q["d"] == 2


def test_rules_types_and_case(spark):
    rules = [
        (1, "p1", "Num", "n_out", "0", 1), (2, "p1", "numtext", "nt_out", "0", 1),
        (3, "p1", "flag", "f_out", "1", 1), (4, "p1", "one", "one_out", "1", 1),
        (5, "p1", "s", "s_out", "2", 1), (6, "p1", "lst", "l_out", "4", 1),
        (7, "p1", "lobj", "lo_out", "4", 1), (8, "p1", "obj", "o_out", "2", 1),
        (9, "p1", "unk", "u_out", "7", 1), (10, "p1", "s", "s_last", "3", 1),
        (11, "p1", "off", "off_out", "2", 0),
    ]
    body = ("{" + BASE + ',"NUM":1.5,"numtext":" 12.5 ","flag":"true","one":3,"S":5,"lst":[1,"a"],'
            '"lobj":[{"a":1}],"obj":{"z":1},"unk":1,"off":1}')
    q = _props(spark, [body], rules)[0]
    assert q["n_out"] == 1.5 and q["nt_out"] == 12.5
    assert q["f_out"] is True and q["one_out"] is True
    assert q["s_last"] == "5" and "s_out" not in q
    assert q["l_out"] == [1, "a"] and "lo_out" not in q
    assert "o_out" not in q and "z" not in q          # ruled key over an object: dropped
    assert "u_out" not in q and q["off"] == 1         # unknown type -> NULL; invalid rule ignored


def test_rule_project_token_vs_contains(spark):
    rules = [(1, "p1", "v", "v_out", "2", 1)]
    body = ["{" + BASE + ',"project":"p10","v":1}']
    assert "v_out" not in _props(spark, body, rules)[0]
    assert _props(spark, body, rules, config=PipelineConfig(rule_match="contains"))[0]["v_out"] == "1"


def test_overlay_wins_and_lineage(spark):
    body = "{" + BASE + ',"DeviceID":"d9","$device_id":"mine","date":"x"}'
    parts = transform(raw_rows(spark, [body], keys=["k1"]), _meta(spark), PipelineConfig())
    q = json.loads(parts.select(F.to_json("properties")).first()[0])
    assert q["$device_id"] == "d9" and q["date"] == "20240101"
    assert q["RECORD_KEY"] == "k1" and q["SACONSUMEROFFSET"] == "0" and q["SACONSUMERPARTITION"] == 0
    assert q["$is_login_id"] is True


def _nested(depth, as_text=False):
    inner = '{"leaf":1}'
    for k in range(depth):
        inner = json.dumps({f"L{k}": inner}) if as_text and k % 2 else "{" + f'"L{k}":{inner}' + "}"
    return "{" + BASE + ',"O":' + inner + "}"


def test_flatten_has_no_depth_limit(spark):
    depths = [0, 1, 2, 5, 6, 7, 9, 12, 25]
    got = _props(spark, [_nested(d) for d in depths] + [_nested(d, True) for d in depths[:7]])
    assert [q.get("leaf") for q in got] == [1] * len(got)
    assert all(q.get("l0") is None for q in got)


def test_escaped_braces_and_long_numbers(spark):
    rules = [(1, "p1", "n", "n_out", "0", 1)]
    numbers = ["123456789012345678901234", "0.12345678901234567890123", "1e400", "1e300", "+7", ".5", "x", "-12.50"]
    bodies = ["{" + BASE + f',"n":"{n}"' + "}" for n in numbers]
    got = [q.get("n_out") for q in _props(spark, bodies, rules)]
    assert got[0] == 123456789012345678901234 and abs(got[1] - 0.123456789012345678) < 1e-15
    assert got[3] == 1e300 and got[4] == 7 and got[5] == 0.5 and got[6] is None and got[7] == -12.5
    escaped = "{" + BASE + ',"t":"\\u007b\\"deep\\":\\u007B\\"x\\":3}}"}'
    assert _props(spark, [escaped])[0]["x"] == 3


def test_many_keys_last_wins(spark):
    body = "{" + BASE + "," + ",".join(f'"k{i % 2500}":{i}' for i in range(5000)) + "}"
    q = _props(spark, [body])[0]
    assert q["k7"] == 2507 and q["k2499"] == 4999


def test_ten_thousand_rules_in_both_modes(spark):
    rules = [(k, f"p{k % 100}", f"f{k // 100}", f"out{k}", "2", 1) for k in range(10_000)]
    body = ["{" + BASE + ',"project":"p3,p44","f5":1,"f99":"z"}']
    for mode in ("token", "contains"):
        q = _props(spark, body, rules, config=PipelineConfig(rule_match=mode))[0]
        assert q["out544"] == "1" and q["out9944"] == "z"
