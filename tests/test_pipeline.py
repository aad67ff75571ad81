import re

import pytest
from pyspark.sql import functions as F

from eventlake import constants as C
from eventlake.plans.pipeline import run
from eventlake.sources.metadata import sample_metadata
from eventlake.sources.records import conversation_records, event_records, log_records, mixed_records
from tests.conftest import raw_rows
from tests.test_properties import BASE, _meta


def test_decode_edges(spark):
    values = [None, "not json", "123", "null", "[]", "[{" + BASE + "},{" + BASE + "}]", "{" + BASE + "}"]
    res = run(raw_rows(spark, values), _meta(spark))
    c = {(r.stage, r.project): r.cnt for r in res.counters().collect()}
    assert c[(C.STAGE_NULL, "")] == 1
    assert c[(C.STAGE_SOURCE, "")] == 6
    assert c[(C.STAGE_INVALID, "")] == 2           # the scalar and the empty array
    assert c[(C.STAGE_NEED_SPLIT, "")] == 1 and c[(C.STAGE_SPLIT, "")] == 2
    assert c[(C.STAGE_SINK, "p1")] == 5             # 2 converted '{}' + 2 parts + 1 object
    reasons = {r.offset: r.error_reason for r in res.invalid().collect()}
    assert reasons[2].startswith(C.DECODE_ERROR_PREFIX)
    assert "no part" in reasons[4]
    assert C.ERR_NO_ID in reasons[1] and C.ERR_TIME in reasons[1] and C.ERR_EVENT in reasons[1]


def test_validation_messages(spark):
    bodies = [
        '{"EventID":"v","LoginID":"  ","DeviceID":"d","Time":"2024-01-01"}',
        '{"EventID":" ","LoginID":"u","Time":"nope"}',
        '{"EventID":"v","LoginID":"' + "x" * 300 + '","Time":"2024-01-01"}',
    ]
    res = run(raw_rows(spark, bodies), _meta(spark))
    m = {r.offset: r for r in res.main().collect()}
    assert m[0].distinct_id == "d" and m[0].error_reason is None
    assert m[1].event == "" and m[1].time == 0
    assert m[1].error_reason == C.INVALID_PREFIX + C.ERR_TIME + C.ERR_SEP + C.ERR_EVENT
    assert len(m[2].distinct_id) == 255


def test_signup_and_fanout(spark):
    bodies = [
        '{"EventID":"register","LoginID":"u","DeviceID":"d7","device_id":"d7","Time":"2024-01-01"}',
        '{"EventID":"register","LoginID":"u","DeviceID":"d7","device_id":"  ","Time":"2024-01-01"}',
        '{"EventID":"Login","LoginID":"u","project":"x,y,","device_id":"q","Time":"2024-01-01"}',
    ]
    res = run(raw_rows(spark, bodies), _meta(spark, projects="p1,p2"))
    rows = res.main().collect()
    by = {}
    for r in rows:
        by.setdefault(r.offset, []).append((r.project, r.type, r.event, r.original_id))
    assert sorted(by[0]) == sorted([("p1", "track_signup", "$SignUp", "d7"), ("p2", "track_signup", "$SignUp", "d7"),
                                    ("p1", "track", "register", None), ("p2", "track", "register", None)])
    assert len(by[1]) == 2 and len(by[2]) == 4
    c = {(r.stage, r.project): r.cnt for r in res.counters().collect()}
    assert c[(C.STAGE_SIGNUP, "x")] == 1 and c[(C.STAGE_SINK, "p1")] == 2


def test_invariants_on_driver_data(spark, small_dir):
    res = run(mixed_records(spark, small_dir), sample_metadata(spark, small_dir))
    main = res.main().cache()
    counters = {(r.stage): r.cnt for r in res.counters().groupBy("stage").agg(F.sum("cnt").alias("cnt")).collect()}
    assert counters[C.STAGE_SINK] == main.filter(F.col("type") == "track").count()
    assert counters[C.STAGE_SIGNUP] == main.filter(F.col("type") == "track_signup").count()
    parts = res.parts.filter("has_part")
    assert counters[C.STAGE_SPLIT] == parts.filter("n_parts > 1").count()
    main.unpersist()


def test_drop_invalid_flag(spark, small_dir):
    res = run(event_records(spark, small_dir), sample_metadata(spark, small_dir))
    assert res.main(drop_invalid=True).filter(F.col("error_reason").isNotNull()).count() == 0
    assert res.main().filter(F.col("error_reason").isNotNull()).count() > 0


RECORDS = {"event": event_records, "mixed": mixed_records, "log": log_records, "array": conversation_records}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", RECORDS)
def test_no_shuffle_before_outputs(spark, small_dir, kind):
    """Records of any kind, also of one constant server and topic, are not moved by the lookups."""
    raw = RECORDS[kind](spark, small_dir)
    raw = raw.checkpoint()  # what the records are made of may shuffle
    plan = _plan(run(raw, sample_metadata(spark, small_dir)).main())
    # exchanges are of the rule tables alone (grouped by project and key in a subquery)
    assert set(re.findall(r"Exchange hashpartitioning\((\w+)", plan)) <= {"project"} and "RoundRobinPartitioning" not in plan
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and "CartesianProduct" not in plan
    # no wiring row has the arrays' topic: the optimizer takes that join away
    assert ("BroadcastHashJoin" in plan) == (kind != "array")
    if kind == "array":
        constant = conversation_records(spark, small_dir)  # server and topic are literals here
        plan = _plan(run(constant, sample_metadata(spark, small_dir)).main())
        assert "NestedLoop" not in plan and "Exchange hashpartitioning(server" not in plan


def test_topic_fanout_moves_no_record(spark, small_dir):
    from eventlake.operators.profile import topic_fanout, topic_projects

    recs = event_records(spark, small_dir).select("server", "topic", "partition", "offset")
    plan = _plan(topic_fanout(recs, sample_metadata(spark, small_dir).lookup(topic_projects)))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_large_lookup_is_split(spark):
    """Beyond the bytes bound the table is not broadcast and a hot key goes to several places; same rows."""
    from eventlake.operators.metadata import Lookup

    recs = spark.range(4000).selectExpr("if(id % 3 = 0, 'hot', concat('t', id % 50)) AS topic", "id AS offset", "'x' AS _slot_like")
    recs = recs.union(spark.sql("SELECT CAST(NULL AS STRING), CAST(NULL AS BIGINT), 'x'"))
    table = spark.range(40).selectExpr("if(id = 0, 'hot', concat('t', id)) AS name", "concat('p', id) AS lists")
    small, large = Lookup.of(table), Lookup.of(table, max_bytes=10)
    assert small.small and not large.small
    got = [sorted(map(str, lookup.attach(recs, {"topic": "name"}, F.col("offset")).collect())) for lookup in (small, large)]
    assert got[0] == got[1] and len(got[0]) == 4001
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would put these few rows together again
    try:
        joined = large.attach(recs, {"topic": "name"}, F.col("offset"))
        plan = _plan(joined)
        assert "BroadcastHashJoin" not in plan and "pmod" in plan
        places = joined.where("topic = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
        assert places > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_registered_plugins(spark):
    """A converter, a processor and a post processor of the user's own, chosen by routes."""
    from eventlake.operators import decode, events, split

    decode.register_converter("pipes", lambda text, config: F.to_json(F.struct(F.split(text, "[|]")[0].alias("who"), F.split(text, "[|]")[1].alias("what"))))
    split.register_processor("pipes", {"login_id": "who", "event_name": "what"})
    events.register_post("never", lambda base: F.lit(False))
    try:
        meta = _meta(spark)
        meta.routes = spark.createDataFrame([("kafka-a:9092", "t_click", "pipes", "pipes", "never")], "server string, topic string, converter string, processor string, post_processor string")
        res = run(raw_rows(spark, ["ann|register", '{"who":"bob","what":"register","device_id":"d"}']), meta)
        assert sorted((r.distinct_id, r.event, r.type) for r in res.main().collect()) == [("ann", "register", "track"), ("bob", "register", "track")]
    finally:
        del decode.CONVERTERS["pipes"], split.PROCESSORS["pipes"], events.POSTS["never"]


def test_consumer_plan(spark, small_dir):
    """A12 and A9 agree: a source's plan holds its projects with their topics."""
    from eventlake.operators.metadata import consumer_plan, source_topics

    meta = sample_metadata(spark, small_dir)
    topics = {r.source_server_port: r.topics.split(",") for r in source_topics(meta).collect()}
    plan = {r.source_server_port: r.projects for r in consumer_plan(meta).collect()}
    assert set(plan) == set(topics)
    for server, projects in plan.items():
        assert sorted({t for p in projects for t in p.topics}) == topics[server]
        assert [p.sink_project_id for p in projects] == sorted(p.sink_project_id for p in projects)
