"""Catalog of named queries over the driver tables.

Each query takes (spark, data_dir) and returns a DataFrame whose columns
match the oracle SQL of the same name in `eventlake.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.config import PipelineConfig
from eventlake.session import ensure_checkpoint_dir, shared_folder
from eventlake.constants import TIME_PATTERNS, VERSION_TAG
from eventlake.functions.time import day_text, parse_wall_clock, wall_clock_to_millis
from eventlake.operators import events as E
from eventlake.operators import metadata as M
from eventlake.plans import oracle as O
from eventlake.plans.pipeline import offset_positions, run, stage_counters, transform
from eventlake.sources.metadata import ROUTE_SCHEMA, local_table, sample_metadata
from eventlake.functions import time as T
from eventlake.operators import positions as P
from eventlake.operators.counters import merge_counters
from eventlake.operators.decode import decode
from eventlake.operators.extras import (
    ImportConfig, daily_unique_users, drop_blacklisted, import_delimited, import_files, module_star_join, route_topics,
)
from eventlake.operators.uniques import UniqueUsers
from eventlake.operators.profile import profile_rows, topic_fanout, topic_projects
from eventlake.functions.json import at_pointer, to_node
from eventlake.sources.kafka import union_clusters
from eventlake.sources.metadata import routes_from_properties, sample_blacklist, sample_modules
from eventlake.sources.records import (
    SERVER_A, SERVER_B, bank_new_records, conversation_records, customer_records, deep_records, event_records, log_records, mixed_records,
    packed_records, user_records,
)
from eventlake.sources.tables import read_table
from eventlake.streaming import state as S
from eventlake.streaming.runner import read_raw_files

Query = Callable[[SparkSession, str], DataFrame]


#: Rows of a source table that one task parses; a table of more rows is dealt to more tasks than cores.
ROWS_PER_TASK = 100_000


def _config(spark: SparkSession, data_dir: str, table: str = "events", **options) -> PipelineConfig:
    """The driver tables are a few small files: their records are dealt to all cores
    before parsing, and to more tasks as the table (counted from its footers) grows.
    `eventlake.input.partitions` sets the number, 0 leaves them as read."""
    given = spark.conf.get("eventlake.input.partitions", None)
    if given is not None:
        return PipelineConfig(input_partitions=int(given) or None, **options)
    n = max(spark.sparkContext.defaultParallelism, -(-read_table(spark, data_dir, table).count() // ROWS_PER_TASK))
    return PipelineConfig(input_partitions=n, **options)


def _events_result(spark: SparkSession, data_dir: str, config: PipelineConfig | None = None):
    return run(event_records(spark, data_dir), sample_metadata(spark, data_dir), config or _config(spark, data_dir))


def event_normalize(spark: SparkSession, data_dir: str) -> DataFrame:
    """Flagship: event records -> main output."""
    main = _events_result(spark, data_dir).main()
    return main.select(
        "server", "topic", "partition", "offset", "project", "type", "event", "distinct_id",
        "time", "date", "original_id", "error_reason",
    )


def project_fanout(spark: SparkSession, data_dir: str) -> DataFrame:
    """Copies per record and project."""
    main = _events_result(spark, data_dir).main()
    return main.groupBy("server", "topic", "partition", "offset", "project").agg(F.count("*").alias("copies"))


def signup_derive(spark: SparkSession, data_dir: str) -> DataFrame:
    """The derived $SignUp rows."""
    main = _events_result(spark, data_dir).main()
    return main.filter(F.col("type") == "track_signup").select(
        "server", "topic", "partition", "offset", "project", "distinct_id", "original_id"
    )


def validate_invalid(spark: SparkSession, data_dir: str) -> DataFrame:
    """The invalid output with reasons."""
    inv = _events_result(spark, data_dir).invalid()
    return inv.select("server", "topic", "partition", "offset", "part_index", "error_reason")


def wiring_group(spark: SparkSession, data_dir: str) -> DataFrame:
    """Topics per (server, group, auth, project)."""
    return M.project_topics(sample_metadata(spark, data_dir))


def sink_projects_query(spark: SparkSession, data_dir: str) -> DataFrame:
    """Project list per (server, group, topic)."""
    return M.sink_projects(sample_metadata(spark, data_dir))


def time_parse_patterns(spark: SparkSession, data_dir: str) -> DataFrame:
    """P20 P25: order dates written in the nine patterns (and one unreadable text)."""
    o = read_table(spark, data_dir, "orders", ["o_orderkey", "o_orderdate"])
    k = F.col("o_orderkey")
    text = F.when(k % 10 == 9, F.lit("31/12/1999"))
    for i, p in enumerate(TIME_PATTERNS):
        text = text.when(k % 10 == i, F.date_format("o_orderdate", p))
    zone = PipelineConfig().time_zone
    ms = F.coalesce(wall_clock_to_millis(parse_wall_clock(text), zone), F.lit(0).cast("bigint"))
    return o.select(
        "o_orderkey", (k % 10).cast("int").alias("pattern_no"), ms.alias("time"), day_text(ms, zone).alias("date")
    )


def _prop_text(name: str):
    return F.try_variant_get(F.col("properties")[name], "$", "string")


def _prop_double(name: str):
    return F.try_variant_get(F.col("properties")[name], "$", "double")


def _prop_keys():
    return F.array_join(F.sort_array(F.map_keys("properties")), ",")


def _event_parts(spark: SparkSession, data_dir: str, config: PipelineConfig | None = None,
                 with_rules: bool = True) -> DataFrame:
    meta = sample_metadata(spark, data_dir, with_rules=with_rules)
    return transform(event_records(spark, data_dir), meta, config or _config(spark, data_dir)).filter(F.col("has_part"))


def rule_rename_cast(spark: SparkSession, data_dir: str) -> DataFrame:
    """J4 P16 P17 (D3/D5 fixed): property keys and typed values after the rules."""
    p = _event_parts(spark, data_dir)
    return p.select(
        "server", "partition", "offset", "project_list", _prop_keys().alias("prop_keys"),
        _prop_text("name").alias("p_name"), _prop_text("page_name").alias("p_page_name"),
        _prop_double("order_amount").alias("p_order_amount"), _prop_double("amount_af").alias("p_amount_af"),
        F.try_variant_get(F.col("properties")["pos_x"], "$", "boolean").alias("p_pos_x"),
        _prop_text("k_text").alias("p_k_text"), _prop_double("app_ver").alias("p_app_ver"),
        F.to_json(F.col("properties")["tag_list"]).alias("p_tag_list"),
    )


def rule_match_contains(spark: SparkSession, data_dir: str) -> DataFrame:
    """J4 with the reference's substring project match (D3 'ref')."""
    p = _event_parts(spark, data_dir, _config(spark, data_dir, rule_match="contains"))
    return p.select("server", "partition", "offset", "project_list", _prop_keys().alias("prop_keys"))


def flatten_properties_query(spark: SparkSession, data_dir: str) -> DataFrame:
    """P15 P23-P26 without rules: every property as typed key/value rows."""
    p = _event_parts(spark, data_dir, with_rules=False)
    # inline(map_entries) instead of explode(map): the same rows, several times faster here
    kv = p.select("server", "partition", "offset", F.inline(F.map_entries("properties"))).withColumnsRenamed(
        {"value": "v"})
    sv = F.schema_of_variant("v")
    return kv.select(
        "server", "partition", "offset", "key",
        F.when(sv == "STRING", F.try_variant_get("v", "$", "string")).alias("v_text"),
        F.when(~sv.isin("STRING", "BOOLEAN"), F.try_variant_get("v", "$", "double")).alias("v_num"),
        F.when(sv == "BOOLEAN", F.try_variant_get("v", "$", "boolean")).alias("v_bool"),
    )


def _mixed_parts(spark: SparkSession, data_dir: str) -> DataFrame:
    return transform(mixed_records(spark, data_dir), sample_metadata(spark, data_dir), _config(spark, data_dir))


def json_decode_fallback(spark: SparkSession, data_dir: str) -> DataFrame:
    """P1-P4 P7 P8 P12 (D4, D12): what became of every record."""
    p = _mixed_parts(spark, data_dir).filter(F.col("part_index").isNull() | (F.col("part_index") == 0))
    converted = F.col("value_text").isNotNull() & (F.col("body_text") != F.col("value_text"))
    outcome = (
        F.when(F.col("is_null"), "null").when(F.col("decode_error").isNotNull(), "scalar")
        .when(F.col("n_parts") == 0, "empty").when(F.col("n_parts") > 1, "split")
        .when(converted, "converted").otherwise("object")
    )
    return p.select("server", "partition", "offset", outcome.alias("outcome"), "n_parts",
                    F.when(converted, F.col("body_text")).alias("body"))


def stage_counters_query(spark: SparkSession, data_dir: str) -> DataFrame:
    """A5: stage counters over records with every decode edge."""
    return stage_counters(_mixed_parts(spark, data_dir))


def offset_audit(spark: SparkSession, data_dir: str) -> DataFrame:
    """A4 (D6 fixed): largest offset per partition read."""
    return offset_positions(mixed_records(spark, data_dir))


# ---- restart positions over the event records -------------------------------

def _ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


def _positions(spark: SparkSession, data_dir: str):
    source = event_records(spark, data_dir).select(
        "server", "consumer_group", "topic", "partition", "offset", "timestamp")
    audit = P.audit_rows(source.filter(F.col("timestamp") < _ts(O.CKPT_CUT)))
    ckpt = P.latest_checkpoint(audit)
    lags = P.lag(ckpt, P.end_offsets(source))
    return source, ckpt, lags


def _sink(spark: SparkSession, data_dir: str) -> DataFrame:
    """Sink rows: the main output of the records read before SINK_CUT, placed in
    8 sink partitions with increasing offsets."""
    raw = event_records(spark, data_dir).filter(F.col("timestamp") < _ts(O.SINK_CUT))
    main = run(raw, sample_metadata(spark, data_dir), _config(spark, data_dir)).main()
    sink = main.withColumns({
        "sink_partition": F.col("partition") + F.when(F.col("server") == SERVER_B, 4).otherwise(0),
        "sink_offset": F.col("offset") * 16 + F.col("project_index") * 2 + F.col("kind_index"),
    })
    # The sink is a stored topic/table in production.  Here its narrow columns (lineage
    # properties and positions) are written once to the shared checkpoint folder
    # instead of running the pipeline again for the tail, its end offsets and the anti-join.
    lineage = F.map_filter("properties", lambda k, v: k.startswith("SACONSUMER"))
    ensure_checkpoint_dir(spark)
    return sink.select("server", "topic", "partition", "offset", "sink_partition", "sink_offset",
                       lineage.alias("properties")).checkpoint()


def _sink_positions(spark: SparkSession, data_dir: str, lags: DataFrame) -> DataFrame:
    rows_back = lags.select(F.sum("lag")).scalar()
    return P.lineage_positions(P.sink_tail(_sink(spark, data_dir), rows_back))


def latest_checkpoint(spark: SparkSession, data_dir: str) -> DataFrame:
    """Offset audit per checkpoint, then the latest position per partition."""
    _, ckpt, _ = _positions(spark, data_dir)
    return ckpt


def replay_lag(spark: SparkSession, data_dir: str) -> DataFrame:
    """Lag per topic, per server and in total."""
    _, _, lags = _positions(spark, data_dir)
    return P.lag_rollup(lags)


def sink_tail_max(spark: SparkSession, data_dir: str) -> DataFrame:
    """Largest source offset found in the tail of every sink partition."""
    _, _, lags = _positions(spark, data_dir)
    return _sink_positions(spark, data_dir, lags)


def resume_position(spark: SparkSession, data_dir: str) -> DataFrame:
    """The position each partition resumes from."""
    _, _, lags = _positions(spark, data_dir)
    return P.resume_positions(lags, _sink_positions(spark, data_dir, lags))


def replay_anti_join(spark: SparkSession, data_dir: str) -> DataFrame:
    """Records after the checkpoint that the sink does not hold yet."""
    source, ckpt, _ = _positions(spark, data_dir)
    sink_keys = _sink(spark, data_dir).select("server", "topic", "partition", "offset")
    return P.replay_rows(source, ckpt, sink_keys).select("server", "topic", "partition", "offset")


def start_by_timestamp(spark: SparkSession, data_dir: str) -> DataFrame:
    """Earliest offset at or after a start time, per partition."""
    source = event_records(spark, data_dir).select("server", "topic", "partition", "offset", "timestamp")
    return P.start_by_timestamp(source, _ts(O.START_TS))


def counter_merge(spark: SparkSession, data_dir: str) -> DataFrame:
    """Totals of an earlier snapshot merged with the counts of later records."""
    raw = mixed_records(spark, data_dir)
    meta = sample_metadata(spark, data_dir)
    cut = _ts("2024-01-15 00:00:00")
    old = stage_counters(transform(raw.filter(F.col("timestamp") < cut), meta, _config(spark, data_dir)))
    delta = stage_counters(transform(raw.filter(F.col("timestamp") >= cut), meta, _config(spark, data_dir)))
    return merge_counters(old, delta)


def source_topics_query(spark: SparkSession, data_dir: str) -> DataFrame:
    """Distinct topics per (server, group, auth)."""
    return M.source_topics(sample_metadata(spark, data_dir))


def _written_sink(spark: SparkSession, data_dir: str) -> DataFrame:
    """The sink as written: JSON values in 8 partitions whose offsets have gaps; every 29th
    record's values are cut off and cannot be read."""
    raw = event_records(spark, data_dir).filter(F.col("timestamp") < _ts(O.SINK_CUT))
    main = run(raw, sample_metadata(spark, data_dir), _config(spark, data_dir)).main()
    value = E.event_json(main)
    path = shared_folder(spark, "written-sink")
    main.select(
        (F.col("partition") + F.when(F.col("server") == SERVER_B, 4).otherwise(0)).alias("sink_partition"),
        (F.col("offset") * 16 + F.col("project_index") * 2 + F.col("kind_index")).alias("sink_offset"),
        F.when(F.col("offset") % 29 == 0, F.left(value, F.lit(60))).otherwise(value).alias("value"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def sink_last_rows(spark: SparkSession, data_dir: str) -> DataFrame:
    """Exactly the last 100 rows of every sink partition, although offsets have gaps."""
    sink = _sink(spark, data_dir)
    return P.last_rows(sink, O.LAST_N).select("sink_partition", "sink_offset", "server", "topic", "partition", "offset")


def sink_json_positions(spark: SparkSession, data_dir: str) -> DataFrame:
    """Source positions read from the JSON text of the last 100 rows of every sink partition."""
    return P.json_positions(P.last_rows(_written_sink(spark, data_dir), O.LAST_N))


def sink_unreadable(spark: SparkSession, data_dir: str) -> DataFrame:
    """Rows of the written sink that give no position, with the reason."""
    rows = P.json_lineage(_written_sink(spark, data_dir))
    return rows.where("unreadable IS NOT NULL").select("sink_partition", "sink_offset", "unreadable")


def starting_offsets(spark: SparkSession, data_dir: str) -> DataFrame:
    """The offset every partition is next read from."""
    return P.starting_offsets(resume_position(spark, data_dir))


def main_json(spark: SparkSession, data_dir: str) -> DataFrame:
    """The written JSON value read back; empty head fields are left out."""
    main = _events_result(spark, data_dir).main()
    head = "struct<distinct_id:string,time:bigint,project:string,type:string,event:string,original_id:string>"
    value = main.select("server", "topic", "partition", "offset", E.event_json(main).alias("value"))
    return value.withColumn("v", F.from_json("value", head)).select(
        "server", "topic", "partition", "offset", "v.*",
        F.array_join(F.sort_array(F.array_remove(F.json_object_keys("value"), "properties")), ",").alias("keys"))


def invalid_json(spark: SparkSession, data_dir: str) -> DataFrame:
    """The invalid record's JSON value read back: lineage, reason, tag and the whole record."""
    inv = _events_result(spark, data_dir).invalid()
    shape = ("struct<record:string,server:string,topic:string,partition:int,offset:bigint,"
             "ERROR_REASON:string,VERSION_TAG:string>")
    v = inv.withColumn("v", F.from_json(E.invalid_json(), shape)).select("record", "v")
    return v.select(
        "v.server", "v.topic", "v.partition", "v.offset", F.col("v.ERROR_REASON").alias("error_reason"),
        (F.col("v.VERSION_TAG") == F.lit(VERSION_TAG)).alias("tagged"), (F.col("v.record") == F.col("record")).alias("whole"))


def flatten_deep(spark: SparkSession, data_dir: str) -> DataFrame:
    """Leaves under 6 to 12 objects, every second one with its inner part as
    text, and numeric text of 24 digits under a NUMBER rule."""
    parts = transform(deep_records(spark, data_dir), sample_metadata(spark, data_dir), _config(spark, data_dir)).filter(F.col("has_part"))
    return parts.select("server", "partition", "offset", _prop_text("leaf").cast("bigint").alias("leaf"),
                        _prop_text("order_amount").alias("order_amount"))


# ---- state kept by streams -----------------------------------------------------

#: The records of the streams below are delivered in three loads, each a run that begins at the checkpoint of the one before.
LOADS = ("2024-01-10 00:00:00", "2024-01-20 00:00:00")


def _loads(raw: DataFrame, path: str):
    """Land the records load by load; yields after each one."""
    at = F.coalesce(F.col("timestamp"), _ts("1970-01-01 00:00:00"))
    for i, (low, high) in enumerate(zip((None, *LOADS), (*LOADS, None), strict=True)):
        load = raw if low is None else raw.filter(at >= _ts(low))
        load = load if high is None else load.filter(at < _ts(high))
        load.write.parquet(f"{path}/load={i}")
        yield i


def running_positions(spark: SparkSession, data_dir: str) -> DataFrame:
    """A4 S9 in the stream: largest offsets over three runs, read back from the state."""
    work = shared_folder(spark, "running-positions")
    raw = mixed_records(spark, data_dir).withColumn("value", F.lit(None).cast("binary"))
    for _ in _loads(raw, f"{work}/in"):
        stream = read_raw_files(S.state_session(spark, 8), f"{work}/in/*")
        S.start_updates(S.running_positions(stream), f"{work}/out", f"{work}/checkpoint", available_now=True).awaitTermination()
    return S.positions_from_state(spark, f"{work}/checkpoint")


def running_totals(spark: SparkSession, data_dir: str) -> DataFrame:
    """A6 S10 in the stream: stage counts over three runs; the newest of each key's emitted totals."""
    work = shared_folder(spark, "running-totals")
    config = _config(spark, data_dir)
    for _ in _loads(mixed_records(spark, data_dir), f"{work}/in"):
        own = S.state_session(spark, 8)
        rows = S.running_totals(read_raw_files(own, f"{work}/in/*"), sample_metadata(own, data_dir).snapshot(), config)
        S.start_updates(rows, f"{work}/out", f"{work}/checkpoint", available_now=True).awaitTermination()
    return S.latest(spark, f"{work}/out", S.COUNTER_KEY, "cnt")


def replay_stream(spark: SparkSession, data_dir: str) -> DataFrame:
    """R6 in the stream: the sink holds some records; after a restart all records beyond the
    checkpoint are delivered again, and those that the state has seen do not come out."""
    work = shared_folder(spark, "replay-stream")
    source, ckpt, _ = _positions(spark, data_dir)
    after = P.after_checkpoint(source, ckpt)
    held = _sink(spark, data_dir).select(*S.REPLAY_KEY)
    for i, rows in enumerate((held, after.select(*S.REPLAY_KEY))):
        rows.withColumn("delivery", F.lit(i)).write.parquet(f"{work}/in/load={i}")
        stream = S.state_session(spark, 8).readStream.schema(
            "server string, topic string, partition int, offset bigint, delivery int").parquet(f"{work}/in/*")
        S.start_append(S.without_replays(stream), f"{work}/out", f"{work}/checkpoint", available_now=True).awaitTermination()
    return spark.read.parquet(f"{work}/out").filter("delivery = 1").select(*S.REPLAY_KEY)


# ---- splits and converters ---------------------------------------------------

def log_split(spark: SparkSession, data_dir: str) -> DataFrame:
    """Bank "old" records, LOG text cut at '[' and split into parts."""
    parts = transform(log_records(spark, data_dir), sample_metadata(spark, data_dir), _config(spark, data_dir, "orders"))
    return parts.filter(F.col("has_part")).select(
        "server", "offset", "partition", "part_index", "n_parts", "event", "distinct_id", "time")


def array_split(spark: SparkSession, data_dir: str) -> DataFrame:
    """Records that are JSON arrays split into their elements."""
    parts = transform(conversation_records(spark, data_dir), sample_metadata(spark, data_dir), _config(spark, data_dir, "conversations"))
    text = F.try_variant_get(F.col("properties")["text"], "$", "string")
    return parts.filter(F.col("has_part")).select(
        "offset", "part_index", "n_parts", "event", "distinct_id", F.length(text).alias("text_chars"))


def record_fields_new(spark: SparkSession, data_dir: str) -> DataFrame:
    """Bank "new" records, whose named fields are LogType and CustID."""
    parts = transform(bank_new_records(spark, data_dir), sample_metadata(spark, data_dir), _config(spark, data_dir, "orders"))
    return parts.filter(F.col("has_part")).select(
        "server", "partition", "offset", "processor", "event", "distinct_id", "time", "src_app_version")


def signup_by_route(spark: SparkSession, data_dir: str) -> DataFrame:
    """Sign-ups where server A's t_signup topic is routed to the stricter post processor."""
    meta = sample_metadata(spark, data_dir)
    own = local_table(spark, [(SERVER_A, "t_signup", None, None, "loginDevicePost")], ROUTE_SCHEMA)
    meta = M.Metadata(meta.source_sink, meta.project_task, meta.trans_rule, meta.routes.union(own))
    main = run(event_records(spark, data_dir), meta, _config(spark, data_dir)).main()
    return main.filter(F.col("type") == "track_signup").select(
        "server", "topic", "partition", "offset", "project", "distinct_id", "original_id")


def delimited_decode(spark: SparkSession, data_dir: str) -> DataFrame:
    """U+0001-delimited text turned into an object by the routed converter."""
    dec = decode(customer_records(spark, data_dir), sample_metadata(spark, data_dir).routes)
    m = F.from_json("body_text", "map<string,string>")
    return dec.select(
        "offset", m["fn1"].alias("fn1"), m["fn2"].alias("fn2"), m["fn3"].cast("double").alias("fn3_num"),
        m["fn4"].alias("fn4"), F.size(m).alias("n_fields"))


def binary_decode(spark: SparkSession, data_dir: str) -> DataFrame:
    """§2.11 P7: packed binary records read by the batch converter of their route (server A's), with
    the errors of those that it cannot read; server B has no such route."""
    meta = sample_metadata(spark, data_dir)
    routes = meta.routes.union(local_table(spark, [(SERVER_A, "t_packed", "packedEvent", None, None)], ROUTE_SCHEMA))
    dec = decode(packed_records(spark, data_dir).union(event_records(spark, data_dir)), routes)
    m = F.from_json("body_text", "map<string,string>")
    return dec.filter(F.col("topic") == "t_packed").select(
        "server", "partition", "offset", m["EventID"].alias("event"), m["LoginID"].alias("login"), m["Time"].alias("at"),
        m["Amount"].cast("double").alias("amount"), "decode_error")


# ---- dormant, config-only and schema-only items -----------------------------

def profile_set(spark: SparkSession, data_dir: str) -> DataFrame:
    """Profile rows from user records."""
    prof = profile_rows(user_records(spark, data_dir), "UserID", "Time", "project")
    return prof.select(
        "offset", "distinct_id", "time", "project", "type",
        F.try_variant_get(F.col("properties")["pa_userid"], "$", "string").alias("pa_userid"),
        F.try_variant_get(F.col("properties")["$is_login_id"], "$", "boolean").alias("is_login_id"))


def topic_fanout_query(spark: SparkSession, data_dir: str) -> DataFrame:
    """Fan-out by topic only."""
    meta = sample_metadata(spark, data_dir)
    recs = event_records(spark, data_dir).select("server", "topic", "partition", "offset")
    return topic_fanout(recs, meta.lookup(topic_projects)).select("server", "partition", "offset", "project")


def module_star_join_query(spark: SparkSession, data_dir: str) -> DataFrame:
    """Events LEFT JOIN module (levels 1-3), page and tag dimensions."""
    events, modules, pages, tags = sample_modules(spark, data_dir)
    out = module_star_join(events, modules, pages, tags)
    return out.select("l_orderkey", "l_linenumber", "classify1_name", "classify2_name", "classify3_name",
                      "page_name", "tag_name")


def day_bounds(spark: SparkSession, data_dir: str) -> DataFrame:
    """Date helpers: epoch millis in the zone, day start/end, epoch day, second floor."""
    zone = PipelineConfig().time_zone
    o = read_table(spark, data_dir, "orders", ["o_orderkey", "o_orderdate"])
    w = F.timestamp_add("MILLISECOND", (F.col("o_orderkey") * 7919) % 86400000, F.col("o_orderdate"))
    ms = wall_clock_to_millis(w, zone)
    return o.select(
        "o_orderkey", ms.alias("ms"), T.day_start_millis(ms, zone).alias("day_start_ms"),
        T.day_end_millis(ms, zone).alias("day_end_ms"),
        F.unix_date(F.to_date(T.millis_to_wall_clock(ms, zone))).alias("epoch_day"),
        T.second_floor_millis(ms).cast("bigint").alias("second_ms"))


def daily_uv(spark: SparkSession, data_dir: str) -> DataFrame:
    """Distinct users per project and day."""
    return daily_unique_users(_events_result(spark, data_dir).main())


def monthly_uv(spark: SparkSession, data_dir: str) -> DataFrame:
    """Distinct users per project and month, merged from the stored days of two loads."""
    main = _events_result(spark, data_dir).main().select("project", "type", "date", "distinct_id", "time")
    store = UniqueUsers(spark, shared_folder(spark, "unique-users"))
    cut = F.unix_millis(F.lit(LOADS[0]).cast("timestamp"))
    store.add(main.filter(F.col("time") < cut), 0)
    store.add(main.filter(F.col("time") >= cut), 1)
    return store.monthly()


def event_blacklist(spark: SparkSession, data_dir: str) -> DataFrame:
    """Main rows without blacklisted (project, event) pairs."""
    main = _events_result(spark, data_dir).main()
    kept = drop_blacklisted(main, sample_blacklist(spark))
    return kept.select("server", "partition", "offset", "project", "type", "event")


SPLITS = [
    ("tp_a", "p_asia", "$app_version", "1.0", None, None, None, None, 1),
    ("tp_b", "p_europe", "$app_version", "1.1", "SACONSUMERPARTITION", "2", None, None, 1),
    ("tp_c", "p_asia", "$app_version", "1.0", "SACONSUMERPARTITION", "0", "SACONSUMERTOPIC", "t_click", 1),
    ("tp_d", "p_asia", "$app_version", "1.0", None, None, None, None, 0),
]
SPLIT_SCHEMA = "sink_topic string, sink_project_id string, " + "".join(
    f"source_field_{n} string, source_field_value_{n} string, " for n in (1, 2, 3)) + "valid_flag int"


def topic_route(spark: SparkSession, data_dir: str) -> DataFrame:
    """Main rows routed to topics by project and field values."""
    out = route_topics(_events_result(spark, data_dir).main(), local_table(spark, SPLITS, SPLIT_SCHEMA))
    return out.select("server", "topic", "partition", "offset", "project", "type", "sink_topic")


def delimited_import(spark: SparkSession, data_dir: str) -> DataFrame:
    """Delimited customer lines (a header line each time the key is a multiple of 100) as events."""
    c = read_table(spark, data_dir, "customer", ["c_custkey", "c_name", "c_acctbal", "c_nationkey"])
    k = F.col("c_custkey")
    line = F.concat_ws("|", F.when(k % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("c"), k)),
                       F.when(k % 11 == 0, F.lit("never")).otherwise(F.lit("2024-01-02 03:04:05")),
                       F.concat(F.lit('"'), F.col("c_name"), F.lit('|x"')), F.col("c_acctbal").cast("string"),
                       F.when(F.col("c_nationkey") % 2 == 0, F.lit("true")).otherwise(F.lit("maybe")))
    lines = c.select(k.cast("bigint").alias("line_no"), F.when(k % 100 == 0, F.lit("uid|at|name|balance|even")).otherwise(line).alias("value"))
    config = ImportConfig("p_import", "customer", (("uid", "String"), ("at", "Date"), ("name", "String"), ("balance", "Long"), ("even", "Boolean")),
                          "uid", "at", separator="|", header=True)
    return import_delimited(lines, config).select(
        "line_no", "distinct_id", "time", "project", "event", "error_reason", _prop_text("name").alias("name"),
        _prop_double("balance").alias("balance"), F.try_variant_get(F.col("properties")["even"], "$", "boolean").alias("even"))


def file_import_counts(spark: SparkSession, data_dir: str) -> DataFrame:
    """Three imports of delimited files (separators, header flag, lines of the wrong
    length, values of the wrong type) with the counts that their writes took."""
    work = shared_folder(spark, "file-import")
    c = read_table(spark, data_dir, "customer", ["c_custkey", "c_name", "c_acctbal", "c_nationkey"])
    k = F.col("c_custkey")
    line = F.concat_ws("|", F.when(k % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("c"), k)),
                       F.when(k % 11 == 0, F.lit("never")).otherwise(F.lit("2024-01-02 03:04:05")), F.concat(F.lit('"'), F.col("c_name"), F.lit('|x"')),
                       F.when(k % 5 == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string")), F.when(F.col("c_nationkey") % 2 == 0, F.lit("true")).otherwise(F.lit("maybe")))
    c.select(F.when(k % 13 == 0, F.lit("short|line")).when(k % 17 == 0, F.concat(line, F.lit("|more"))).otherwise(line)).write.text(f"{work}/customer")
    o = read_table(spark, data_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    o.select(F.concat(F.lit("c"), "o_custkey").alias("uid"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("at"),
             F.when(F.col("o_orderkey") % 4 == 0, F.lit("free")).otherwise(F.col("o_totalprice").cast("string")).alias("price")).write.csv(f"{work}/orders", sep=",", header=True)
    s = read_table(spark, data_dir, "supplier", ["s_suppkey", "s_name"])
    s.select(F.concat_ws(";", F.concat(F.lit("s"), "s_suppkey"), F.lit("2024/01/02"), "s_name")).write.text(f"{work}/supplier")
    jobs = {
        "customer": ImportConfig("p_import", "customer", (("uid", "String"), ("at", "Date"), ("name", "String"), ("balance", "Long"), ("even", "Boolean")), "uid", "at", separator="|"),
        "orders": ImportConfig("p_import", "order", (("uid", "String"), ("at", "Date"), ("price", "Integer")), "uid", "at", header=True),
        "supplier": ImportConfig("p_import", "supplier", (("uid", "String"), ("at", "Date"), ("name", "String")), "uid", "at", separator=";"),
    }
    rows = []
    for name, config in jobs.items():
        n = import_files(spark, f"{work}/{name}", config, f"{work}/out/{name}")
        rows.append((name, n.read_count, n.process_count, n.invalid_count, n.bad_count, n.typed_out))
    return local_table(spark, rows, "import string, read_count bigint, process_count bigint, invalid_count bigint, bad_count bigint, typed_out bigint")


# ---- small helpers on whole tables -----------------------------------------------

def consumer_plan(spark: SparkSession, data_dir: str) -> DataFrame:
    """Per (server, group, auth) its projects with their topics, as text."""
    plan = M.consumer_plan(sample_metadata(spark, data_dir))
    text = F.array_join(F.transform("projects", lambda p: F.concat(p["sink_project_id"], F.lit(":"), F.array_join(p["topics"], "+"))), ",")
    return plan.select("source_server_port", "source_group_id", "source_sasl_jaas", text.alias("projects"))


def cluster_union(spark: SparkSession, data_dir: str) -> DataFrame:
    """The records of two clusters, stamped with their server and group, as one table."""
    raw = event_records(spark, data_dir)
    parts = [(raw.filter(F.col("server") == s).drop("server", "consumer_group"), s, g) for s, g in ((SERVER_A, "etl"), (SERVER_B, "etl-b"))]
    return union_clusters(parts).groupBy("server", "consumer_group", "topic").agg(
        F.count("*").alias("records"), F.max("offset").alias("last"), F.sum(F.length("value")).isNotNull().alias("has_text"))


def routes_by_property(spark: SparkSession, data_dir: str) -> DataFrame:
    """Routes named by job properties, whose keys write the server's colon as a dot."""
    meta = sample_metadata(spark, data_dir)
    props = {f"processor.{s.replace(':', '.')}.t_bank_new": "corpBankNewEvent" for s in (SERVER_A, SERVER_B)}
    meta.routes = routes_from_properties(spark, [(SERVER_A, "t_bank_new"), (SERVER_B, "t_bank_new"), (SERVER_A, "t_view")], props)
    parts = transform(bank_new_records(spark, data_dir), meta, _config(spark, data_dir, "orders"))
    return parts.filter(F.col("has_part")).select(
        "server", "partition", "offset", "processor", "event", "distinct_id", "time", "src_app_version")


def date_checks(spark: SparkSession, data_dir: str) -> DataFrame:
    """Date helpers: whether a text can be read by a pattern; calendar days between two instants."""
    zone = PipelineConfig().time_zone
    o = read_table(spark, data_dir, "orders", ["o_orderkey", "o_orderdate"])
    k = F.col("o_orderkey")
    text = F.when(k % 7 == 0, F.date_format("o_orderdate", "yyyy-MM-dd'x'")).when(k % 7 == 1, F.lit("2024-02-30")).when(
        k % 7 == 2, F.lit(None).cast("string")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    start = wall_clock_to_millis(F.timestamp_add("MILLISECOND", (k * 7919) % 86400000, F.col("o_orderdate")), zone)
    end = start + (k % 11 - 5) * 3600_000 * 13
    return o.select("o_orderkey", T.is_valid_date(text, "yyyy-MM-dd").alias("valid"), T.days_between(start, end, zone).alias("days"))


def map_to_node(spark: SparkSession, data_dir: str) -> DataFrame:
    """JSON helper: a map as one JSON value, read back by pointers."""
    c = read_table(spark, data_dir, "customer", ["c_custkey", "c_name", "c_nationkey"])
    entries = F.when(F.col("c_custkey") % 9 != 0, F.create_map(
        F.lit("name"), F.col("c_name"), F.concat(F.lit("n/"), "c_nationkey"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_custkey").cast("string"))))
    node = to_node(entries)
    return c.select("c_custkey", at_pointer(node, "/name").alias("name"), F.array_join(F.array_sort(F.json_object_keys(F.to_json(node))), ",").alias("keys"))


QUERIES: dict[str, Query] = {
    "event_normalize": event_normalize,
    "project_fanout": project_fanout,
    "signup_derive": signup_derive,
    "validate_invalid": validate_invalid,
    "wiring_group": wiring_group,
    "sink_projects": sink_projects_query,
    "time_parse_patterns": time_parse_patterns,
    "rule_rename_cast": rule_rename_cast,
    "rule_match_contains": rule_match_contains,
    "flatten_properties": flatten_properties_query,
    "json_decode_fallback": json_decode_fallback,
    "stage_counters": stage_counters_query,
    "offset_audit": offset_audit,
    "latest_checkpoint": latest_checkpoint,
    "replay_lag": replay_lag,
    "sink_tail_max": sink_tail_max,
    "resume_position": resume_position,
    "replay_anti_join": replay_anti_join,
    "start_by_timestamp": start_by_timestamp,
    "counter_merge": counter_merge,
    "source_topics": source_topics_query,
    "starting_offsets": starting_offsets,
    "main_json": main_json,
    "invalid_json": invalid_json,
    "flatten_deep": flatten_deep,
    "log_split": log_split,
    "array_split": array_split,
    "record_fields_new": record_fields_new,
    "signup_by_route": signup_by_route,
    "delimited_decode": delimited_decode,
    "profile_set": profile_set,
    "topic_fanout": topic_fanout_query,
    "module_star_join": module_star_join_query,
    "day_bounds": day_bounds,
    "daily_uv": daily_uv,
    "event_blacklist": event_blacklist,
    "topic_route": topic_route,
    "delimited_import": delimited_import,
    "running_positions": running_positions,
    "running_totals": running_totals,
    "replay_stream": replay_stream,
    "sink_last_rows": sink_last_rows,
    "sink_json_positions": sink_json_positions,
    "sink_unreadable": sink_unreadable,
    "monthly_uv": monthly_uv,
    "file_import_counts": file_import_counts,
    "binary_decode": binary_decode,
    "consumer_plan": consumer_plan,
    "cluster_union": cluster_union,
    "routes_by_property": routes_by_property,
    "date_checks": date_checks,
    "map_to_node": map_to_node,
}

ORACLE: dict[str, str] = {
    "event_normalize": O.EVENT_NORMALIZE,
    "project_fanout": O.PROJECT_FANOUT,
    "signup_derive": O.SIGNUP_DERIVE,
    "validate_invalid": O.VALIDATE_INVALID,
    "wiring_group": O.WIRING_GROUP,
    "sink_projects": O.SINK_PROJECTS,
    "time_parse_patterns": O.TIME_PARSE_PATTERNS,
    "rule_rename_cast": O.RULE_RENAME_CAST,
    "rule_match_contains": O.RULE_MATCH_CONTAINS,
    "flatten_properties": O.FLATTEN_PROPERTIES,
    "json_decode_fallback": O.JSON_DECODE_FALLBACK,
    "stage_counters": O.STAGE_COUNTERS,
    "offset_audit": O.OFFSET_AUDIT,
    "latest_checkpoint": O.LATEST_CHECKPOINT,
    "replay_lag": O.REPLAY_LAG,
    "sink_tail_max": O.SINK_TAIL_MAX,
    "resume_position": O.RESUME_POSITION,
    "replay_anti_join": O.REPLAY_ANTI_JOIN,
    "start_by_timestamp": O.START_BY_TIMESTAMP,
    "counter_merge": O.STAGE_COUNTERS,
    "source_topics": O.SOURCE_TOPICS,
    "starting_offsets": O.STARTING_OFFSETS,
    "main_json": O.MAIN_JSON,
    "invalid_json": O.INVALID_JSON,
    "flatten_deep": O.FLATTEN_DEEP,
    "log_split": O.LOG_SPLIT,
    "array_split": O.ARRAY_SPLIT,
    "record_fields_new": O.RECORD_FIELDS_NEW,
    "signup_by_route": O.SIGNUP_BY_ROUTE,
    "delimited_decode": O.DELIMITED_DECODE,
    "profile_set": O.PROFILE_SET,
    "topic_fanout": O.TOPIC_FANOUT,
    "module_star_join": O.MODULE_STAR_JOIN,
    "day_bounds": O.DAY_BOUNDS,
    "daily_uv": O.DAILY_UV,
    "event_blacklist": O.EVENT_BLACKLIST,
    "topic_route": O.TOPIC_ROUTE,
    "delimited_import": O.DELIMITED_IMPORT,
    "running_positions": O.OFFSET_AUDIT,
    "running_totals": O.STAGE_COUNTERS,
    "replay_stream": O.REPLAY_ANTI_JOIN,
    "sink_last_rows": O.SINK_LAST_ROWS,
    "sink_json_positions": O.SINK_JSON_POSITIONS,
    "sink_unreadable": O.SINK_UNREADABLE,
    "monthly_uv": O.MONTHLY_UV,
    "file_import_counts": O.FILE_IMPORT_COUNTS,
    "binary_decode": O.BINARY_DECODE,
    "consumer_plan": O.CONSUMER_PLAN,
    "cluster_union": O.CLUSTER_UNION,
    "routes_by_property": O.RECORD_FIELDS_NEW,
    "date_checks": O.DATE_CHECKS,
    "map_to_node": O.MAP_TO_NODE,
}
