"""Raw stream records (Kafka layout) derived from the data tables.

The driver tables hold typed rows, not stream records.  These functions turn
them, with narrow projections only, into the canonical raw layout

  server string, consumer_group string, topic string, partition int,
  offset bigint, timestamp timestamp_ntz, key binary, value binary

so that the pipeline runs on data whose size grows with the tables.  Edge
cases (blank ids, unreadable times, nested and text-held objects, record-level
project lists, sign-ups) are placed by residues of the row id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.constants import CSV_SEPARATOR, TIME_PATTERNS
from eventlake.sources.tables import read_table

SERVER_A = "kafka-a:9092"
SERVER_B = "kafka-b:9092"
GROUP = "etl"
JSON_OPTS = {"ignoreNullFields": "true"}


def _server(e: Column) -> Column:
    return F.when(e % 2 == 0, F.lit(SERVER_A)).otherwise(F.lit(SERVER_B))


def time_text(ts: Column, e: Column) -> Column:
    """Event time written with pattern number e % 10; 9 gives unreadable text."""
    expr = F.when(e % 10 == 9, F.lit("bad time"))
    for i, p in enumerate(TIME_PATTERNS):
        expr = expr.when(e % 10 == i, F.date_format(ts, p))
    return expr


def event_body(e: Column, u: Column, ts: Column, event_type: Column, value: Column, props: Column) -> Column:
    """JSON object of one unified-log event (key order is document order)."""
    ev = (F.when(event_type == "signup", F.lit("register"))
          .when((event_type == "click") & (e % 4 == 1), F.lit("Login"))
          .otherwise(event_type))
    event_id = F.when(e % 23 == 0, F.lit(None)).when(e % 19 == 0, F.lit("  ")).otherwise(ev)
    login = F.when(e % 3 == 0, F.lit(None)).when(e % 5 == 0, F.lit("   ")).otherwise(F.concat(F.lit("u"), u))
    device = F.when(e % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("d"), (u * 31) % 1000))
    body = F.struct(
        event_id.cast("string").alias("EventID"),
        login.cast("string").alias("LoginID"),
        device.cast("string").alias("DeviceID"),
        time_text(ts, e).alias("Time"),
        F.concat(F.lit("1."), e % 5).alias("AppVersion"),
        F.when(e % 13 == 0, F.lit("p_vip,p_asia")).alias("project"),
        value.alias("Amount"),
        F.struct(event_type.alias("Name"),
                 F.struct(u.alias("X"), (e % 7).alias("Y")).alias("Pos")).alias("Page"),
        props.alias("props"),
        F.when(e % 6 == 0, F.lit("top")).alias("NAME"),
        F.when(e % 2 == 0, device).cast("string").alias("device_id"),
        F.when(e % 8 == 0, F.array(F.lit("a"), event_type)).alias("Tags"),
    )
    return F.to_json(body, JSON_OPTS)


def event_records(spark: SparkSession, data_dir: str) -> DataFrame:
    """One unified-log record per `events` row.

    server by e % 2, topic t_<event_type>, partition e % 4, offset e div 4,
    key user_id (NULL when e % 17 == 0)."""
    ev = read_table(spark, data_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    e = F.col("event_id")
    return ev.select(
        _server(e).alias("server"),
        F.lit(GROUP).alias("consumer_group"),
        F.concat(F.lit("t_"), F.col("event_type")).alias("topic"),
        (e % 4).cast("int").alias("partition"),
        F.floor(e / 4).cast("bigint").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.when(e % 17 == 0, F.lit(None)).otherwise(F.col("user_id").cast("string")).cast("binary").alias("key"),
        event_body(e, F.col("user_id"), F.col("ts"), F.col("event_type"), F.col("value"), F.col("props"))
        .cast("binary").alias("value"),
    )


def deep_records(spark: SparkSession, data_dir: str) -> DataFrame:
    """One record per `events` row for project p_asia: Amount as text of 24 digits, and
    the event id under 6 + e % 7 nested objects; on odd ids the inner half is
    the text of an object."""
    ev = read_table(spark, data_dir, "events", ["event_id", "ts"])
    e = F.col("event_id")
    depth = (F.lit(6) + e % 7).cast("int")
    half = F.floor(depth / 2).cast("int")

    def nest(inner: Column, levels: Column) -> Column:
        return F.concat(F.repeat(F.lit('{"L":'), levels), inner, F.repeat(F.lit("}"), levels))

    inner = nest(F.concat(F.lit('{"Leaf":'), e, F.lit("}")), half)
    as_text = F.concat(F.lit('"'), F.replace(inner, F.lit('"'), F.lit('\\"')), F.lit('"'))
    body = F.concat(
        F.lit('{"EventID":"view","LoginID":"u1","Time":"2024-01-01 00:00:00","project":"p_asia","Amount":"1234567890123456'),
        F.lpad(e.cast("string"), 8, "0"), F.lit('","O":'),
        nest(F.when(e % 2 == 1, as_text).otherwise(inner), depth - half), F.lit("}"))
    return ev.select(
        _server(e).alias("server"), F.lit(GROUP).alias("consumer_group"), F.lit("t_view").alias("topic"),
        (e % 4).cast("int").alias("partition"), F.floor(e / 4).cast("bigint").alias("offset"),
        F.col("ts").alias("timestamp"), F.lit(None).cast("binary").alias("key"), body.cast("binary").alias("value"),
    )


def mixed_records(spark: SparkSession, data_dir: str) -> DataFrame:
    """Event records with every decode edge placed by e % 50:
    49 NULL value, 48 text that is no JSON, 47 a JSON scalar, 46 JSON null,
    45 a JSON array of two events, 44 an empty array, 43 U+0001-delimited text."""
    base = event_records(spark, data_dir)
    e = F.col("offset") * 4 + F.col("partition")
    text = F.col("value").cast("string")
    r = e % 50
    delimited = F.concat_ws(CSV_SEPARATOR, F.lit("x0"), F.concat(F.lit("u"), e), F.lit("Login"), F.lit(""), F.lit(""))
    value = (
        F.when(r == 49, F.lit(None).cast("string"))
        .when(r == 48, F.lit("not json"))
        .when(r == 47, F.lit("123"))
        .when(r == 46, F.lit("null"))
        .when(r == 45, F.concat(F.lit("["), text, F.lit(","), text, F.lit("]")))
        .when(r == 44, F.lit("[]"))
        .when(r == 43, delimited)
        .otherwise(text)
    )
    return base.withColumn("value", value.cast("binary"))


def log_records(spark: SparkSession, data_dir: str) -> DataFrame:
    """Bank "old" records: one per order, field LOG = free prefix + JSON array of
    the order's line items (P12a).  Orders without line items give '[]'; every
    order with key % 9 == 8 has no '[' at all."""
    o = read_table(spark, data_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    li = read_table(spark, data_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag"])
    items = li.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct("l_linenumber", "l_shipdate", "l_returnflag"))).alias("items")
    )
    j = o.join(items, o.o_orderkey == items.l_orderkey, "left")
    elem = lambda it: F.struct(
        F.concat(F.lit("ret_"), it.l_returnflag).alias("LogType"),
        F.concat(F.lit("c"), F.col("o_custkey")).alias("CustID"),
        F.date_format(it.l_shipdate, "yyyy-MM-dd HH:mm:ss").alias("Time"),
        it.l_linenumber.alias("Line"),
    )
    arr = F.to_json(F.transform(F.coalesce(F.col("items"), F.array().cast(items.schema["items"].dataType)), elem))
    k = F.col("o_orderkey")
    log = F.when(k % 9 == 8, F.lit("no array here")).otherwise(F.concat(F.lit("LOG-"), k, F.lit(":"), arr))
    body = F.to_json(F.struct(log.alias("LOG"), F.lit("bank").alias("Channel")), JSON_OPTS)
    return j.select(
        _server(k).alias("server"), F.lit(GROUP).alias("consumer_group"), F.lit("t_bank_old").alias("topic"),
        (k % 4).cast("int").alias("partition"), F.floor(k / 4).cast("bigint").alias("offset"),
        F.col("o_orderdate").alias("timestamp"), F.col("o_custkey").cast("string").cast("binary").alias("key"),
        body.cast("binary").alias("value"),
    )


def bank_new_records(spark: SparkSession, data_dir: str) -> DataFrame:
    """Bank "new" records, one per order: LogType, CustID (missing on every third
    key, which has a DeviceID), Time and AppVersion."""
    o = read_table(spark, data_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"])
    k = F.col("o_orderkey")
    body = F.to_json(F.struct(
        F.concat(F.lit("st_"), F.col("o_orderstatus")).alias("LogType"),
        F.when(k % 3 != 0, F.concat(F.lit("c"), F.col("o_custkey"))).alias("CustID"),
        F.when(k % 3 == 0, F.concat(F.lit("d"), k)).alias("DeviceID"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("Time"), F.lit("2.0").alias("AppVersion"),
        F.lit("p_asia").alias("project"),
    ), JSON_OPTS)
    return o.select(
        _server(k).alias("server"), F.lit(GROUP).alias("consumer_group"), F.lit("t_bank_new").alias("topic"),
        (k % 4).cast("int").alias("partition"), F.floor(k / 4).cast("bigint").alias("offset"),
        F.col("o_orderdate").alias("timestamp"), F.lit(None).cast("binary").alias("key"), body.cast("binary").alias("value"),
    )


def conversation_records(spark: SparkSession, data_dir: str) -> DataFrame:
    """Top-level JSON arrays (P12b, D4): one record per conversation turn holding
    1 + turn % 3 copies of the turn as an event; whole turn texts ride along."""
    c = read_table(spark, data_dir, "conversations", ["conv_id", "turn", "role", "text"])
    turn = F.struct(
        F.col("role").alias("EventID"), F.concat(F.lit("c"), F.col("conv_id")).alias("LoginID"),
        F.date_format(F.timestamp_add("SECOND", F.col("turn"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")),
                      "yyyy-MM-dd HH:mm:ss").alias("Time"),
        F.col("text").alias("Text"),
    )
    arr = F.to_json(F.array_repeat(turn, (F.col("turn") % 3 + 1).cast("int")), JSON_OPTS)
    off = F.col("conv_id") * 1000 + F.col("turn")
    return c.select(
        F.lit(SERVER_A).alias("server"), F.lit(GROUP).alias("consumer_group"), F.lit("t_conv").alias("topic"),
        (F.col("conv_id") % 4).cast("int").alias("partition"), off.cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp_ntz").alias("timestamp"),
        F.col("conv_id").cast("string").cast("binary").alias("key"), arr.cast("binary").alias("value"),
    )


def customer_records(spark: SparkSession, data_dir: str) -> DataFrame:
    """U+0001-delimited records (P4): key, name, nation, balance, segment."""
    c = read_table(spark, data_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    text = F.concat_ws(CSV_SEPARATOR, *[F.col(x).cast("string") for x in
                                       ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")])
    k = F.col("c_custkey")
    return c.select(
        F.lit(SERVER_B).alias("server"), F.lit(GROUP).alias("consumer_group"), F.lit("t_customer").alias("topic"),
        (k % 4).cast("int").alias("partition"), k.cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp_ntz").alias("timestamp"), F.lit(None).cast("binary").alias("key"),
        text.cast("binary").alias("value"),
    )


def user_records(spark: SparkSession, data_dir: str) -> DataFrame:
    """User records (P35/P36): {"UserID", "Time", "Segment"} per customer, with the
    customer's region as project; blank ids on every tenth key."""
    c = read_table(spark, data_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    n = read_table(spark, data_dir, "nation", ["n_nationkey", "n_regionkey"])
    r = read_table(spark, data_dir, "region", ["r_regionkey", "r_name"])
    geo = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", F.concat(F.lit("p_"), F.lower(F.regexp_replace("r_name", " ", "_"))).alias("project"))
    j = c.join(F.broadcast(geo), c.c_nationkey == geo.n_nationkey, "left")
    k = F.col("c_custkey")
    uid = F.when(k % 10 == 0, F.lit("  ")).otherwise(F.concat(F.lit("c"), k))
    t = F.date_format(F.timestamp_add("MINUTE", k, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")),
                      "yyyy-MM-dd HH:mm:ss")
    body = F.to_json(F.struct(uid.alias("UserID"), t.alias("Time"), F.col("c_mktsegment").alias("Segment")))
    return j.select(
        F.lit(SERVER_A).alias("server"), F.lit(GROUP).alias("consumer_group"), F.lit("t_user").alias("topic"),
        (k % 4).cast("int").alias("partition"), k.cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp_ntz").alias("timestamp"), F.lit(None).cast("binary").alias("key"),
        body.cast("binary").alias("value"), "project",
    )


def packed_records(spark: SparkSession, data_dir: str) -> DataFrame:
    """One packed binary record per order (user, epoch ms, cents, event code); of every 50, one is cut
    short, one has an unknown code, one is JSON text and one is NULL."""
    o = read_table(spark, data_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    k = F.col("o_orderkey")
    number = lambda c, n: F.lpad(F.hex(c.cast("bigint")), n, "0")
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    code = F.when(k % 50 == 48, F.lit(9)).otherwise(k % 3)
    packed = F.unhex(F.concat(number(F.col("o_custkey"), 16), number(ms, 16), number(F.round(F.col("o_totalprice") * 100), 16), number(code, 4)))
    value = (F.when(k % 50 == 49, F.substring(packed, 1, 7)).when(k % 50 == 47, F.lit('{"EventID":"json","LoginID":"x"}').cast("binary"))
             .when(k % 50 == 46, F.lit(None).cast("binary")).otherwise(packed))
    return o.select(
        _server(k).alias("server"), F.lit(GROUP).alias("consumer_group"), F.lit("t_packed").alias("topic"),
        (k % 4).cast("int").alias("partition"), F.floor(k / 4).cast("bigint").alias("offset"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("timestamp"), F.lit(None).cast("binary").alias("key"), value.alias("value"),
    )
