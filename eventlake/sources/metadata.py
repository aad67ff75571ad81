"""Metadata tables: readers and the sample wiring derived from nation/region.

In production the four metadata tables live in a relational store and are read
with `spark.read.format("jdbc")` (`jdbc_options`), or kept as parquet.  For the
driver data, wiring and project tasks are derived from `nation`/`region`; the
property rules are a fixed sample table.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from eventlake.operators.metadata import Metadata
from eventlake.sources.records import GROUP, SERVER_A, SERVER_B
from eventlake.sources.tables import read_table

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

# Sample property rules: id, project, input field, output field, type code, valid flag.
SAMPLE_RULES = [
    (1, "p_asia", "amount", "order_amount", "0", 1),
    (2, "p_europe", "k", "k_text", "2", 1),
    (3, "p_america", "Name", "page_name", "2", 1),
    (4, "p_africa", "x", "pos_x", "1", 1),
    (5, "p_vip", "tags", "tag_list", "4", 1),
    (6, "p_asia", "appversion", "app_ver", "0", 1),
    (7, "p_europe", "y", "pos_y", "9", 1),
    (8, "p_america", "page", "page_obj", "2", 1),
    (9, "p_asia", "k", "k_num", "0", 0),
    (10, "p_as", "amount", "amt_sub", "0", 1),
    (11, "p_africa", "amount", "amount_af", "2", 1),
    (12, "p_asia", "x", "pos_x_asia", "2", 1),
]
ROUTE_SCHEMA = "server string, topic string, converter string, processor string, post_processor string"
RULE_SCHEMA = ("id int, sink_project_id string, input_field string, output_field string, "
               "output_type string, valid_flag int")


def project_name(region_name):
    return F.concat(F.lit("p_"), F.lower(F.regexp_replace(region_name, " ", "_")))


def sample_source_sink(spark: SparkSession, data_dir: str) -> DataFrame:
    """One wiring row per nation: server by (key div 5) % 2, topic by key % 5,
    project = region number (key div 5) % 5; a few rows invalid or in debug mode."""
    n = read_table(spark, data_dir, "nation", ["n_nationkey"])
    r = read_table(spark, data_dir, "region", ["r_regionkey", "r_name"])
    k = F.col("n_nationkey")
    topics = F.array(*[F.lit(f"t_{t}") for t in EVENT_TYPES])
    joined = n.join(F.broadcast(r), F.floor(k / 5) % 5 == F.col("r_regionkey"), "inner")
    return joined.select(
        F.when(F.floor(k / 5) % 2 == 0, F.lit(SERVER_A)).otherwise(F.lit(SERVER_B)).alias("source_server_port"),
        F.lit(GROUP).alias("source_group_id"),
        F.lit("").alias("source_sasl_jaas"),
        F.element_at(topics, (k % 5 + 1).cast("int")).alias("source_topic"),
        project_name(F.col("r_name")).alias("sink_project_id"),
        F.when((k % 7 == 3) | (k % 10 == 9), 0).otherwise(1).alias("valid_flag"),
        F.when(k % 11 == 4, 1).otherwise(0).alias("debug_mode_flag"),
    )


def sample_project_task(spark: SparkSession, data_dir: str) -> DataFrame:
    """One project per region; the last region's project is inactive."""
    r = read_table(spark, data_dir, "region", ["r_regionkey", "r_name"])
    return r.select(
        project_name(F.col("r_name")).alias("name"),
        F.when(F.col("r_regionkey") == 4, 0).otherwise(1).alias("project_status"),
    )


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A fixed table as a local relation (exact statistics for the planner)."""
    import pandas as pd

    kind = StructType.fromDDL(schema)
    columns = list(zip(*rows, strict=True)) or [()] * len(kind)
    frame = pd.DataFrame({f.name: pd.Series(list(c), dtype="object") for f, c in zip(kind, columns, strict=True)})
    return spark.createDataFrame(pa.Table.from_pandas(frame, schema=to_arrow_schema(kind), preserve_index=False), kind)


def sample_rules(spark: SparkSession) -> DataFrame:
    return local_table(spark, SAMPLE_RULES, RULE_SCHEMA)


def sample_routes(spark: SparkSession) -> DataFrame:
    """Routes: delimited text on server B's event topics; bank "old" records."""
    rows = [(SERVER_B, f"t_{t}", "csvConverter", None, None) for t in EVENT_TYPES]
    rows += [(s, "t_bank_old", None, "corpBankOldEvent", None) for s in (SERVER_A, SERVER_B)]
    rows += [(s, "t_bank_new", None, "corpBankNewEvent", None) for s in (SERVER_A, SERVER_B)]
    rows += [(SERVER_B, "t_customer", "csvConverter", None, None)]
    return local_table(spark, rows, ROUTE_SCHEMA)


def sample_metadata(spark: SparkSession, data_dir: str, with_rules: bool = True) -> Metadata:
    rules = sample_rules(spark) if with_rules else local_table(spark, [], RULE_SCHEMA)
    return Metadata(
        source_sink=sample_source_sink(spark, data_dir),
        project_task=sample_project_task(spark, data_dir),
        trans_rule=rules,
        routes=sample_routes(spark),
    )


def routes_from_properties(spark: SparkSession, pairs: list[tuple[str, str]], props: dict) -> DataFrame:
    """Routes from job properties keyed `<kind>.<server with ':' as '.'>.<topic>`,
    kind in converter / processor / post, for the given (server, topic) pairs."""
    rows = []
    for server, topic in pairs:
        suffix = f"{server.replace(':', '.')}.{topic}"
        rows.append((server, topic, props.get(f"converter.{suffix}"), props.get(f"processor.{suffix}"),
                     props.get(f"post.{suffix}")))
    return local_table(spark, rows, ROUTE_SCHEMA)


def jdbc_options(url: str, query: str, user: str = "", password: str = "", fetchsize: int = 10_000) -> dict:
    """Options for `spark.read.format("jdbc").options(**opts).load()`."""
    return {"url": url, "query": query, "user": user, "password": password, "fetchsize": str(fetchsize)}


def read_metadata_jdbc(spark: SparkSession, url: str, user: str = "", password: str = "",
                       routes: DataFrame | None = None) -> Metadata:
    """The metadata tables over JDBC (needs the database's driver on the classpath).

    Routes come from the given table (`routes_from_properties`) or the store's."""
    def q(sql):
        return spark.read.format("jdbc").options(**jdbc_options(url, sql, user, password)).load()
    return Metadata(
        source_sink=q("select source_server_port, source_group_id, source_sasl_jaas, source_topic, "
                      "sink_project_id, valid_flag, debug_mode_flag from sa_source_sink"),
        project_task=q("select name, project_status from sa_project_task"),
        trans_rule=q("select id, sink_project_id, input_field, output_field, output_type, valid_flag "
                     "from sa_trans_rule"),
        routes=routes if routes is not None else q(
            "select server, topic, converter, processor, post_processor from sa_route"),
        counters=q("select source_server_port as server, source_group_id as consumer_group, sink_project_id as project, "
                   "source_topic as topic, stage, cnt from sa_record_count"),
    )


# Sample event blacklist: project, event name, status (0 = active).
SAMPLE_BLACKLIST = [
    ("p_asia", "view", 0),
    ("p_africa", "Login", 0),
    ("p_america", "purchase", 0),
    ("p_europe", "click", 1),
]


def sample_blacklist(spark: SparkSession) -> DataFrame:
    return local_table(spark, SAMPLE_BLACKLIST, "project_id string, event_name string, status int")


def sample_modules(spark: SparkSession, data_dir: str):
    """Module star tables from lineitem (events), part (modules), supplier (pages)
    and nation (tags)."""
    li = read_table(spark, data_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                  "l_returnflag"])
    events = li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", "1").otherwise("0").alias("is_delete"),
        (F.col("l_partkey") % 50).alias("classify1_id"), (F.col("l_partkey") % 70).alias("classify2_id"),
        (F.col("l_partkey") % 90).alias("classify3_id"), F.col("l_suppkey").alias("page"),
        (F.col("l_suppkey") % 25).cast("int").alias("event_tag"),
    )
    part = read_table(spark, data_dir, "part", ["p_partkey", "p_name", "p_size"])
    modules = part.select(
        F.col("p_partkey").alias("module_id"), F.col("p_name").alias("module_name"),
        (F.col("p_partkey") % 3 + 1).cast("string").alias("module_level"),
        F.when(F.col("p_size") > 45, 1).otherwise(0).alias("is_delete"),
    )
    sup = read_table(spark, data_dir, "supplier", ["s_suppkey", "s_name", "s_acctbal"])
    pages = sup.select(F.col("s_suppkey").alias("page_id"), F.col("s_name").alias("page_name"),
                       F.when(F.col("s_acctbal") < 0, 1).otherwise(0).alias("is_delete"))
    nat = read_table(spark, data_dir, "nation", ["n_nationkey", "n_name"])
    tags = nat.select(F.col("n_nationkey").alias("tag_id"), F.col("n_name").alias("tag_name"))
    return events, modules, pages, tags
