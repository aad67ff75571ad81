"""Profile rows and topic-only fan-out (P35-P37; dormant in the reference)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake import constants as C
from eventlake.config import PipelineConfig
from eventlake.functions.json import field_text, object_entries
from eventlake.functions.text import cut, is_not_blank, java_split
from eventlake.functions.time import parse_wall_clock, wall_clock_to_millis
from eventlake.operators.metadata import Lookup, Metadata, sink_projects


def profile_rows(records: DataFrame, user_field: str, time_field: str, project: str,
                 config: PipelineConfig | None = None) -> DataFrame:
    """One `profile_set` row per user record; identity from the user id
    (cut to 255), project prefixed SA_, properties pa_userid and $is_login_id."""
    config = config or PipelineConfig()
    entries = object_entries(F.col("value").cast("string"))
    df = records.withColumn("_e", entries).withColumns({
        "_uid": field_text(F.col("_e"), user_field),
        "_time": field_text(F.col("_e"), time_field),
    })
    ms = wall_clock_to_millis(parse_wall_clock(F.col("_time")), config.time_zone)
    props = F.map_from_entries(F.filter(F.array(
        F.struct(F.lit(C.PROFILE_USER_ID_PROPERTY).alias("k"), F.col("_uid").cast("variant").alias("v")),
        F.struct(F.lit(C.PROP_IS_LOGIN_ID).alias("k"), F.lit(True).cast("variant").alias("v")),
    ), lambda x: x.v.isNotNull()))
    return df.select(
        "server", "topic", "partition", "offset",
        F.when(is_not_blank(F.col("_uid")), cut(F.col("_uid"))).alias("distinct_id"),
        F.coalesce(ms, F.lit(0).cast("bigint")).alias("time"),
        F.concat(F.lit(C.PROFILE_PROJECT_PREFIX), F.coalesce(F.col(project), F.lit("null"))).alias("project"),
        F.lit(C.PROFILE_TYPE).alias("type"),
        props.alias("properties"),
    )


def topic_projects(meta: Metadata) -> DataFrame:
    """Projects of every topic, whatever the server and group (one row for each wiring row)."""
    return sink_projects(meta).groupBy("source_topic").agg(F.collect_list("sink_projects").alias("lists"))


def topic_fanout(records: DataFrame, topics: Lookup) -> DataFrame:
    """Copies per project of every wiring row with the record's topic (any
    server or group); records of no wired topic pass unchanged (project NULL).

    `topics` holds the rows of `topic_projects`."""
    j = topics.attach(records, {"topic": "source_topic"}, F.col("offset"))
    projects = F.flatten(F.transform("lists", lambda x: java_split(x, ",")))
    return j.withColumn("project", F.explode_outer(projects)).drop("lists")
