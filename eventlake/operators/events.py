"""Event building (P18-P22, P28-P34): identity, time, name, errors, sign-up
derivation and project fan-out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake import constants as C
from eventlake.config import PipelineConfig
from eventlake.functions.text import cut, is_not_blank, java_split
from eventlake.functions.time import day_text, parse_wall_clock, wall_clock_to_millis
from eventlake.operators.metadata import Lookup


def resolve_projects(parts: DataFrame, wiring: Lookup, config: PipelineConfig) -> DataFrame:
    """J3 + P34: the record's own project list if it has one, else the wiring's
    project list for (server, group, topic).  `wiring` holds the rows of `sink_projects`."""
    df = wiring.attach(parts, {"server": "source_server_port", "consumer_group": "source_group_id", "topic": "source_topic"}, F.col("offset"))
    project_list = F.when(is_not_blank(F.col("src_project")), F.col("src_project")).otherwise(F.col("sink_projects"))
    return df.withColumn("project_list", project_list).withColumn(
        "tokens", java_split(F.col("project_list"), ",")
    ).drop("sink_projects")


def validate(df: DataFrame, config: PipelineConfig) -> DataFrame:
    """P18-P22 (+D10): distinct_id, is_login_id, time (0 when unreadable), date,
    event ('' when blank) and the joined validation errors."""
    login_ok = is_not_blank(F.col("src_login_id"))
    device_ok = is_not_blank(F.col("src_device_id"))
    event_ok = is_not_blank(F.col("src_event_name"))
    wall = parse_wall_clock(F.col("src_event_time"))
    df = df.withColumns({
        "distinct_id": F.when(login_ok, cut(F.col("src_login_id"))).when(device_ok, cut(F.col("src_device_id"))),
        "is_login_id": login_ok,
        "time_ms": wall_clock_to_millis(wall, config.time_zone),
        "event": F.when(event_ok, F.col("src_event_name")).otherwise(F.lit("")),
        "_id_ok": login_ok | device_ok,
        "_event_ok": event_ok,
    })
    errors = F.concat_ws(
        C.ERR_SEP,
        F.when(~F.col("_id_ok"), F.lit(C.ERR_NO_ID)),
        F.when(F.col("time_ms").isNull(), F.lit(C.ERR_TIME)),
        F.when(~F.col("_event_ok"), F.lit(C.ERR_EVENT)),
    )
    return df.withColumns({
        "time": F.coalesce(F.col("time_ms"), F.lit(0).cast("bigint")),
        "errors": F.nullif(errors, F.lit("")),
    }).withColumns({
        "date": day_text(F.col("time"), config.time_zone),
        "error_reason": F.when(F.col("errors").isNotNull(), F.concat(F.lit(C.INVALID_PREFIX), F.col("errors"))),
    }).drop("_id_ok", "_event_ok")


def flat_text(items: str, name: str) -> Column:
    """Text of a flattened property (the last item of the key wins), without building the map."""
    item = F.try_element_at(F.filter(F.col(items), lambda x: x.k == F.lit(name)), F.lit(-1))
    return F.try_variant_get(item.v, "$", "string")


#: Post processors by route name: the sign-up test of a row, given the default one.
POSTS: dict[str, Callable[[Column], Column]] = {
    "loginDevicePost": lambda base: base & F.col("is_login_id"),
}


def register_post(name: str, narrow: Callable[[Column], Column]) -> None:
    """Make a post processor available to routes (§2.11)."""
    POSTS[name] = narrow


def is_signup(post_processor: Column) -> Column:
    """Login or register events whose `device_id` property is not blank
    (D11: a real blank test).  `loginDevicePost` also wants a login id."""
    named = F.col("event").isin(*C.SIGNUP_EVENTS)
    device = is_not_blank(flat_text("signup_items", C.SIGNUP_DEVICE_PROPERTY))
    base = named & device
    out = F
    for name, narrow in POSTS.items():
        out = out.when(post_processor == name, narrow(base))
    return out.otherwise(base)


def fan_out(df: DataFrame) -> DataFrame:
    """One row per project, plus a $SignUp copy per project for sign-ups."""
    track = F.struct(F.lit(C.TYPE_TRACK).alias("type"), F.col("event").alias("event"),
                     F.lit(None).cast("string").alias("original_id"))
    signup = F.struct(F.lit(C.TYPE_SIGNUP).alias("type"), F.lit(C.EVENT_SIGNUP).alias("event"),
                      F.col("src_device_id").alias("original_id"))
    kinds = F.when(F.col("signup"), F.array(signup, track)).otherwise(F.array(track))
    combos = F.flatten(F.transform(kinds, lambda k, ki: F.transform(F.col("tokens"), lambda p, pi: F.struct(
        ki.alias("kind_index"), pi.alias("project_index"), p.alias("project"), k["type"].alias("type"),
        k["event"].alias("event"), k["original_id"].alias("original_id")))))
    # one generator over (kind x project); inline keeps wide rows fast
    return df.select(
        "server", "consumer_group", "topic", "partition", "offset", "part_index", "distinct_id", "time", "date",
        "properties", "error_reason", F.inline(combos),
    ).select(
        "server", "consumer_group", "topic", "partition", "offset", "part_index", "kind_index", "project_index",
        "project", "type", "event", "distinct_id", "time", "date", "original_id", "properties", "error_reason",
    )


def event_json(main: DataFrame) -> Column:
    """S7 value (P26): the event as JSON; NULL and empty fields and the error column are left out."""
    text = [F.nullif(F.col(c), F.lit("")).alias(c) for c in ("project", "type", "event", "original_id")]
    return F.to_json(F.struct(F.nullif("distinct_id", F.lit("")).alias("distinct_id"), "time", *text, "properties"))


def invalid_json() -> Column:
    """S8 value of an invalid row: the original record as text with lineage, reason and version tag."""
    return F.to_json(F.struct(
        "record", F.col("server").alias("server"), "consumer_group", "topic", "partition", "offset", "record_key",
        F.col("error_reason").alias("ERROR_REASON"), F.col("version_tag").alias("VERSION_TAG")))
