"""Config-only and schema-only items: module star join (J9), topic routing (E1),
daily unique users (E2), delimited-file import (E3), event blacklist (E4)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventlake import constants as C
from eventlake.functions.json import is_empty_value
from eventlake.functions.text import cut, is_not_blank
from eventlake.functions.time import parse_wall_clock, wall_clock_to_millis



def module_star_join(events: DataFrame, modules: DataFrame, pages: DataFrame, tags: DataFrame) -> DataFrame:
    """Filtered events LEFT JOIN the module dimension three times (levels 1, 2,
    3), the page and the tag dimension.  The planner broadcasts
    dimensions that are small by their statistics and shuffles larger ones."""
    xe = events.filter(F.col("is_delete") == "0")

    def level(n: int):
        m = modules.filter((F.col("module_level") == str(n)) & (F.col("is_delete") == 0)).select(
            F.col("module_id").alias(f"_m{n}_id"), F.col("module_name").alias(f"classify{n}_name")
        )
        return m

    out = xe
    for n in (1, 2, 3):
        out = out.join(level(n), out[f"classify{n}_id"] == F.col(f"_m{n}_id"), "left").drop(f"_m{n}_id")
    p = pages.filter(F.col("is_delete") == 0).select(F.col("page_id").alias("_page_id"), "page_name")
    out = out.join(p, out["page"] == F.col("_page_id"), "left").drop("_page_id")
    t = tags.select(F.col("tag_id").alias("_tag_id"), "tag_name")
    return out.join(t, out["event_tag"] == F.col("_tag_id"), "left").drop("_tag_id")


def drop_blacklisted(main: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Main rows whose (project, event) is on an active blacklist row are dropped."""
    bl = blacklist.filter(F.col("status") == 0).select(
        F.col("project_id").alias("project"), F.col("event_name").alias("event")
    )
    return main.join(bl, ["project", "event"], "left_anti")


def daily_unique_users(main: DataFrame) -> DataFrame:
    """Distinct users per project and day (track rows with an identity)."""
    rows = main.filter((F.col("type") == "track") & F.col("distinct_id").isNotNull())
    return rows.groupBy("project", "date").agg(F.countDistinct("distinct_id").alias("uv"))


def route_topics(main: DataFrame, splits: DataFrame) -> DataFrame:
    """Main rows with the sink topics of all valid split rules of their project
    whose field/value pairs (one to three; NULL pairs ask nothing) they hold.

    An equi-join on the project; rows of no rule are left out."""
    rules = splits.filter(F.col("valid_flag") == 1).select(
        F.col("sink_project_id").alias("project"), F.col("sink_topic").alias("_sink_topic"),
        *[F.col(f"source_field{kind}_{n}").alias(f"_{'v' if kind else 'f'}{n}") for n in (1, 2, 3) for kind in ("", "_value")])
    j = main.join(rules, "project")
    for n in (1, 2, 3):
        held = F.try_variant_get(F.try_element_at("properties", F.col(f"_f{n}")), "$", "string")
        j = j.filter(F.col(f"_f{n}").isNull() | F.coalesce(held == F.col(f"_v{n}"), F.lit(False)))
    return j.withColumn("sink_topic", F.col("_sink_topic")).select(*main.columns, "sink_topic")


# Source types of imported fields and the property type each one becomes.
IMPORT_TYPES = {"Boolean": "Boolean", "Date": "Date", "Integer": "Number", "Long": "Number", "String": "String"}


@dataclass(frozen=True)
class ImportConfig:
    """One delimited import: fields in file order as (property, source type); the
    names of the identity and time fields; separator and header flag."""

    project: str
    event_name: str
    fields: tuple[tuple[str, str], ...]
    id_field: str
    time_field: str
    separator: str = ","
    header: bool = False
    time_zone: str = "Asia/Shanghai"


def import_delimited(lines: DataFrame, config: ImportConfig) -> DataFrame:
    """Lines of text (column value, as `spark.read.text` gives them) -> event rows
    with typed properties and error_reason.

    Quotes follow the CSV reader.  Missing fields are NULL; text that a Boolean
    or Number field cannot hold is left out of the properties; header lines
    equal the field names.  Counts by outcome are an aggregate of error_reason."""
    names = [n for n, _ in config.fields]
    if config.header:
        lines = lines.filter(F.col("value") != config.separator.join(names))
    row = F.from_csv("value", ", ".join(f"`{n}` string" for n in names), {"sep": config.separator})
    return _as_events(lines.withColumn("_row", row), [c for c in lines.columns if c != "value"], config)


def _typed(text: Column, kind: str) -> Column:
    """A field's text as the property type of its source type; NULL where it does not fit."""
    to = IMPORT_TYPES[kind]
    if to == "Number":
        return F.coalesce(text.try_cast("bigint").cast("variant"), text.try_cast("double").cast("variant"))
    return (text.try_cast("boolean") if to == "Boolean" else text).cast("variant")


def _as_events(df: DataFrame, keep: list[str], config: ImportConfig) -> DataFrame:
    """Event columns of rows whose `_row` holds the fields' texts."""
    items = F.array(*[F.struct(F.lit(n).alias("k"), _typed(F.col("_row")[n], t).alias("v")) for n, t in config.fields])
    ms = wall_clock_to_millis(parse_wall_clock(F.col("_row")[config.time_field]), config.time_zone)
    who = F.col("_row")[config.id_field]
    errors = F.concat_ws(C.ERR_SEP, F.when(~is_not_blank(who), F.lit(C.ERR_NO_ID)), F.when(ms.isNull(), F.lit(C.ERR_TIME)))
    return df.select(
        *keep,
        F.when(is_not_blank(who), cut(who)).alias("distinct_id"), F.coalesce(ms, F.lit(0).cast("bigint")).alias("time"),
        F.lit(config.project).alias("project"), F.lit(C.TYPE_TRACK).alias("type"), F.lit(config.event_name).alias("event"),
        F.map_from_entries(F.filter(items, lambda x: ~is_empty_value(x.v))).alias("properties"),
        F.when(errors != "", F.concat(F.lit(C.INVALID_PREFIX), errors)).alias("error_reason"))


# ---- E3: import of delimited files -------------------------------------------


@dataclass(frozen=True)
class ImportCounts:
    """What one import did: lines read; event rows written; of these the rows that failed
    validation; lines that are no row of the fields; field values left out because their type cannot hold them."""

    read_count: int = 0
    process_count: int = 0
    invalid_count: int = 0
    bad_count: int = 0
    typed_out: int = 0


_BAD = "_bad_line"


def import_rows(spark: SparkSession, path: str | list[str], config: ImportConfig) -> DataFrame:
    """Lines of delimited files as event rows, with `source_file`, `outcome` ("event", or "bad" for
    a line with too many or too few fields, kept in `bad_line`) and `typed_out`, the number of values left out.

    With `config.header` the first line of each file is skipped.  Blank lines are no lines."""
    names = [n for n, _ in config.fields]
    schema = ", ".join(f"`{n}` string" for n in [*names, _BAD])
    # quoted fields keep separators, and doubled quotes are one quote; a line's own quotes never reach over its end
    lines = spark.read.schema(schema).csv(path, sep=config.separator, header=config.header, mode="PERMISSIVE",
                                          columnNameOfCorruptRecord=_BAD, escape='"')
    out = sum(((F.col(n).isNotNull() & _typed(F.col(n), t).isNull()).cast("int") for n, t in config.fields), start=F.lit(0))
    bad = F.col(_BAD).isNotNull()
    rows = lines.select(
        F.col("_metadata.file_path").alias("source_file"), F.when(bad, "bad").otherwise("event").alias("outcome"),
        F.col(_BAD).alias("bad_line"), F.when(bad, 0).otherwise(out).alias("typed_out"), F.struct(*names).alias("_row"))
    return _as_events(rows, ["source_file", "outcome", "bad_line", "typed_out"], config)


def import_files(spark: SparkSession, path: str | list[str], config: ImportConfig, out_path: str) -> ImportCounts:
    """Import delimited files into `<out_path>/outcome=event` and `<out_path>/outcome=bad`.

    One pass: the counts are taken by the write itself.  An import that runs again replaces its output."""
    rows = import_rows(spark, path, config)
    event = F.col("outcome") == "event"
    seen = Observation()
    total = F.count(F.lit(1))
    rows = rows.observe(
        seen, total.alias("read_count"), F.count_if(event).alias("process_count"),
        F.count_if(event & F.col("error_reason").isNotNull()).alias("invalid_count"), F.count_if(~event).alias("bad_count"),
        F.coalesce(F.sum("typed_out"), F.lit(0)).alias("typed_out"))
    # properties hold VARIANT values, which Parquet keeps as such
    rows.write.mode("overwrite").partitionBy("outcome").parquet(out_path)
    return ImportCounts(**seen.get)


def file_counts(spark: SparkSession, out_path: str) -> DataFrame:
    """The counts of each source file of an import, from three narrow columns of its output."""
    rows = spark.read.parquet(out_path)
    event = F.col("outcome") == "event"
    return rows.groupBy("source_file").agg(
        F.count("*").alias("read_count"), F.count_if(event).alias("process_count"),
        F.count_if(event & F.col("error_reason").isNotNull()).alias("invalid_count"), F.count_if(~event).alias("bad_count"),
        F.sum("typed_out").cast("bigint").alias("typed_out"))
