"""Decode and envelope (P1-P8): raw Kafka-layout records -> JSON body text.

Input columns (Kafka source layout plus the source wiring):
  server, consumer_group, topic, partition, offset, timestamp, key, value
Output adds:
  record_key   key text, '' when the key is NULL            (P6)
  is_null      value is NULL: counted as 0-NULL, dropped     (P8, D12)
  body_text    JSON text of the record; for values that are no JSON (or JSON
               null) the route's converter builds it          (P1-P4)
  body_entries entries of body_text when it is a JSON object (parsed once)
  decode_error reason for records that are a JSON scalar      (P7)
  processor, post_processor   route names                    (P11, P30)
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake import constants as C
from eventlake.config import PipelineConfig
from eventlake.functions.json import object_entries, starts_with_char
from eventlake.functions.text import java_split
from eventlake.operators.binary import BATCH_CONVERTERS, convert_batches

ROUTE_COLUMNS = ("converter", "processor", "post_processor")


def csv_converter(text: Column, fields: dict, sep: str) -> Column:
    """Split on the separator; index i (0-based) -> field name; missing indexes skipped."""
    parts = java_split(text, sep)
    entries = F.array(*[
        F.struct(F.lit(name).alias("k"), F.try_element_at(parts, F.lit(int(i) + 1)).alias("v"))
        for i, name in sorted(fields.items())
    ])
    present = F.filter(entries, lambda e: e.v.isNotNull())
    return F.to_json(F.map_from_entries(present))


def empty_converter() -> Column:
    """An empty object."""
    return F.lit("{}")


#: Converters by route name: text of a value that is no JSON -> JSON text of the record.
CONVERTERS: dict[str, Callable[[Column, PipelineConfig], Column]] = {
    "csvConverter": lambda text, config: csv_converter(text, config.csv_fields, config.csv_separator),
}


def register_converter(name: str, convert: Callable[[Column, PipelineConfig], Column]) -> None:
    """Make a converter available to routes (§2.11); a later one of the same name replaces it."""
    CONVERTERS[name] = convert


def apply_converter(name: Column, text: Column, config: PipelineConfig) -> Column:
    """Converter chosen per route; unknown names use the empty converter."""
    out = F
    for known, convert in CONVERTERS.items():
        out = out.when(name == known, convert(text, config))
    return out.otherwise(empty_converter())


def attach_routes(raw: DataFrame, routes: DataFrame | None, config: PipelineConfig) -> DataFrame:
    """P2/P11/P30 + J10: route names per (server, topic) by a broadcast left join."""
    defaults = {
        "converter": C.DEFAULT_CONVERTER,
        "processor": C.DEFAULT_PROCESSOR,
        "post_processor": C.DEFAULT_POST_PROCESSOR,
    }
    if routes is None:
        return raw.withColumns({k: F.lit(v) for k, v in defaults.items()})

    r = routes.select(
        F.col("server").alias("_r_server"), F.col("topic").alias("_r_topic"), *ROUTE_COLUMNS
    )
    joined = raw.join(
        r,
        (raw.server == F.col("_r_server")) & (raw.topic == F.col("_r_topic")),
        "left",
    ).drop("_r_server", "_r_topic")
    return joined.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in defaults.items()})


def json_class(text: Column, entries: Column) -> Column:
    """object / array / scalar / missing (not JSON, or JSON null)."""
    parsed = F.try_parse_json(text)
    return (
        F.when(text.isNull(), F.lit("missing"))
        .when(entries.isNotNull(), F.lit("object"))
        .when(starts_with_char(text, "[") & F.from_json(text, "array<string>").isNotNull(), F.lit("array"))
        .when(parsed.isNull() | F.is_variant_null(parsed), F.lit("missing"))
        .otherwise(F.lit("scalar"))
    )


def decode(raw: DataFrame, routes: DataFrame | None = None, config: PipelineConfig | None = None) -> DataFrame:
    """Records of routes with a batch converter take a branch of their own, so that the others meet no
    Python worker; without such a route there is no branch."""
    config = config or PipelineConfig()
    df = attach_routes(raw, routes, config)
    odd = [] if routes is None else sorted({r[0] for r in routes.where(F.col("converter").isin(list(BATCH_CONVERTERS))).select("converter").collect()})
    if not odd:
        return _decoded(df, config)
    out = _decoded(df.where(~F.col("converter").isin(odd)), config)
    for name in odd:
        out = out.unionByName(_decoded(df.where(F.col("converter") == name), config, name))
    return out


def _decoded(df: DataFrame, config: PipelineConfig, batch_converter: str | None = None) -> DataFrame:
    value_text = F.col("value").cast("string")
    df = df.withColumns({
        "record_key": F.coalesce(F.col("key").cast("string"), F.lit("")),
        "is_null": F.col("value").isNull(),
        "value_text": value_text,
    })
    df = df.withColumn("body_entries", object_entries(F.col("value_text")))
    df = df.withColumn("json_class", F.when(~F.col("is_null"), json_class(F.col("value_text"), F.col("body_entries"))))
    missing = F.col("json_class") == "missing"
    err = F.when(
        F.col("json_class") == "scalar",
        F.lit(C.DECODE_ERROR_PREFIX + "record is not a JSON object"),
    )
    if batch_converter:
        df = df.withColumn("_made", convert_batches(batch_converter, F.when(missing, F.col("value"))))
        converted = F.col("_made.body")
        err = err.when(F.col("_made.error").isNotNull(), F.concat(F.lit(C.DECODE_ERROR_PREFIX), F.col("_made.error")))
    else:
        converted = apply_converter(F.col("converter"), F.col("value_text"), config)
    body = (
        F.when(F.col("is_null"), F.lit(None).cast("string"))
        .when(missing, converted)
        .otherwise(F.col("value_text"))
    )
    df = df.withColumns({"body_text": body, "decode_error": err})
    return df.withColumn(
        "body_entries", F.when(missing, object_entries(F.col("body_text"))).otherwise(F.col("body_entries"))
    ).drop("json_class", "_made")
