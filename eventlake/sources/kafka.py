"""Kafka sources (S1-S4): one stream per (server, group, auth), unioned.

Spark's Kafka source gives key, value, topic, partition, offset, timestamp;
we add `server` and `consumer_group` so that every record carries its lineage.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class KafkaSource:
    server: str
    group: str
    topics: tuple[str, ...]
    sasl_jaas: str = ""
    auto_offset_reset: str = "latest"
    starting_offsets: dict | None = None     # {topic: {partition: offset}}
    partitions: dict | None = None           # {topic: number of partitions}
    starting_timestamp: int | None = None    # epoch millis; overrides offsets (S4)
    max_offsets_per_trigger: int | None = None
    fail_on_data_loss: bool = True           # offsets that have expired stop the stream
    security_protocol: str = "SASL_PLAINTEXT"
    sasl_mechanism: str = "PLAIN"
    extra: dict = field(default_factory=dict)


def reader_options(src: KafkaSource) -> dict:
    """Options of `spark.readStream.format("kafka")` for one source."""
    opts = {
        "kafka.bootstrap.servers": src.server,
        "subscribe": ",".join(src.topics),
        "kafka.group.id": src.group,
        "failOnDataLoss": str(src.fail_on_data_loss).lower(),
        "includeHeaders": "false",
    }
    if src.sasl_jaas:
        opts.update({
            "kafka.security.protocol": src.security_protocol,
            "kafka.sasl.mechanism": src.sasl_mechanism,
            "kafka.sasl.jaas.config": src.sasl_jaas,
        })
    if src.starting_timestamp and src.starting_timestamp > 0:
        opts["startingTimestamp"] = str(src.starting_timestamp)
        opts["startingOffsetsByTimestampStrategy"] = "latest"
    elif src.starting_offsets:
        opts["startingOffsets"] = starting_offsets_json(src.starting_offsets, src.auto_offset_reset, src.partitions)
    else:
        opts["startingOffsets"] = src.auto_offset_reset
    if src.max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(src.max_offsets_per_trigger)
    opts.update({f"kafka.{k}" if not k.startswith("kafka.") else k: v for k, v in src.extra.items()})
    return opts


def starting_offsets_json(positions: dict, auto_offset_reset: str = "latest", partitions: dict | None = None) -> str:
    """S3: {topic: {partition: last offset read}} as Spark wants it.

    The one place where reading resumes at the next offset (D7); -2/-1 are
    Spark's earliest/latest markers and pass through.  `partitions` ({topic:
    number}) lists all partitions of the subscribed topics: those without a
    position start by the reset policy, as Spark wants every one listed."""
    reset = {"earliest": -2, "latest": -1}[auto_offset_reset]
    out: dict = {t: {str(p): reset for p in range(n)} for t, n in (partitions or {}).items()}
    for topic, parts in positions.items():
        out.setdefault(topic, {}).update({str(p): (int(o) + 1 if int(o) >= 0 else int(o)) for p, o in parts.items()})
    return json.dumps(out, sort_keys=True)


def resume_sources(plan: DataFrame, positions: DataFrame, partitions: dict[str, dict[str, int]] | None = None,
                   auto_offset_reset: str = "latest", start_timestamp: int | None = None, **options) -> list[KafkaSource]:
    """One KafkaSource for each row of the subscription list
    (`source_topics`) with its part of `resume_positions`; a start timestamp
    overrides all positions (R8).  Both tables have a row for each topic or
    partition of the wiring.  `partitions`: server -> topic -> number."""
    from collections import defaultdict

    held: dict = defaultdict(lambda: defaultdict(dict))
    for r in positions.select("server", "consumer_group", "topic", "partition", "resume_offset").collect():
        held[(r.server, r.consumer_group)][r.topic][r.partition] = r.resume_offset
    out = []
    for r in plan.select("source_server_port", "source_group_id", "source_sasl_jaas", "topics").collect():
        topics = tuple(r.topics.split(","))
        mine = {t: dict(p) for t, p in held[(r.source_server_port, r.source_group_id)].items() if t in topics}
        counts = {t: n for t, n in (partitions or {}).get(r.source_server_port, {}).items() if t in topics}
        out.append(KafkaSource(
            r.source_server_port, r.source_group_id, topics, r.source_sasl_jaas or "", auto_offset_reset,
            starting_offsets=mine or None, partitions=counts or None, starting_timestamp=start_timestamp, **options))
    return sorted(out, key=lambda s: (s.server, s.group))


def with_lineage(df: DataFrame, server: str, group: str) -> DataFrame:
    """The Kafka layout plus the source's server and group."""
    return df.select(
        F.lit(server).alias("server"), F.lit(group).alias("consumer_group"), "topic", "partition", "offset",
        "timestamp", "key", "value",
    )


def union_clusters(parts: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """The records of all clusters, (records, server, group) each, as one stream or table; no row moves."""
    if not parts:
        raise ValueError("no cluster to read")
    return reduce(DataFrame.unionByName, [with_lineage(*p) for p in parts])


def read_kafka_stream(spark: SparkSession, sources: list[KafkaSource]) -> DataFrame:
    """S1+S2: union of every source's stream (needs the Kafka connector jar)."""
    return union_clusters([(spark.readStream.format("kafka").options(**reader_options(s)).load(), s.server, s.group) for s in sources])


def writer_options(servers: str, topic: str, extra: dict | None = None, acks: str = "all", batch_size: int = 100_000,
                   compression: str = "lz4", sasl_jaas: str = "", security_protocol: str = "SASL_PLAINTEXT",
                   sasl_mechanism: str = "PLAIN") -> dict:
    """Producer options; `extra` may name options with or without `kafka.`."""
    opts = {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.compression.type": compression,
        "kafka.batch.size": str(batch_size),
        "kafka.max.request.size": "3145728",
        "kafka.acks": acks,
    }
    if sasl_jaas:
        opts |= {"kafka.security.protocol": security_protocol, "kafka.sasl.mechanism": sasl_mechanism,
                 "kafka.sasl.jaas.config": sasl_jaas}
    opts.update({k if k.startswith("kafka.") or k == "topic" else f"kafka.{k}": str(v) for k, v in (extra or {}).items()})
    return opts
