"""Options of the Kafka reader and writer, and the way from positions to starting offsets."""

import json

from eventlake.sources.kafka import KafkaSource, reader_options, resume_sources, starting_offsets_json, writer_options


def test_reader_options():
    s = KafkaSource("h:1", "g", ("a", "b"), sasl_jaas="jaas", extra={"fetch.min.bytes": "5"}, max_offsets_per_trigger=7)
    o = reader_options(s)
    assert o["subscribe"] == "a,b" and o["failOnDataLoss"] == "true" and o["startingOffsets"] == "latest"
    assert o["kafka.security.protocol"] == "SASL_PLAINTEXT" and o["kafka.fetch.min.bytes"] == "5"
    assert reader_options(KafkaSource("h:1", "g", ("a",), fail_on_data_loss=False))["failOnDataLoss"] == "false"
    o = reader_options(KafkaSource("h:1", "g", ("a",), starting_offsets={"a": {0: 4}}, starting_timestamp=99))
    assert o["startingTimestamp"] == "99" and "startingOffsets" not in o


def test_every_partition_is_listed_and_resumes_once():
    got = json.loads(starting_offsets_json({"a": {0: 4, 2: -2}}, "earliest", {"a": 4, "b": 2}))
    assert got == {"a": {"0": 5, "1": -2, "2": -2, "3": -2}, "b": {"0": -2, "1": -2}}


def test_writer_options():
    o = writer_options("h:1", "t", {"linger.ms": 5, "kafka.acks": "1"}, compression="zstd", sasl_jaas="j")
    assert o["kafka.linger.ms"] == "5" and o["kafka.acks"] == "1" and o["kafka.compression.type"] == "zstd"
    assert o["kafka.sasl.jaas.config"] == "j"


def test_resume_sources(spark):
    plan = spark.createDataFrame([("s1", "g", "", "a,b"), ("s2", "g", "j", "a")],
                                 "source_server_port string, source_group_id string, source_sasl_jaas string, topics string")
    pos = spark.createDataFrame([("s1", "g", "a", 0, 9), ("s1", "g", "old", 0, 3)],
                                "server string, consumer_group string, topic string, partition int, resume_offset bigint")
    one, two = resume_sources(plan, pos, {"s1": {"a": 2, "b": 1}}, auto_offset_reset="earliest")
    assert json.loads(reader_options(one)["startingOffsets"]) == {"a": {"0": 10, "1": -2}, "b": {"0": -2}}
    assert reader_options(two)["startingOffsets"] == "earliest" and two.sasl_jaas == "j"
    assert all("startingTimestamp" in reader_options(s) for s in resume_sources(plan, pos, start_timestamp=5))
