"""State that Structured Streaming keeps for a run: replay removal (R6), running
totals (A6/S10) and running positions (A4/S9).

Each is a stream of its own beside the one that writes the events, with its own checkpoint:
a second consumer that reads the columns it needs.  State lives in RocksDB with changelog
checkpoints: a micro-batch uploads what it changed and not the whole state.  A
restart on the same checkpoint goes on with the state; `positions_from_state` and
`totals_from_state` read it back as tables, for a start without that checkpoint.

Update mode emits changed rows only.  They are written under the batch's number, with
overwrite, so a batch delivered twice replaces itself; `latest` gives each key's newest row.
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventlake.config import PipelineConfig
from eventlake.operators.counters import COUNTER_KEY
from eventlake.operators.metadata import Metadata
from eventlake.operators.positions import KEY
from eventlake.plans.pipeline import stage_rows, transform

#: Names that Spark gives to the state store and its settings.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

REPLAY_KEY = ["server", "topic", "partition", "offset"]


def state_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of the same application whose streams keep their state in RocksDB.

    The number of state partitions holds for the life of a checkpoint: size it for the
    keys (dozens of topics x partitions need few), not for the records."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    for name, value in STATE_SETTINGS.items():
        own.conf.set(name, value)
    if state_partitions:
        own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return own


def without_replays(records: DataFrame, keep: str = "1 day", event_time: str | None = None) -> DataFrame:
    """Each (server, topic, partition, offset) once, in the stream.

    A record is remembered for at least `keep`.  By default that is time of arrival: no
    record ever counts as late, and a replay is recognised if it begins within `keep` of the first
    delivery.  With `event_time` (a timestamp column of the records) the stream's own clock
    counts: downtime does not age the state, but records more than `keep` behind the newest
    are dropped as late.  Null keys are equal to each other."""
    clock: Column = F.current_timestamp() if event_time is None else F.col(event_time).cast("timestamp")
    return records.withColumn("_seen_at", clock).withWatermark("_seen_at", keep).dropDuplicatesWithinWatermark(REPLAY_KEY).drop("_seen_at")


def running_positions(records: DataFrame) -> DataFrame:
    """A4: the largest offset read so far of every partition: one state row for each."""
    return records.groupBy(*KEY).agg(F.max("offset").alias("offset"))


def running_totals(records: DataFrame, meta: Metadata, config: PipelineConfig | None = None) -> DataFrame:
    """Counts so far per (server, group, project, topic, stage).

    Each task ships one partial row per key, so a topic with a third of all records
    costs the state no more than another.  The metadata are those of the start (`meta.snapshot()`)."""
    return stage_rows(transform(records, meta, config)).groupBy(*COUNTER_KEY).agg(F.sum("n").cast("bigint").alias("cnt"))


def start_updates(rows: DataFrame, path: str, checkpoint_location: str, available_now: bool = False,
                  processing_time: str = "60 seconds", query_name: str | None = None) -> StreamingQuery:
    """Write the changed rows of a running aggregate, a folder for each micro-batch."""
    root = path.rstrip("/")

    def write(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    out = rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint_location)
    if query_name:
        out = out.queryName(query_name)
    return (out.trigger(availableNow=True) if available_now else out.trigger(processingTime=processing_time)).start()


def start_append(rows: DataFrame, path: str, checkpoint_location: str, available_now: bool = False,
                 processing_time: str = "60 seconds") -> StreamingQuery:
    """Write the rows of a stream without replays; the file sink's log makes each batch count once."""
    out = rows.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint_location)
    return (out.trigger(availableNow=True) if available_now else out.trigger(processingTime=processing_time)).start()


def latest(spark: SparkSession, path: str, key: list[str], value: str) -> DataFrame:
    """Each key's newest value among the changed rows of all batches."""
    rows = spark.read.parquet(path)
    return rows.groupBy(*key).agg(F.max_by(value, F.col("batch_id").cast("bigint")).alias(value))


def _state(spark: SparkSession, checkpoint_location: str) -> DataFrame | None:
    try:
        return spark.read.format("statestore").load(checkpoint_location).select("key.*", "value.*")
    except PySparkException as e:
        if e.getCondition() != "STDS_COMMITTED_BATCH_UNAVAILABLE":
            raise
        return None  # the stream has not ended a batch yet


def positions_from_state(spark: SparkSession, checkpoint_location: str) -> DataFrame:
    """S9 read on start: the positions that a stream of `running_positions` has reached (no rows before its first batch)."""
    state = _state(spark, checkpoint_location)
    if state is None:
        return spark.createDataFrame([], "server string, consumer_group string, topic string, partition int, offset bigint")
    return state.select(*KEY, F.col("max").alias("offset"))


def totals_from_state(spark: SparkSession, checkpoint_location: str) -> DataFrame:
    """S10 read on start: the totals that a stream of `running_totals` has reached (no rows before its first batch)."""
    state = _state(spark, checkpoint_location)
    if state is None:
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in COUNTER_KEY) + ", cnt bigint")
    return state.select(*COUNTER_KEY, F.col("sum").cast("bigint").alias("cnt"))
