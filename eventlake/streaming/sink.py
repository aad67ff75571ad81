"""One foreachBatch writer for all outputs of a micro-batch.

Every output of batch N of a run goes to `<root>/<output>/run_id=R/batch_id=N`
with overwrite, so a batch replayed after a failure replaces its own files:
main, invalid, counter deltas and positions are exactly-once although each
write is a plain file write.  A run is a stream checkpoint: a restart from
explicit positions has a new one, begins again at batch 0 and cannot touch the
output of earlier runs.  Counter totals (A6) are the sum of a compacted
snapshot and the deltas after it.
"""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.config import PipelineConfig
from eventlake.operators.counters import COUNTER_KEY, merge_counters
from eventlake.operators.events import event_json, invalid_json
from eventlake.operators.metadata import Lookup, Metadata
from eventlake.plans.pipeline import PipelineResult, offset_positions, transform

log = logging.getLogger(__name__)

OUTPUTS = ("main", "invalid", "counter_deltas", "positions")


class MetadataCache:
    """Metadata re-read at most every `ttl` seconds and held as a snapshot,
    so batches in between do not touch the store; a failed read is logged and
    keeps the last good snapshot (the first read must succeed)."""

    def __init__(self, loader: Callable[[], Metadata], ttl: float = 60.0):
        self.loader, self.ttl = loader, ttl
        self._meta: Metadata | None = None
        self._at = 0.0

    def get(self) -> Metadata:
        now = time.time()
        if self._meta is None or now - self._at >= self.ttl:
            try:
                self._meta = self.loader().snapshot()
                self._at = now
            except Exception:
                if self._meta is None:
                    raise
                log.exception("metadata refresh failed; the snapshot of %s is kept", time.ctime(self._at))
        return self._meta


class BatchWriter:
    def __init__(self, root: str, metadata: MetadataCache, config: PipelineConfig | None = None,
                 main_sink: Callable[[DataFrame, int], None] | None = None,
                 invalid_sink: Callable[[DataFrame, int], None] | None = None,
                 run_id: str | None = None, checkpoint_location: str | None = None, job_id: str = "job"):
        self.root = root.rstrip("/")
        self.metadata = metadata
        self.config = config or PipelineConfig()
        self.main_sink, self.invalid_sink = main_sink, invalid_sink
        self.run_id, self.checkpoint_location, self.job_id = run_id, checkpoint_location, job_id

    def _run(self, spark: SparkSession) -> str:
        """The run's name: the query id that Spark keeps in the stream checkpoint."""
        if self.run_id is None:
            self.run_id = "none"
            if self.checkpoint_location:
                kept = spark.read.text(f"{self.checkpoint_location.rstrip('/')}/metadata").first()
                self.run_id = json.loads(kept[0])["id"]
        return self.run_id

    def _path(self, output: str, batch_id: int) -> str:
        return f"{self.root}/{output}/run_id={self.run_id}/batch_id={batch_id}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self._run(batch.sparkSession)
        parts = transform(batch, self.metadata.get(), self.config).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            res = PipelineResult(parts)
            main = res.main(self.config.drop_invalid)
            if self.main_sink is not None:
                self.main_sink(main, batch_id)
            else:
                main.select(
                    "server", "consumer_group", "topic", "partition", "offset", "project",
                    event_json(main).alias("value"), "error_reason",
                ).write.mode("overwrite").parquet(self._path("main", batch_id))
            invalid = res.invalid()
            if self.invalid_sink is not None:
                self.invalid_sink(invalid, batch_id)
            else:
                invalid.withColumn("value", invalid_json()).write.mode("overwrite").parquet(
                    self._path("invalid", batch_id))
            res.counters().write.mode("overwrite").parquet(self._path("counter_deltas", batch_id))
            offset_positions(batch).withColumns({
                "insert_time": F.current_timestamp(), "job_id": F.lit(self.job_id)
            }).write.mode("overwrite").parquet(self._path("positions", batch_id))
        finally:
            parts.unpersist()


def _deltas(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/counter_deltas").withColumn("batch_id", F.col("batch_id").cast("bigint"))


def _latest_snapshot(spark: SparkSession, root: str) -> str | None:
    """Path of the newest complete snapshot (snapshots are versioned; the newest has the largest number)."""
    from pyspark.errors import AnalysisException

    try:
        done = spark.read.parquet(f"{root}/counter_snapshots/*/totals").select(F.input_file_name().alias("f"))
        version = done.agg(F.max(F.regexp_extract("f", r"/version=(\d+)/", 1).cast("bigint"))).first()[0]
    except AnalysisException:
        return None
    return None if version is None else f"{root}/counter_snapshots/version={version}"


def _after(deltas: DataFrame, snapshot: str | None) -> DataFrame:
    if snapshot is None:
        return deltas
    # a row for each run: the last batch whose delta the snapshot holds
    held = Lookup.of(deltas.sparkSession.read.parquet(f"{snapshot}/batches").select("run_id", F.col("batch_id").alias("upto")))
    rows = held.attach(deltas, {"run_id": "run_id"}, F.col("batch_id"))
    return rows.where(F.col("upto").isNull() | (F.col("batch_id") > F.col("upto")))


def counter_totals(spark: SparkSession, root: str) -> DataFrame:
    """Running totals = the newest snapshot plus the deltas after it (a replayed
    batch overwrote its own delta, so nothing is counted twice)."""
    root = root.rstrip("/")
    snapshot = _latest_snapshot(spark, root)
    new = _after(_deltas(spark, root), snapshot).groupBy(*COUNTER_KEY).agg(F.sum("cnt").cast("bigint").alias("cnt"))
    return new if snapshot is None else merge_counters(spark.read.parquet(f"{snapshot}/totals"), new)


def compact_counters(spark: SparkSession, root: str) -> None:
    """Merge the deltas into a new snapshot.  Call it between batches; deltas
    that it holds are not read again and may be archived.  `totals` is written
    last: a snapshot without it does not count."""
    root = root.rstrip("/")
    last = _latest_snapshot(spark, root)
    version = 0 if last is None else int(last.rsplit("=", 1)[1]) + 1
    path = f"{root}/counter_snapshots/version={version}"
    totals = counter_totals(spark, root)
    _deltas(spark, root).groupBy("run_id").agg(F.max("batch_id").alias("batch_id")).write.mode("overwrite").parquet(f"{path}/batches")
    totals.write.mode("overwrite").parquet(f"{path}/totals")


def latest_positions(spark: SparkSession, root: str) -> DataFrame:
    """R1 from our own audit: the largest offset written per partition."""
    pos = spark.read.parquet(f"{root.rstrip('/')}/positions")
    return pos.groupBy("server", "consumer_group", "topic", "partition").agg(F.max("offset").alias("offset"))


def kafka_invalid_sink(servers: str, topic: str, extra: dict | None = None) -> Callable[[DataFrame, int], None]:
    """Invalid records as JSON values (the record, its lineage, reason and tag) to a Kafka topic."""
    from eventlake.sources.kafka import writer_options

    def write(invalid: DataFrame, batch_id: int) -> None:
        invalid.select(invalid_json().cast("binary").alias("value")).write.format("kafka").options(
            **writer_options(servers, topic, extra)).save()

    return write


def kafka_main_sink(servers: str, topic: str, extra: dict | None = None) -> Callable[[DataFrame, int], None]:
    """Main rows as JSON values, no key, to a Kafka topic (at-least-once)."""
    from eventlake.sources.kafka import writer_options

    def write(main: DataFrame, batch_id: int) -> None:
        main.select(event_json(main).cast("binary").alias("value")).write.format("kafka").options(
            **writer_options(servers, topic, extra)).save()

    return write
