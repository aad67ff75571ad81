"""Start the pipeline as a Structured Streaming query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from eventlake.streaming.sink import BatchWriter

RAW_SCHEMA = ("server string, consumer_group string, topic string, partition int, offset bigint, "
              "timestamp timestamp_ntz, key binary, value binary")


def read_raw_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw records landed as parquet files (the same layout as the Kafka source)."""
    reader = spark.readStream.schema(RAW_SCHEMA).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def start(stream: DataFrame, writer: BatchWriter, checkpoint_location: str, available_now: bool = False,
          processing_time: str = "60 seconds", query_name: str | None = None) -> StreamingQuery:
    """One foreachBatch query; the checkpoint holds source positions and batch ids."""
    writer.checkpoint_location = writer.checkpoint_location or checkpoint_location
    w = stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint_location)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
