"""eventlake: a Spark-native event-ingestion engine.

Raw stream records (Kafka layout) are decoded, split, routed to projects by
small metadata tables, flattened and typed by property rules, validated, and
written as a main output, an invalid output with reasons, stage counters and
an offset audit.  Every step is a DataFrame -> DataFrame function that runs
unchanged in batch and in Structured Streaming.
"""

from eventlake.config import PipelineConfig

__all__ = ["PipelineConfig"]
