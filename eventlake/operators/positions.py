"""Offset audit and restart positions (A3 A4 A7-A11, F5, J7 J8, R1-R8) as
DataFrame queries over the audit table, the source records and the sink.

audit:  kafka_server, group_name, topic_name, partition_id, offset, insert_time
source: raw records (server, consumer_group, topic, partition, offset, timestamp)
sink:   main-output rows with sink_partition, sink_offset and lineage columns
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.functions.json import at_pointer
from eventlake.functions.text import is_not_blank
from eventlake.operators.metadata import Lookup

KEY = ["server", "consumer_group", "topic", "partition"]


def audit_rows(source: DataFrame, checkpoint_every: str = "1 hour", job_id: str = "job") -> DataFrame:
    """What the offset audit holds after each checkpoint: per checkpoint
    window and partition, the largest offset read in it (D6 fixed)."""
    w = F.window(F.col("timestamp").cast("timestamp"), checkpoint_every).end
    return (
        source.groupBy(*KEY, w.alias("insert_time"))
        .agg(F.max("offset").alias("offset"))
        .select(
            "insert_time", F.col("server").alias("kafka_server"), F.col("topic").alias("topic_name"),
            F.col("partition").alias("partition_id"), "offset", F.col("consumer_group").alias("group_name"),
            F.lit(job_id).alias("job_id"),
        )
    )


def latest_checkpoint(audit: DataFrame) -> DataFrame:
    """The largest audited offset per partition."""
    return (
        audit.groupBy(
            F.col("kafka_server").alias("server"), F.col("group_name").alias("consumer_group"),
            F.col("topic_name").alias("topic"), F.col("partition_id").alias("partition"),
        ).agg(F.max("offset").alias("ckpt_offset"))
    )


def end_offsets(source: DataFrame) -> DataFrame:
    """A10/R2: last offset per partition (Kafka end offset - 1)."""
    return source.groupBy("server", "topic", "partition").agg(F.max("offset").alias("end_offset"))


def lag(ckpt: DataFrame, ends: DataFrame) -> DataFrame:
    """Checkpoint positions joined with end offsets; lag = max(end - ckpt, 0)."""
    j = ckpt.join(ends, ["server", "topic", "partition"], "inner")
    return j.withColumn("lag", F.greatest(F.col("end_offset") - F.col("ckpt_offset"), F.lit(0)))


def lag_rollup(lags: DataFrame) -> DataFrame:
    """Lag per (server, topic), per server and in total."""
    return lags.rollup("server", "topic").agg(F.sum("lag").cast("bigint").alias("lag"))


def sink_tail(sink: DataFrame, rows_back: Column) -> DataFrame:
    """The last `rows_back` rows of every sink partition."""
    ends = Lookup.of(sink.groupBy("sink_partition").agg(F.max("sink_offset").alias("_end")))
    j = ends.attach(sink, {"sink_partition": "sink_partition"}, F.col("sink_offset"))
    return j.filter(F.col("sink_offset") > F.col("_end") - rows_back).drop("_end")


def last_rows(sink: DataFrame, n: int, partition: str = "sink_partition", offset: str = "sink_offset", bins: int = 1024) -> DataFrame:
    """F5/R4 exactly: the `n` rows of largest offset of every partition, however many offsets are missing.

    No partition is sorted: the place of the n-th largest offset is narrowed down by
    histograms of `bins` bins (counted map-side; a bin holds the place, and becomes the next
    range), so even a single huge partition is counted by all tasks.  Each round
    reads two columns; the offsets' range shrinks 1024-fold, so two or three rounds do.
    All rows of the offset in n-th place are kept if it occurs more than once; rows without a
    partition or an offset have no place and are left out."""
    if n <= 0:
        return sink.limit(0)
    spark = sink.sparkSession
    p, o = F.col(partition), F.col(offset)
    placed = sink.where(p.isNotNull() & o.isNotNull())
    ends = placed.groupBy(p.alias("_p")).agg(F.min(o).alias("_low"), F.max(o).alias("_high"), F.count("*").alias("_n"))
    # a few numbers for each sink partition; a range without an upper end is settled: all rows from its lower end on are wanted
    ranges = ends.select("_p", "_low", F.when(F.col("_n") > n, F.col("_high")).alias("_high"), F.lit(n).cast("bigint").alias("_need")).toArrow()
    settled = []
    while True:
        open_ = pc.fill_null(pc.less(ranges["_low"], ranges["_high"]), False)
        settled.append(ranges.filter(pc.invert(open_)).select(["_p", "_low"]))
        ranges = ranges.filter(open_)
        if not len(ranges):
            break
        asked = Lookup.held(spark, ranges).attach(placed, {partition: "_p"}, o).where(o.between(F.col("_low"), F.col("_high")))
        width = F.ceil((F.col("_high") - F.col("_low") + 1) / bins).cast("bigint")
        counts = asked.groupBy(p.alias("_p"), "_low", "_high", "_need", ((o - F.col("_low")) / width).cast("bigint").alias("_bin")).agg(F.count("*").alias("_n"))
        down = Window.partitionBy("_p").orderBy(F.desc("_bin"))  # at most `bins` rows
        above = F.sum("_n").over(down) - F.col("_n")
        hit = counts.withColumn("_above", above).where((F.col("_above") < F.col("_need")) & (F.col("_above") + F.col("_n") >= F.col("_need")))
        low = F.col("_low") + F.col("_bin") * width
        high = F.least(low + width - 1, F.col("_high"))
        need = F.col("_need") - F.col("_above")
        ranges = hit.select("_p", low.alias("_low"), F.when(F.col("_n") > need, high).alias("_high"), need.alias("_need")).toArrow()
    wanted = pa.concat_tables(settled).rename_columns(["_p", "_from"])
    return Lookup.held(spark, wanted).attach(placed, {partition: "_p"}, o).where(o >= F.col("_from")).drop("_from")


#: Where a written event holds its source position.
LINEAGE_POINTERS = {
    "server": "/properties/SACONSUMERSERVER",
    "topic": "/properties/SACONSUMERTOPIC",
    "partition": "/properties/SACONSUMERPARTITION",
    "offset": "/properties/SACONSUMEROFFSET",
}


def json_lineage(sink: DataFrame, value: str = "value") -> DataFrame:
    """Sink rows with their source position read from the written JSON text, which is
    parsed once: adds server, topic, partition, offset and `unreadable`, the reason why a row gives
    no position (no JSON, or a blank or wrong field), NULL for rows that do."""
    parsed = sink.withColumn("_json", F.try_parse_json(F.col(value).cast("string")))
    text = {name: at_pointer(F.col("_json"), pointer) for name, pointer in LINEAGE_POINTERS.items()}
    rows = parsed.withColumns({
        "server": text["server"], "topic": text["topic"],
        "partition": text["partition"].try_cast("int"), "offset": text["offset"].try_cast("bigint")})
    blank = ~(is_not_blank(F.coalesce("server", F.lit(""))) & is_not_blank(F.coalesce("topic", F.lit(""))))
    return rows.withColumn("unreadable", F.when(F.col("_json").isNull(), "no JSON").when(
        blank | F.col("partition").isNull() | F.col("offset").isNull(), "no position")).drop("_json")


def json_positions(tail: DataFrame, value: str = "value") -> DataFrame:
    """A8 + F4: largest source offset per (server, topic, partition) of sink rows as written; unreadable rows give none."""
    rows = json_lineage(tail, value).where("unreadable IS NULL")
    return rows.groupBy("server", "topic", "partition").agg(F.max("offset").alias("sink_offset"))


def lineage_positions(tail: DataFrame) -> DataFrame:
    """A8 + F4: largest source offset per (server, topic, partition) read back from
    the sink rows' lineage properties; rows with blank lineage are skipped."""
    def prop(name: str) -> Column:
        return F.try_variant_get(F.col("properties")[name], "$", "string")

    lin = tail.select(
        prop("SACONSUMERSERVER").alias("server"), prop("SACONSUMERTOPIC").alias("topic"),
        prop("SACONSUMERPARTITION").cast("int").alias("partition"),
        prop("SACONSUMEROFFSET").cast("bigint").alias("offset"),
    )
    ok = F.trim("server") != ""
    ok = ok & (F.trim("topic") != "") & F.col("partition").isNotNull() & F.col("offset").isNotNull()
    return lin.filter(ok).groupBy("server", "topic", "partition").agg(F.max("offset").alias("sink_offset"))


def resume_positions(lags: DataFrame, sink_pos: DataFrame) -> DataFrame:
    """No checkpoint -> no explicit position (not listed); lag 0 -> end
    position; else the sink's lineage position, falling back to the checkpoint."""
    j = lags.join(sink_pos, ["server", "topic", "partition"], "left")
    resume = F.when(F.col("lag") == 0, F.col("end_offset")).otherwise(
        F.coalesce(F.col("sink_offset"), F.col("ckpt_offset"))
    )
    return j.select(*KEY, "ckpt_offset", "end_offset", "sink_offset", resume.alias("resume_offset"))


def after_checkpoint(source: DataFrame, ckpt: DataFrame) -> DataFrame:
    """Source rows beyond the checkpoint of their partition (all rows of a partition without one)."""
    rows = Lookup.of(ckpt).attach(source, {k: k for k in KEY}, F.col("offset"))
    return rows.filter(F.col("ckpt_offset").isNull() | (F.col("offset") > F.col("ckpt_offset")))


def replay_rows(source: DataFrame, ckpt: DataFrame, sink_keys: DataFrame) -> DataFrame:
    """R6 (ours): exact replay set: source rows after the checkpoint that the sink
    does not hold, by a left-anti join on (server, topic, partition, offset)."""
    return after_checkpoint(source, ckpt).join(sink_keys, ["server", "topic", "partition", "offset"], "left_anti")


def start_by_timestamp(source: DataFrame, ts: Column) -> DataFrame:
    """Earliest offset at or after `ts` per partition; partitions with no
    such record are left out."""
    return source.filter(F.col("timestamp") >= ts).groupBy("server", "topic", "partition").agg(
        F.min("offset").alias("start_offset")
    )


def starting_offsets(positions: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """S3 in table form: the offset each partition is next read from: one after its
    resume position (D7), or the timestamp start where one is given (R8)."""
    rows = positions.withColumn("next_offset", F.col("resume_offset") + 1)
    if start is not None:
        rows = rows.join(start, ["server", "topic", "partition"], "left").withColumn(
            "next_offset", F.coalesce("start_offset", "next_offset")).drop("start_offset")
    return rows.select(*KEY, "next_offset")
