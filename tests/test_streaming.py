"""Stream/batch agreement and replay of a micro-batch."""

import tempfile

from pyspark.sql import functions as F

from eventlake.plans.pipeline import run
from eventlake.sources.metadata import sample_metadata
from eventlake.sources.records import mixed_records
from eventlake.streaming.runner import read_raw_files, start
from eventlake.operators.positions import starting_offsets
from eventlake.streaming.sink import BatchWriter, MetadataCache, compact_counters, counter_totals, latest_positions


def _counts(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_equals_batch_and_replay_is_idempotent(spark, small_dir):
    work = tempfile.mkdtemp(prefix="eventlake-test-", dir="/tmp")
    raw = mixed_records(spark, small_dir)
    raw.repartition(4).write.parquet(f"{work}/in")
    meta = MetadataCache(lambda: sample_metadata(spark, small_dir), ttl=0)
    writer = BatchWriter(f"{work}/out", meta)
    q = start(read_raw_files(spark, f"{work}/in", max_files_per_trigger=1), writer, f"{work}/ckpt",
              available_now=True)
    q.awaitTermination(300)
    assert q.lastProgress is not None

    batch = run(raw, sample_metadata(spark, small_dir))
    expected = _counts(batch.counters())
    assert _counts(counter_totals(spark, f"{work}/out")) == expected

    pos = {(r.server, r.topic, r.partition): r.offset for r in latest_positions(spark, f"{work}/out").collect()}
    exp = {(r.server, r.topic, r.partition): r.offset for r in batch.positions().collect()}
    assert pos == exp

    # a batch delivered twice (replay after a failure) is written once
    first = spark.read.parquet(f"{work}/in").limit(50).cache()
    writer(first, 999)
    writer(first, 999)
    main = spark.read.parquet(f"{work}/out/main").filter(F.col("batch_id") == 999)
    assert main.count() == run(first, sample_metadata(spark, small_dir)).main().count()
    deltas = spark.read.parquet(f"{work}/out/counter_deltas").filter(F.col("batch_id") == 999).drop("batch_id", "run_id")
    assert _counts(deltas) == _counts(run(first, sample_metadata(spark, small_dir)).counters())


def test_restart_with_a_new_checkpoint_keeps_earlier_output(spark, small_dir):
    """Stop, start with a new checkpoint at the resume positions: every record once."""
    work = tempfile.mkdtemp(prefix="eventlake-test-", dir="/tmp")
    raw = mixed_records(spark, small_dir)
    cut = raw.select(F.percentile_approx("offset", 0.5)).first()[0]
    raw.where(F.col("offset") <= cut).coalesce(2).write.parquet(f"{work}/in1")
    meta = MetadataCache(lambda: sample_metadata(spark, small_dir), ttl=3600)
    start(read_raw_files(spark, f"{work}/in1", 1), BatchWriter(f"{work}/out", meta), f"{work}/c1", available_now=True).awaitTermination(300)
    compact_counters(spark, f"{work}/out")
    held = latest_positions(spark, f"{work}/out").withColumnRenamed("offset", "resume_offset")
    following = raw.join(starting_offsets(held), ["server", "consumer_group", "topic", "partition"], "left")
    following = following.where("next_offset IS NULL OR offset >= next_offset").select(raw.columns)
    following.coalesce(2).write.parquet(f"{work}/in2")
    start(read_raw_files(spark, f"{work}/in2", 1), BatchWriter(f"{work}/out", meta), f"{work}/c2", available_now=True).awaitTermination(300)
    batch = run(raw, sample_metadata(spark, small_dir))
    assert _counts(counter_totals(spark, f"{work}/out")) == _counts(batch.counters())
    compact_counters(spark, f"{work}/out")
    assert _counts(counter_totals(spark, f"{work}/out")) == _counts(batch.counters())
    out = spark.read.parquet(f"{work}/out/main")
    assert out.select("run_id").distinct().count() == 2
    assert out.count() == batch.main().count()
    assert {"insert_time", "job_id"} <= set(spark.read.parquet(f"{work}/out/positions").columns)


def test_metadata_cache_is_a_snapshot(spark, small_dir):
    reads = []

    def load():
        reads.append(1)
        if len(reads) > 1:
            raise OSError("store is down")
        return sample_metadata(spark, small_dir)

    cache = MetadataCache(load, ttl=3600)
    assert cache.get() is cache.get() and len(reads) == 1
    cache.ttl = 0
    meta = cache.get()
    assert len(reads) == 2 and meta.trans_rule.count() == 12
    plan = meta.source_sink._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in plan and "FileScan" not in plan
