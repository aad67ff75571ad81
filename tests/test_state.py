"""State kept by streams: over batches, restarts, replays and empty input."""

import pytest
from pyspark.sql import functions as F

from eventlake.operators.counters import COUNTER_KEY
from eventlake.operators.positions import KEY, replay_rows, starting_offsets
from eventlake.plans.pipeline import run
from eventlake.sources.metadata import sample_metadata
from eventlake.sources.records import mixed_records
from eventlake.streaming import state as S
from eventlake.streaming.runner import RAW_SCHEMA, read_raw_files


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def own(spark):
    return S.state_session(spark, 3)


def test_state_is_kept_in_rocksdb_and_apart_from_the_session(spark, own):
    name = "spark.sql.streaming.stateStore.providerClass"
    assert "RocksDB" in own.conf.get(name) and "RocksDB" not in spark.conf.get(name)
    assert own.conf.get("spark.sql.shuffle.partitions") == "3" and spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_positions_and_totals_over_batches_and_restarts(spark, own, small_dir, tmp_path):
    raw = mixed_records(spark, small_dir)
    meta = sample_metadata(own, small_dir).snapshot()
    stream = read_raw_files(own, f"{tmp_path}/in/*", max_files_per_trigger=1)
    for i in range(2):  # the first run takes two micro-batches, the second one starts from its checkpoint
        raw.where(F.col("partition") % 2 == i).repartition(2 - i).write.parquet(f"{tmp_path}/in/load={i}")
        S.start_updates(S.running_positions(stream.select(*KEY, "offset")), f"{tmp_path}/p", f"{tmp_path}/cp", available_now=True).awaitTermination()
        S.start_updates(S.running_totals(stream, meta), f"{tmp_path}/t", f"{tmp_path}/ct", available_now=True).awaitTermination()
    batch = run(raw, sample_metadata(spark, small_dir))
    for got in (S.positions_from_state(spark, f"{tmp_path}/cp"), S.latest(spark, f"{tmp_path}/p", KEY, "offset")):
        assert rows(got) == rows(batch.positions())
    for got in (S.totals_from_state(spark, f"{tmp_path}/ct"), S.latest(spark, f"{tmp_path}/t", COUNTER_KEY, "cnt")):
        assert rows(got) == rows(batch.counters())
    assert len({r.batch_id for r in spark.read.parquet(f"{tmp_path}/p").select("batch_id").distinct().collect()}) >= 3
    # the state gives the offsets that a start without this checkpoint reads next
    held = S.positions_from_state(spark, f"{tmp_path}/cp").withColumnRenamed("offset", "resume_offset")
    assert {r.next_offset for r in starting_offsets(held).collect()} == {r.offset + 1 for r in batch.positions().collect()}


def test_smaller_offsets_of_a_later_batch_change_nothing(spark, own, tmp_path):
    stream = read_raw_files(own, f"{tmp_path}/in/*").select(*KEY, "offset")
    for i, offsets in enumerate(([5, 9, 9], [3, 9], [])):
        made = spark.createDataFrame([("s", "g", "t", 0, o, None, None, None) for o in offsets] + [("s", None, None, None, None, None, None, None)], RAW_SCHEMA)
        made.write.parquet(f"{tmp_path}/in/load={i}")
        S.start_updates(S.running_positions(stream), f"{tmp_path}/p", f"{tmp_path}/c", available_now=True).awaitTermination()
    want = {("s", "g", "t", 0): 9, ("s", None, None, None): None}
    assert {tuple(r)[:4]: r.offset for r in S.positions_from_state(spark, f"{tmp_path}/c").collect()} == want
    assert {tuple(r)[:4]: r.offset for r in S.latest(spark, f"{tmp_path}/p", KEY, "offset").collect()} == want


def test_replays_do_not_come_out_again(spark, own, small_dir, tmp_path):
    raw = mixed_records(spark, small_dir).withColumn("value", F.lit(None).cast("binary"))
    stream = read_raw_files(own, f"{tmp_path}/in/*")
    first, again = raw.where("timestamp < '2024-01-16'"), raw.where("timestamp >= '2024-01-08'")
    for i, part in enumerate((first.union(first.limit(30)), again)):
        part.write.parquet(f"{tmp_path}/in/load={i}")
        S.start_append(S.without_replays(stream), f"{tmp_path}/out", f"{tmp_path}/c", available_now=True).awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.columns == stream.columns
    assert rows(out.select(*S.REPLAY_KEY)) == rows(raw.select(*S.REPLAY_KEY))
    # what the second run added is the batch form's replay set
    ckpt = spark.createDataFrame([], "server string, consumer_group string, topic string, partition int, ckpt_offset bigint")
    added = replay_rows(again, ckpt, first)
    assert out.count() - first.count() == added.count()


def test_event_time_state_survives_downtime(spark, own, small_dir, tmp_path):
    """With the records' own clock, `keep` is measured between records, not since the first delivery."""
    raw = mixed_records(spark, small_dir).withColumn("value", F.lit(None).cast("binary"))
    stream = read_raw_files(own, f"{tmp_path}/in/*")
    for i in range(2):
        raw.write.parquet(f"{tmp_path}/in/load={i}")
        S.start_append(S.without_replays(stream, keep="40 days", event_time="timestamp"), f"{tmp_path}/out", f"{tmp_path}/c", available_now=True).awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == raw.count()


def test_state_before_the_first_batch(spark, tmp_path):
    assert S.positions_from_state(spark, f"{tmp_path}/none").collect() == []
    assert S.totals_from_state(spark, f"{tmp_path}/none").collect() == []
