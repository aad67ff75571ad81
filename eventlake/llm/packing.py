"""Best-fit packing of token pieces into sequences: a bounded-space online
packer whose open bins are kept in a bitset keyed by free space."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import checkpointed
from eventlake.llm.tokens import encoder

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class BestFit:
    """Online best fit for pieces of 1..capacity tokens.

    Bit f of `mask` says that some open bin has f free places.  A piece goes to
    the open bin with the least sufficient space; if none fits, a new bin is
    opened, and when more than `open_bins` are open the fullest closes first.
    A bin without space closes at once.
    """

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.mask, self.count, self.made = 0, 0, 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, length: int) -> tuple[int, int]:
        """(bin number, offset in it) of the next piece."""
        fitting = self.mask >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            self.bins[left].append(number)
            self.mask |= 1 << left
            self.count += 1
            if self.count > self.open_bins:
                self._take((self.mask & -self.mask).bit_length() - 1)
        return number, self.capacity - free

    def _take(self, free: int) -> int:
        number = self.bins[free].pop()
        if not self.bins[free]:
            self.mask ^= 1 << free
        self.count -= 1
        return number


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Pieces of every whole text (null: empty): doc_id, piece, start, length, ids_crc32.

    Ids are those of the text followed by `end_id`, so that an empty text has
    one piece of one token.  Documents over `capacity` are cut into pieces of
    `capacity` tokens, of which only the first may be shorter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path, keep_space=True), np.uint32(end_id).tobytes()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            out: list[tuple] = []
            for doc_id, text in zip(ids, texts, strict=True):
                raw = encode.ids(text.as_py()) + end
                n, k, at = len(raw) // 4, 0, 0
                while at < n:
                    stop = at + (n - at - 1) % capacity + 1 if not k else at + capacity
                    out.append((doc_id, k, at, stop - at, zlib.crc32(raw[4 * at : 4 * stop])))
                    k, at = k + 1, stop
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECE_SCHEMA)


def pack(
    pieces_df: DataFrame, capacity: int = 1024, open_bins: int = 16_384, group_rows: int = 32_768
) -> DataFrame:
    """Add sequence_id and offset to pieces (columns of `pieces`).

    Pieces are dealt by a hash to groups of about `group_rows`, longest first
    within a group, and each group is packed online by `BestFit` while its rows
    stream through.  The state of a group is its open bins only, so a larger
    group costs no memory.  Ties and repeated rows: the order within a group is
    total but for equal rows, which are interchangeable; a lost task makes the
    same bins again.  No pieces give no rows.
    """
    spark = pieces_df.sparkSession
    rows = checkpointed(pieces_df)
    groups = max(1, -(-rows.count() // group_rows))
    dealt = (
        rows.withColumn("grp", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
        .repartition(min(groups, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1) * 4), "grp")
        .sortWithinPartitions("grp", F.desc("length"), "doc_id", "piece", "ids_crc32")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, packer = None, BestFit(capacity, open_bins)
        for batch in batches:
            placed = []
            for g, n in zip(batch.column("grp").to_pylist(), batch.column("length").to_pylist(), strict=True):
                if g != group:
                    group, packer = g, BestFit(capacity, open_bins)
                number, offset = packer.put(n)
                placed.append(((g << 32) + number, offset))
            seq, off = zip(*placed, strict=True) if placed else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(seq, pa.int64()), pa.array(off, pa.int64())],
                [*batch.schema.names[:5], "sequence_id", "offset"],
            )

    return dealt.mapInArrow(run, PIECE_SCHEMA + ", sequence_id bigint, offset bigint")
