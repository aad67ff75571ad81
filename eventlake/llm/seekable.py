"""Token ids as seekable zstandard files: one independent frame for each
document, and at the end of the file a seek table with per-frame checksums.

Layout of a file, which any zstandard decoder can read through:

    frame 0 .. n-1      ids of one document as little-endian uint32
    skippable frame     (magic 0x184D2A50) ids of the documents: n flags
                        (1: null), then n little-endian int64
    skippable frame     (magic 0x184D2A5E) the seek table: n entries of
                        compressed size, size and low 32 bits of XXH64 of the
                        content, then n, descriptor 0x80, magic 0x8F92EAB1

Documents are in ascending order of id (nulls first), so that a reader finds
one by binary search and decompresses its frame only.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import checkpointed, shared_dir
from eventlake.llm.files import new_file, open_file
from eventlake.llm.tokens import encoder

#: Fixed values of the formats.
SKIPPABLE, SEEKABLE, FOOTER = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
_TABLE = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])
_MANIFEST = "file int, path string, docs bigint, tokens bigint"


class SeekableWriter:
    """Writes documents one by one; only the seek table is kept in memory."""

    def __init__(self, out, level: int = 3):
        self.out, self.table, self.ids = out, [], []
        self.tokens, self.pack = 0, zstandard.ZstdCompressor(level=level).compress

    def add(self, doc_id: int | None, ids: bytes) -> None:
        frame = self.pack(ids)
        self.out.write(frame)
        self.table.append((len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        self.ids.append(doc_id)
        self.tokens += len(ids) // 4

    def close(self) -> None:
        names = bytes(x is None for x in self.ids) + np.array([x or 0 for x in self.ids], "<i8").tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE, len(names)) + names)
        table = np.array(self.table, _TABLE).tobytes()
        self.out.write(struct.pack("<II", SEEKABLE, len(table) + 9) + table)
        self.out.write(struct.pack("<IBI", len(self.table), 0x80, FOOTER))


class SeekableReader:
    """Random access to one file: reads its two tables, then only the frames asked for."""

    def __init__(self, source):
        self.source = source
        end = source.size()
        count, descriptor, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != FOOTER or descriptor != 0x80:
            raise ValueError("no seek table with checksums at the end of the file")
        start = end - 9 - 12 * count
        if struct.unpack("<II", self._at(start - 8, 8)) != (SEEKABLE, 12 * count + 9):
            raise ValueError("the seek table is damaged")
        self.table = np.frombuffer(self._at(start, 12 * count), _TABLE)
        self.offset = np.r_[0, np.cumsum(self.table["packed"], dtype=np.int64)]
        if struct.unpack("<II", self._at(int(self.offset[-1]), 8)) != (SKIPPABLE, 9 * count):
            raise ValueError("the ids of the documents are damaged")
        names = self._at(int(self.offset[-1]) + 8, 9 * count)
        self.null, self.ids = np.frombuffer(names[:count], bool), np.frombuffer(names[count:], "<i8")
        self.unpack = zstandard.ZstdDecompressor().decompress

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def frame(self, number: int) -> bytes:
        """Ids of the document in one frame, checked."""
        row = self.table[number]
        raw = self.unpack(self._at(int(self.offset[number]), int(row["packed"])), max_output_size=int(row["size"]))
        if len(raw) != row["size"] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != row["check"]:
            raise ValueError(f"frame {number} does not match its checksum")
        return raw

    def find(self, doc_id: int | None) -> list[int]:
        """Numbers of the frames that hold documents of this id."""
        first = int(self.null.sum())
        if doc_id is None:
            return list(range(first))
        low, high = (int(np.searchsorted(self.ids[first:], doc_id, side)) + first for side in ("left", "right"))
        return list(range(low, high))

    def __iter__(self) -> Iterator[tuple[int | None, bytes]]:
        for k in range(len(self.table)):
            yield None if self.null[k] else int(self.ids[k]), self.frame(k)


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 1, keep_space: bool = False, level: int = 3) -> DataFrame:
    """Write the ids of every whole text (null: empty), then `end_id`, under `path`.

    Documents are range-partitioned by (doc_id, text digest), so one id that
    holds many rows is spread too, sorted in each partition and streamed into
    one file; files in order of their number hold ascending ids.  Returns the
    manifest (file, path, docs, tokens), a row for each file; an empty table
    gives no files.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text"), "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        name, encode, end = f"{path}/{number:06d}.zst", encoder(tokenizer_path, keep_space), np.uint32(end_id).tobytes()
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        with new_file(name) as out:
            writer = SeekableWriter(out, level)
            while first is not None:
                for doc_id, text in zip(first.column(0).to_pylist(), first.column(1), strict=True):
                    writer.add(doc_id, encode.ids(text.as_py()) + end)
                first = next(batches, None)
            writer.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int32()), pa.array([name]), pa.array([len(writer.table)], pa.int64()), pa.array([writer.tokens], pa.int64())],
            ["file", "path", "docs", "tokens"],
        )

    return checkpointed(rows.repartitionByRange(parts, *order[:2]).sortWithinPartitions(*order).mapInArrow(run, _MANIFEST))


def read(manifest: DataFrame, batch_rows: int = 2000) -> DataFrame:
    """Documents of the files of a manifest: doc_id, start (ids of all documents
    before), n_tokens, ids_crc32 and ids (little-endian uint32 bytes)."""
    from pyspark.sql import Window

    # a row for each file: small, whatever the files hold
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with open_file(path) as f:
                    out: list[tuple] = []
                    for doc_id, raw in SeekableReader(f):
                        out.append((doc_id, start, len(raw) // 4, zlib.crc32(raw), raw))
                        start += len(raw) // 4
                        if len(out) == batch_rows:
                            yield _batch(out)
                            out = []
                    if out:
                        yield _batch(out)

    return files.select("path", "start").repartition(parts, "path").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, ids binary"
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
        ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
    )


def lookup(manifest: DataFrame, wanted: DataFrame) -> DataFrame:
    """Documents with the ids of `wanted` (column doc_id): doc_id, n_tokens, ids.
    Only the frames asked for are read.  Files hold ranges of ids, which are
    compared with the wanted ids inside the tasks that open them."""
    spark = manifest.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def bounds(batches):
        for batch in batches:
            low, high = [], []
            for path in batch.column("path").to_pylist():
                with open_file(path) as f:
                    r = SeekableReader(f)
                    low.append(None if r.null.all() else int(r.ids[int(r.null.sum())]))
                    high.append(None if r.null.all() else int(r.ids[-1]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(low, pa.int64()), pa.array(high, pa.int64())], ["file", "path", "low", "high"])

    # the manifest's bounds are a row for each file; both ascend with the file's number
    files = manifest.select("file", "path").mapInArrow(bounds, "file int, path string, low bigint, high bigint")
    held = sorted(tuple(r) for r in files.where("low IS NOT NULL").collect())
    known = spark.sparkContext.broadcast(([r[1] for r in held], np.array([r[2] for r in held], np.int64), np.array([r[3] for r in held], np.int64)))

    def place(batches):
        paths, low, high = known.value
        for batch in batches:
            ids = batch.column(0).to_numpy()
            first, last = np.searchsorted(high, ids, "left"), np.searchsorted(low, ids, "right")
            rows = [(int(i), paths[k]) for i, a, b in zip(ids, first, last, strict=True) for k in range(a, b)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["doc_id", "path"])

    asked = wanted.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    pairs = asked.mapInArrow(place, "doc_id bigint, path string")
    batches_of = pairs.repartition(parts, "path").sortWithinPartitions("path", "doc_id")

    def run(batches):
        for batch in batches:
            out, f, at, reader = [], None, None, None
            for doc_id, path in zip(batch.column("doc_id").to_pylist(), batch.column("path").to_pylist(), strict=True):
                if path != at:
                    if f:
                        f.close()
                    f, at = open_file(path), path
                    reader = SeekableReader(f)
                for k in reader.find(doc_id):
                    raw = reader.frame(k)
                    out.append((doc_id, len(raw) // 4, raw))
            if f:
                f.close()
            columns = list(zip(*out, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["doc_id", "n_tokens", "ids"])

    return batches_of.select("doc_id", "path").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """Write docs to the shared folder and read the files back (see `read`)."""
    return read(write(docs, shared_dir(docs.sparkSession, "token-files"), tokenizer_path, end_id))
