"""Helpers shared by the training-data operators: shared folders, words of
Arrow text columns as numpy arrays, and connected components on Spark."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.session import ensure_checkpoint_dir

#: ASCII white space (0x20, 0x09-0x0D) and A-Z folding as byte tables.
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_SEGMENT = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_TABLES: dict[str, np.ndarray] = {}


_CACHES: dict[str, Callable[[], None]] = {}


def only_cache(name: str | None, clear: Callable[[], None] | None = None) -> None:
    """A worker process serves one operator after another: free what the others keep
    in it.  Called where a task begins; `clear` empties the caller's own cache."""
    for other in [k for k in _CACHES if k != name]:
        _CACHES.pop(other)()
    if name and clear:
        _CACHES[name] = clear


def shared_dir(spark: SparkSession, tag: str) -> str:
    """A new folder under spark.checkpoint.dir, which driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage: rows go to the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def _plain(df: DataFrame) -> list:
    return [F.col(f"`{c}`").cast("string") if t.startswith(("map", "variant")) else F.col(f"`{c}`") for c, t in df.dtypes]


def row_key(df: DataFrame, name: str) -> DataFrame:
    """Add a 64-bit digest of the whole row; equal rows share it, null ids are no problem."""
    return df.withColumn(name, F.xxhash64(*_plain(df)))


def different_rows(df: DataFrame) -> DataFrame:
    """Each row once, compared by a 256-bit digest of all columns (of any type)."""
    name = free_name(df, "__sha")
    return df.withColumn(name, F.sha2(F.to_json(F.struct(*_plain(df))), 256)).dropDuplicates([name]).drop(name)


def free_name(df: DataFrame, name: str) -> str:
    """`name`, made longer until no column of df has it."""
    while name in df.columns:
        name += "_"
    return name


def ascii_lower(col):
    """A-Z to a-z and nothing else."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit keys (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per-byte random values and powers of an odd base with their inverses (mod 2^64)."""
    if "byte" not in _TABLES:
        _TABLES["byte"] = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    if len(_TABLES.get("power", ())) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("power", _BASE), ("inverse", inverse)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _TABLES[name] = np.cumprod(steps, dtype=np.uint64)
    return _TABLES["byte"], _TABLES["power"], _TABLES["inverse"]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a string column; null counts as empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def row_slices(offsets: np.ndarray, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about `limit` bytes each (one row at least)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


class Words:
    """Words `[^\\x20\\x09-\\x0D]+` of some texts: start and end (byte positions
    in `data`), 64-bit hash, and `first`: n_texts + 1 offsets into the words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        starts, ends, hashes = [], [], []
        lo, end = int(offsets[0]), int(offsets[-1])
        while lo < end:
            hi = min(lo + _SEGMENT, end)
            while hi < end and not _IS_SPACE[data[hi]]:  # never inside a word
                stop = min(hi + 4096, end)
                gap = np.flatnonzero(_IS_SPACE[data[hi:stop]])
                hi = hi + int(gap[0]) if len(gap) else stop
            part = data[lo:hi]
            inside = ~_IS_SPACE[part]
            cuts = offsets[np.searchsorted(offsets, lo, "right") : np.searchsorted(offsets, hi, "left")] - lo
            is_start, is_end = inside.copy(), inside.copy()
            joined = inside[1:] & inside[:-1]
            joined[cuts - 1] = False
            is_start[1:] &= ~joined
            is_end[:-1] &= ~joined
            s, e = np.flatnonzero(is_start), np.flatnonzero(is_end) + 1
            byte, power, inverse = _tables(max(len(part), _SEGMENT) + 1)
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(byte[_LOWER[part] if lower else part] * power[: len(part)], out=total[1:])
            hashes.append(mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64)))
            starts.append(s + lo)
            ends.append(e + lo)
            lo = hi
        join = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        self.start, self.end, self.hash = join(starts, np.int64), join(ends, np.int64), join(hashes, np.uint64)
        self.first = np.searchsorted(self.start, offsets)


def span_any(first: np.ndarray, n: int) -> np.ndarray:
    """Text number of each of n items, from the offsets of the texts' first items."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): rows (node, root), root = smallest
    node; nodes without an edge to another node are not listed.

    Alternating large-star and small-star rounds, each cut by a checkpoint;
    every step is a grouped minimum (combined map-side) and an equi-join, so a
    node with many neighbours is never gathered.  Empty edges give no rows.
    """
    now = checkpointed(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    seen = None
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = both.join(low, both.a == low.k).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "k")
        small = (
            large.join(low, large.a == low.k)
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                                      F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct()
        )
        now = checkpointed(small)
        state = now.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38, 0)))")).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = state
    raise RuntimeError("components did not settle")
