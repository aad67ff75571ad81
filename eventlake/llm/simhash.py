"""SimHash near-duplicates: 64-bit fingerprints of word shingles, linked by a
Gray-order hierarchical index, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import checkpointed, components, different_rows, free_name, only_cache, row_key, row_slices, text_buffer

LEAF = 32


def _bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Majority fingerprint of each text; counts: hashes of each text, in order."""
    out = np.zeros((len(counts), 64), np.int64)
    text = np.repeat(np.arange(len(counts)), counts)
    for lo in range(0, len(hashes), 1 << 15):
        part, of = hashes[lo : lo + (1 << 15)], text[lo : lo + (1 << 15)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        heads = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        out[of[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int32)
    ones = (out * 2 > counts[:, None]).astype(np.uint8)
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` (doc_id) and `fp`, the SimHash of each whole text as a signed long.

    Words are `[^\\x20\\x09-\\x0D]+` after A-Z folding; a shingle is `shingle`
    words joined by one blank, repeats counted; a text of fewer words is one
    shingle, a null or wordless text has fingerprint 0.  A bit is 1 if set in
    over half of the shingles' XXH64.
    """
    keep = keep or ["doc_id"]
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("__text"))
    schema = ", ".join(f"`{c}` {t}" for c, t in source.dtypes[:-1]) + ", fp bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_cache(None)
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            data, offsets = text_buffer(batch.column(len(keep)))
            fps = []
            for lo, hi in row_slices(offsets, 1 << 20):
                counts, hashes = [], []
                for k in range(lo, hi):
                    words = data[offsets[k] : offsets[k + 1]].tobytes().lower().split()
                    joined = b" ".join(words)
                    if len(words) <= shingle:
                        got = [digest(joined, seed)] if words else []
                    else:
                        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
                        starts = np.r_[0, ends[:-shingle] + 1].tolist()
                        got = [digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
                    counts.append(len(got))
                    hashes.append(np.array(got, np.uint64))
                fps.append(_bits(np.concatenate(hashes), np.array(counts, np.int64)))
            fp = np.concatenate(fps).view(np.int64) if fps else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(fp)], [*keep, "fp"])

    return source.mapInArrow(run, schema)


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of each fingerprint in the reflected Gray order."""
    x = fp.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


def shared_bits(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row of fingerprints: mask of the bits that all of them share, and their pattern."""
    every, some = np.bitwise_and.reduce(groups, axis=1), np.bitwise_or.reduce(groups, axis=1)
    mask = ~(every ^ some)
    return mask, every & mask


def _leaves(fps: np.ndarray) -> np.ndarray:
    """Fingerprints in rows of LEAF; the last row is filled up with its last one."""
    return np.r_[fps, np.full(-len(fps) % LEAF, fps[-1], np.uint64)].reshape(-1, LEAF)


def match(a: np.ndarray, b: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices (into a, b) of all pairs within `distance`: leaf pairs first by their shared bits."""
    la, lb = _leaves(a), _leaves(b)
    (ma, pa_), (mb, pb) = shared_bits(la), shared_bits(lb)
    found_a, found_b = [], []
    for lo in range(0, len(la), 256):
        away = np.bitwise_count((pa_[lo : lo + 256, None] ^ pb) & ma[lo : lo + 256, None] & mb)
        i, j = np.nonzero(away <= distance)
        for at in range(0, len(i), 2048):
            x, y = i[at : at + 2048] + lo, j[at : at + 2048]
            n, p, q = np.nonzero(np.bitwise_count(la[x][:, :, None] ^ lb[y][:, None, :]) <= distance)
            found_a.append(x[n] * LEAF + p)
            found_b.append(y[n] * LEAF + q)
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j = np.concatenate(found_a), np.concatenate(found_b)
    real = (i < len(a)) & (j < len(b))
    return i[real], j[real]


def spanning(i: np.ndarray, j: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A star forest with the components of the pairs (i, j) over n nodes, by label minimum and jumping."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[label]
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    at = np.flatnonzero(label != np.arange(n))
    return at, label[at]


def links(fps: DataFrame, distance: int = 2, block_rows: int = 2048, max_blocks: int = 65_536) -> DataFrame:
    """Edges (a, b) of distinct fingerprints (column fp), whose components are
    those of all pairs within `distance` differing bits; no such pair is lost.

    Fingerprints are range-partitioned by Gray rank and cut into blocks of
    consecutive ones.  A block's upper node holds the bits that all its
    fingerprints share.  Only the upper nodes are gathered: at most about
    `max_blocks` rows of 24 bytes, since the block size grows with the input.
    Two blocks meet only if their shared bits differ in at most `distance`
    places; inside, leaves of 32 fingerprints are pruned the same way.  Each
    pair of blocks gives a forest, never all pairs.
    """
    spark = fps.sparkSession

    def ranks(batches):
        for batch in batches:
            rank = gray_rank(batch.column(0).to_numpy().view(np.uint64)) ^ np.uint64(1 << 63)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rank.view(np.int64))], ["fp", "rank"])

    ranked = checkpointed(fps.select("fp").mapInArrow(ranks, "fp bigint, rank bigint"))
    rows = max(block_rows, -(-ranked.count() // max_blocks))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def cut(batches):
        from pyspark import TaskContext

        number, rest = TaskContext.get().partitionId() << 32, np.zeros(0, np.uint64)

        def made(fp):
            nonlocal number
            mask, pattern = shared_bits(fp[None, :])
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array(mask.view(np.int64)), pa.array(pattern.view(np.int64)), pa.array([fp.tobytes()], pa.binary())],
                ["block", "mask", "pattern", "fps"],
            )

        for batch in batches:
            rest = np.r_[rest, batch.column(0).to_numpy().view(np.uint64)]
            while len(rest) >= rows:
                yield made(rest[:rows])
                rest = rest[rows:]
        if len(rest):
            yield made(rest)

    blocks = checkpointed(
        ranked.repartitionByRange(parts, "rank").sortWithinPartitions("rank").select("fp")
        .mapInArrow(cut, "block bigint, mask bigint, pattern bigint, fps binary")
    )
    nodes = blocks.select("block", "mask", "pattern").toPandas()
    known = spark.sparkContext.broadcast(
        (nodes["block"].to_numpy(np.int64), nodes["mask"].to_numpy(np.int64), nodes["pattern"].to_numpy(np.int64))
    )

    def partners(batches):
        number, masks, patterns = known.value
        for batch in batches:
            left, right = [], []
            for b, m, p in zip(*(batch.column(k).to_numpy() for k in range(3)), strict=True):
                near = np.bitwise_count((patterns ^ p) & masks & m) <= distance
                other = number[near & (number >= b)]
                left.append(np.full(len(other), b))
                right.append(other)
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["x", "y"])

    def solve(batches):
        for batch in batches:
            out_a, out_b = [], []
            for same, fa, fb in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                a, b = np.frombuffer(fa, np.uint64), np.frombuffer(fb, np.uint64)
                i, j = match(a, b, distance)
                both = a if same else np.r_[a, b]
                child, root = spanning(i, j if same else j + len(a), len(both))
                out_a.append(both[child].view(np.int64))
                out_b.append(both[root].view(np.int64))
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], ["a", "b"])

    pairs = blocks.select("block", "mask", "pattern").mapInArrow(partners, "x bigint, y bigint").repartition(parts)
    left = blocks.select(F.col("block").alias("x"), F.col("fps").alias("fx"))
    right = blocks.select(F.col("block").alias("y"), F.col("fps").alias("fy"))
    met = pairs.join(left, "x").join(right, "y").select((F.col("x") == F.col("y")).alias("same"), "fx", "fy")
    return met.mapInArrow(solve, "a bigint, b bigint")


def groups(docs: DataFrame, shingle: int = 3, distance: int = 2, keep: list[str] | None = None) -> DataFrame:
    """Every row of docs with `keep` columns, fp, fingerprint (hex) and component_id.

    component_id is the smallest doc_id that can be reached over links of at
    most `distance` bits between fingerprints; equal fingerprints are always
    linked.  Null doc_ids take part but are never the smallest unless there is
    no other.  Copies meet in a grouped minimum that is combined map-side.
    """
    rows = checkpointed(fingerprints(docs, shingle, keep=keep))
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("low"))
    distinct = checkpointed(distinct)
    roots = components(links(distinct, distance))
    of = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    least = of.groupBy("root").agg(F.min("low").alias("component_id"))
    final = of.join(least, "root").select("fp", "component_id")
    return rows.join(final, "fp").withColumn("fingerprint", F.lpad(F.lower(F.hex("fp")), 16, "0"))


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """docs with one row for each group of `groups`: the smallest doc_id's (then
    the smallest row digest's; of equal rows one).  Columns are left as they are.  Different
    rows that share a digest with the chosen one stay, too: none is lost to a collision."""
    row = free_name(docs, "__row")
    keyed = row_key(docs, row)
    found = checkpointed(groups(keyed, shingle, distance, keep=["doc_id", row]))
    first = found.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", row)).alias("k"))
    kept = found.groupBy(row).agg(F.count("*").alias("n")).join(first.select(F.col(f"k.{row}").alias(row)), row)
    kept = checkpointed(kept)
    once = keyed.join(kept.where("n = 1"), row, "left_semi")
    more = different_rows(keyed.join(kept.where("n > 1"), row, "left_semi"))
    return once.union(more).drop(row)
