"""Substring dedup with compact windows: all starts of passages for which a
shingle is among the least of the passage are one row, rows meet by shingle, and
candidate passages are verified on their exact shingle sets.

A passage is `words` words or more; its elements are the shingles of five words.
Two sets of 46 shingles with a Jaccard similarity of 0.8 have 41 in common, so in
any fixed order of all shingles the least common one is among the 6 least of
either (10, where sets of different sizes meet: passages that repeat shingles).
All starts for which a shingle is among these form a compact window.  No pair is
lost by that, whatever the order; with the common shingles last, passages that
share but a common line do not meet.  A shingle that stands once in the corpus
joins nothing.  Starts with the same set of shingles as the start before are left
out and added to the spans that are found: text that repeats itself without a
break is one window and is not compared with itself.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import Words, checkpointed, mix, only_cache, row_slices, shared_dir, span_any, text_buffer
from eventlake.llm.files import array, new_file

SHINGLE = 5
NO_ID = -(1 << 63)
_PIECE = 1 << 23
_BLOCK = 1 << 14
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bits of the number of hash ranges, and of coarse cells.
_PARTS, _COARSE = 6, 23
#: Up to so many (doc, mark) are broadcast.
MAX_BROADCAST = 1_000_000


def shingle_hashes(word_hash: np.ndarray) -> np.ndarray:
    """Hash of the SHINGLE words from each word on (the last ones run out of the array: not to be used)."""
    n = len(word_hash)
    total = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        total[: n - k] = total[: n - k] * _STEP + word_hash[k:]
    return mix(total)


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive values."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = np.minimum(x[: len(x) - step], x[step:])
        done += step
    return x


def repeats(shingles: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each start: how many of its `span` shingles stand there a second time, and
    whether its shingles are as a set those of the start before; for each place: how
    far back its shingle stood before (span + 1: further than `span`)."""
    n, m = len(shingles), len(shingles) - span + 1
    change = np.zeros(n + 1, np.int64)
    back, ahead = np.full(n, span + 1, np.uint8 if span < 255 else np.int64), np.zeros(n, bool)
    for d in range(1, min(span, n - 1) + 1):
        i = np.flatnonzero(shingles[d:] == shingles[:-d]) + d
        i = i[back[i] > span]  # only the nearest one before
        back[i] = d
        ahead[i - d] = True
        if d < span:
            np.add.at(change, np.maximum(i - span + 1, 0), 1)
            np.add.at(change, i - d + 1, -1)
    same = np.zeros(m, bool)
    same[1:] = ahead[: m - 1] & (back[span : span + m - 1] <= span)
    return np.cumsum(change)[:m], same, back


def prefix_runs(rank: np.ndarray, low: np.ndarray, high: np.ndarray, more: np.ndarray, span: int, wanted: np.ndarray, back: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Places, first and last start of each run of subsequences of `span` shingles
    in which fewer than `low` (of the start; `high`, if the place is marked in
    `more`) shingles rank below the one at that place, for the places `wanted`; `back`
    tells a subsequence's first place of a shingle from the others."""
    n, m = len(rank), len(low)
    side, small = span - 1, np.uint8 if span < 100 else np.uint16
    padded = np.r_[np.zeros(side, np.uint64), rank, np.zeros(side, np.uint64)]
    # a start outside 0..m-1 allows none
    limits = [np.r_[np.zeros(side, small), x.astype(small), np.zeros(n - m, small)] for x in (low, high)]
    for base in range(0, n, _BLOCK):
        size = min(_BLOCK, n - base)
        mine = rank[base : base + size]
        less = np.zeros((span, size), small)  # shingles below mine among the d before ...
        after = np.zeros((span, size), small)  # ... and the d after it
        for d in range(1, span):
            np.add(less[d - 1], padded[side + base - d : side + base - d + size] < mine, out=less[d])
            np.add(after[d - 1], padded[side + base + d : side + base + d + size] < mine, out=after[d])
        less += after[::-1]
        marked = more[base : base + size]
        good = np.empty((span, size), bool)
        for d in range(span):
            at = slice(side + base - d, side + base - d + size)
            np.less(less[d], np.where(marked, limits[1][at], limits[0][at]), out=good[d])
            good[d] &= back[base : base + size] > d
        columns = np.flatnonzero(good.any(axis=0) & wanted[base : base + size])
        edge = np.zeros((len(columns), span + 2), np.int8)
        edge[:, 1:-1] = good[:, columns].T
        edge = np.diff(edge, axis=1)
        of, begin = np.nonzero(edge == 1)
        end = np.nonzero(edge == -1)[1] - 1
        place = columns[of] + base
        yield place, place - end, place - begin


def _source(docs: DataFrame) -> DataFrame:
    """doc (null id: NO_ID), mark (32-bit digest, tells texts with one id apart) and text (null: empty)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc"),
        F.expr("cast(xxhash64(text, doc_id) & 2147483647 as bigint)").alias("mark"), text.alias("text"),
    )


def _packed(places: np.ndarray) -> bytes:
    """Ascending places as steps, the bytes of one weight together: most of them are zeros, which the shuffle compresses."""
    return np.diff(places, prepend=np.uint32(0)).astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
    return np.cumsum(steps, dtype=np.uint32)


class Census:
    """What is known of each cell of shingle hashes, in files by hash range: whether it
    holds more than one shingle of the corpus (a bit), and for each of 2^23 coarse cells
    how common its commonest cell is (a level) and, as bit 7, whether one of its
    shingles stands in a passage that repeats shingles and could still meet one that
    does not.  A shingle that is alone joins nothing; levels only order the shingles:
    any order gives the same pairs, but with the common ones last few passages are
    compared for the sake of a common line."""

    def __init__(self, path: str, bits: int):
        self.path, self.bits, self.held = path, bits, frozenset()
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __getstate__(self):
        return self.__dict__ | {"open": {}}

    def look(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each shingle may stand elsewhere too, and its coarse cell's level."""
        part = (hashes >> np.uint64(64 - _PARTS)).astype(np.uint8)
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[order], np.arange((1 << _PARTS) + 1))
        cell = hashes[order] << np.uint64(_PARTS)
        shared, level = np.zeros(len(hashes), bool), np.zeros(len(hashes), np.uint8)
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            if k not in self.held:
                continue
            if k not in self.open:
                self.open[k] = tuple(array(f"{self.path}/{k:03d}.{x}", np.uint8) for x in ("bits", "levels"))
            bits, levels = self.open[k]
            mine = slice(cuts[k], cuts[k + 1])
            at = cell[mine] >> np.uint64(64 - self.bits + _PARTS)
            shared[order[mine]] = (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1
            level[order[mine]] = levels[cell[mine] >> np.uint64(64 - _COARSE + _PARTS)]
        return shared, level


def _census(source: DataFrame, words: int, threshold: float) -> Census:
    span = words - SHINGLE + 1
    most = int(span - threshold * (span - 1) + 1e-9)
    chars = source.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = min(max(int(chars).bit_length(), _COARSE), 32 + _PARTS)
    known = Census(shared_dir(source.sparkSession, "compact-windows"), bits)
    low = np.uint64((1 << (bits - _PARTS)) - 1)

    def cut(cells: np.ndarray) -> np.ndarray:
        return np.searchsorted(cells, np.arange((1 << _PARTS) + 1, dtype=np.uint64) << np.uint64(bits - _PARTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_cache(None)
        held, again, size = [], [], 0

        def made():
            cells, n = np.unique(np.concatenate(held), return_counts=True)
            twice = np.unique(np.concatenate(again))
            a, b = cut(cells), cut(twice)
            cells, n, twice = (cells & low).astype(np.uint32), np.minimum(n, 255).astype(np.uint8), (twice & low).astype(np.uint32)
            rows = [
                (k, _packed(cells[a[k] : a[k + 1]]), n[a[k] : a[k + 1]].tobytes(), _packed(twice[b[k] : b[k + 1]]))
                for k in range(1 << _PARTS) if a[k] < a[k + 1]
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32(), *[pa.binary()] * 3], strict=True)], ["part", "cells", "n", "twice"])

        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            for lo, hi in row_slices(offsets, 1 << 20):
                w = Words(data, offsets[lo : hi + 1], lower=True)
                if len(w.hash) < words:
                    continue
                hashes, end = shingle_hashes(w.hash), w.first[1:][span_any(w.first, len(w.hash))]
                place = np.arange(len(hashes))
                cells = hashes >> np.uint64(64 - bits)
                held.append(cells[place + SHINGLE <= end])
                size += len(held[-1])
                inside = np.zeros(len(hashes) + 1, np.int64)
                for base in range(0, len(hashes) - span + 1, _PIECE):
                    r = repeats(hashes[base : base + _PIECE + span - 1], span)[0]
                    s = np.flatnonzero((r > 1) & (r <= most) & (place[base : base + len(r)] + words <= end[base : base + len(r)])) + base
                    np.add.at(inside, s, 1)
                    np.add.at(inside, s + span, -1)
                again.append(cells[np.cumsum(inside)[:-1] > 0])
                if size > 4_000_000:
                    yield made()
                    held, again, size = [], [], 0
        if size:
            yield made()

    def write(rows: pa.Table) -> pa.Table:
        part = rows.column("part")[0].as_py()
        n = np.zeros(1 << (bits - _PARTS), np.uint8)
        twice = np.zeros(1 << (_COARSE - _PARTS), np.uint8)
        for k in range(rows.num_rows):
            at, again = (_unpacked(rows.column(c)[k].as_py()) for c in ("cells", "twice"))
            more = np.frombuffer(rows.column("n")[k].as_py(), np.uint8)
            n[at] = np.minimum(n[at].astype(np.uint16) + more, 255)
            twice[again >> np.uint32(bits - _COARSE)] = 128
        level = np.log2(np.maximum(n.reshape(len(twice), -1).max(axis=1), 1)).astype(np.uint8)
        for name, values in (("bits", np.packbits(n > 1, bitorder="little")), ("levels", level | twice)):
            with new_file(f"{known.path}/{part:03d}.{name}") as out:
                out.write(values.tobytes())
        return pa.table({"part": pa.array([part], pa.int32())})

    made = checkpointed(source.select("text").mapInArrow(run, "part int, cells binary, n binary, twice binary").groupBy("part").applyInArrow(write, "part int"))
    known.held = frozenset(r.part for r in made.collect())
    return known


def _windows(docs: DataFrame, words: int, threshold: float) -> DataFrame:
    span = words - SHINGLE + 1
    known = docs.sparkSession.sparkContext.broadcast(_census(docs, words, threshold))
    # the lowest shingles of a passage of which the other must hold one: if both have one repeat at most, and in any case
    short = max(a - _least(a + b, threshold) + 1 for a in (span - 1, span) for b in (span - 1, span))
    long = np.array([a - math.ceil(threshold * a - 1e-9) + 1 for a in range(span, -1, -1)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_cache(None)
        census = known.value
        for batch in batches:
            doc, mark = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, offsets = text_buffer(batch.column(2))
            for lo, hi in row_slices(offsets, 1 << 20):
                w = Words(data, offsets[lo : hi + 1], lower=True)
                if len(w.hash) < words:
                    continue
                hashes, of = shingle_hashes(w.hash), span_any(w.first, len(w.hash))
                begin = w.first[:-1]
                # starts of passages that end inside their text
                fits = np.arange(len(hashes)) + words <= w.first[1:][of]
                out = [[], [], [], []]
                for base in range(0, len(hashes) - span + 1, _PIECE):
                    part = hashes[base : base + _PIECE + span - 1]
                    shared, level = census.look(part)
                    rank = (part >> np.uint64(5)) | (np.where(shared, (level & 31) + 1, 0).astype(np.uint64) << np.uint64(59))
                    again, same, back = repeats(part, span)
                    same[begin[(begin >= base) & (begin < base + len(same))] - base] = False
                    fit = fits[base : base + len(again)] & ~same & ~sliding_minimum(~shared, span)
                    high = np.where(fit, long[again] + again, 0)  # a repeat below counts twice
                    low = np.where(fit & (again < 2), short + again, high)
                    for place, first, last in prefix_runs(rank, low, high, level > 127, span, shared, back):
                        t = of[first + base]
                        out[0].append(part[place])
                        out[1].append(doc[lo + t])
                        out[2].append((mark[lo + t] << 32) + first + base - begin[t])
                        out[3].append(((last - first) << 16) + (place - first))
                if out[0]:
                    key, d, at, seg = (np.concatenate(x) for x in out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(d), pa.array(at), pa.array(seg)],
                        ["key", "doc", "at", "seg"],
                    )

    return docs.mapInArrow(run, "key bigint, doc bigint, at bigint, seg bigint")


def _least(sizes: int, threshold: float) -> int:
    """Least number of common shingles of two passages of `sizes` shingles together."""
    return math.ceil(threshold / (1 + threshold) * sizes - 1e-9)


def _links(words: int):
    """Rows sorted by (key, doc, at) -> links of each row to the first (earliest) and to
    the previous row of its key: x (the later passage), y, shift and starts lo..hi of x.
    Keys of up to three rows are done with that; all rows of the others come out too
    (ym below 0: -1 - place; y: the key; shift: 1 from a key's fourth row on)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, head = None, None  # last row of the batch before; first row of its key
        few, crowded = None, False  # rows of that key that did not come out yet; whether it has over three
        for batch in batches:
            rows = [batch.column(k).to_numpy() for k in range(4)]
            if not len(rows[0]):
                continue
            held = [np.r_[f, r] for f, r in zip(few, rows, strict=True)] if few is not None else rows
            at = np.flatnonzero(np.r_[True, held[0][1:] != held[0][:-1]])
            size = np.diff(np.r_[at, len(held[0])])
            many = size > 3
            goes_on = crowded and held[0][0] == carry[0][0]
            many[0] |= goes_on
            late = np.arange(len(held[0])) - np.repeat(at, size) > 2
            late[: size[0]] |= goes_on
            crowded = bool(many[-1])
            few = None if crowded else [c[at[-1] :] for c in held]
            many = np.repeat(many, size)
            if many.any():
                key, d, a, g, late = (c[many] for c in [*held, late])
                s = a & 0xFFFFFFFF
                out = [d, a >> 32, key, -1 - (s + (g & 0xFFFF)), late.astype(np.int64), s, s + (g >> 16)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], _LINK)
            if carry is not None:
                rows = [np.r_[c, r] for c, r in zip(carry, rows, strict=True)]
            key = rows[0]
            n = len(key)
            first = np.r_[True, key[1:] != key[:-1]]
            start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
            # row n stands for the first row of a key that began in an earlier batch
            table = [np.r_[r, h] for r, h in zip(rows, head if head is not None else [r[:1] for r in rows], strict=True)]
            old = n if head is not None and head[0][0] == key[0] else 0
            start[start == 0] = old
            me = np.arange(1 if carry is not None else 0, n)
            me = me[~first[me]]
            sides = [np.r_[me, me[me - 1 != start[me]]], np.r_[start[me], me[me - 1 != start[me]] - 1]]
            x, y = ([c[s] for c in table] for s in sides)
            xs, ys = x[2] & 0xFFFFFFFF, y[2] & 0xFFFFFFFF
            shift = (xs + (x[3] & 0xFFFF)) - (ys + (y[3] & 0xFFFF))
            lo = np.maximum(xs, ys + shift)
            length = [c >> 16 for c in (x[3], y[3])]
            hi = np.minimum(xs + length[0], ys + length[1] + shift)
            same = (x[1] == y[1]) & ((x[2] >> 32) == (y[2] >> 32))
            good = (lo <= hi) & ~(same & (np.abs(shift) < words))
            swap = np.where(same, shift < 0, (x[1] < y[1]) | ((x[1] == y[1]) & (x[2] < y[2])))
            sides = [(x[1], y[1]), (x[2] >> 32, y[2] >> 32), (y[1], x[1]), (y[2] >> 32, x[2] >> 32), (shift, -shift), (lo, lo - shift), (hi, hi - shift)]
            out = [np.where(swap, b, a) for a, b in sides]
            yield pa.RecordBatch.from_arrays([pa.array(c[good]) for c in out], _LINK)
            head = [c[start[n - 1] : start[n - 1] + 1] for c in table]
            carry = [c[n - 1 : n] for c in rows]

    return run


_LINK = ["x", "xm", "y", "ym", "shift", "lo", "hi"]
_LINK_SCHEMA = ", ".join(f"{c} bigint" for c in _LINK)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted links -> maximal runs lo..hi of starts for each (x, y, shift)."""
    held = None
    for batch in batches:
        rows = np.stack([c.to_numpy() for c in batch.columns], axis=1)
        if held is not None:
            rows = np.r_[held, rows]
        if not len(rows):
            continue
        group = np.r_[True, (rows[1:, :5] != rows[:-1, :5]).any(axis=1)]
        number = np.cumsum(group)
        # a running maximum of hi within each group: keep groups apart by a large step
        reach = np.maximum.accumulate(rows[:, 6] + (number << 40)) - (number << 40)
        new = group | np.r_[True, rows[1:, 5] > reach[:-1] + 1]
        at = np.flatnonzero(new)
        out = rows[at]
        out[:, 6] = reach[np.r_[at[1:] - 1, len(rows) - 1]]
        held = out[-1:]
        yield pa.RecordBatch.from_arrays([pa.array(out[:-1, k]) for k in range(7)], _LINK)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array(held[:, k]) for k in range(7)], _LINK)


def _bundles(key: int, fill: int):
    """Rows sorted by columns key, key + 1 -> (doc, mark, rows): about `fill` bytes of rows in
    one value, so that a text is sent once for many rows and no group is gathered whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, owner, size = [], None, 0

        def made():
            sink = pa.BufferOutputStream()
            table = pa.Table.from_batches(held).combine_chunks()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            return [owner[0]], [owner[1]], [sink.getvalue().to_pybytes()]

        for batch in batches:
            if not batch.num_rows:
                continue
            batch = pa.RecordBatch.from_arrays(batch.columns, batch.schema.names)
            a, b = batch.column(key).to_numpy(), batch.column(key + 1).to_numpy()
            cuts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]).tolist() + [len(a)]
            out = [], [], []
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                mine = (int(a[lo]), int(b[lo]))
                for at in range(lo, hi, 1024):
                    part = batch.slice(at, min(1024, hi - at))
                    if owner is not None and (mine != owner or size > fill):
                        for o, v in zip(out, made(), strict=True):
                            o.extend(v)
                        held, size = [], 0
                    owner = mine
                    held.append(part)
                    size += part.nbytes
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], ["doc", "mark", "rows"])
        if held:
            v = made()
            yield pa.RecordBatch.from_arrays([pa.array(v[0], pa.int64()), pa.array(v[1], pa.int64()), pa.array(v[2], pa.binary())], ["doc", "mark", "rows"])

    return run


_BUNDLE = "doc bigint, mark bigint, rows binary"


#: Rows of one text that are dealt to one task; only texts of more rows are sent, and cut into words, more than once.
_SHARE = 2048


def _bundled(rows: DataFrame, doc: str, mark: str, fill: int, counted: DataFrame | None = None) -> DataFrame:
    """`counted`: a stored table with as many rows of each text as `rows` (None: rows itself)."""
    columns = rows.columns
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = (rows if counted is None else counted).groupBy(doc, mark).agg(F.count("*").alias("n")).where(F.col("n") > _SHARE)
    many = many.select(doc, mark, F.ceil(F.col("n") / _SHARE).alias("shares"))
    rows = rows.join(F.broadcast(many), [doc, mark], "left")  # few: one for _SHARE rows at most
    share = F.pmod(F.xxhash64("x", "y", "lo"), F.coalesce(F.col("shares"), F.lit(1)))
    rows = rows.repartition(parts, doc, mark, share).select(*columns).sortWithinPartitions(doc, mark)
    return rows.mapInArrow(_bundles(columns.index(doc), fill), _BUNDLE)


def _last_like(hashes: np.ndarray, span: int) -> np.ndarray:
    """For each start the last one after it up to which all have the same set of shingles."""
    n, m = len(hashes), len(hashes) - span + 1
    order = np.argsort(hashes, kind="stable")
    equal = hashes[order[1:]] == hashes[order[:-1]]
    ahead, back = np.full(n, span + 1), np.full(n, span + 1)  # how far the next and the previous one of the same shingle are
    ahead[order[:-1][equal]] = back[order[1:][equal]] = np.diff(order)[equal]
    differs = np.flatnonzero(~((ahead[: m - 1] <= span) & (back[span : span + m - 1] <= span))) + 1
    return np.r_[differs, m][np.searchsorted(differs, np.arange(m), "right")] - 1


def _text_shingles(batch: pa.RecordBatch) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """For each row (doc, mark, rows, text): the bundled rows and the text's shingle hashes."""
    data, offsets = text_buffer(batch.column(3))
    for lo, hi in row_slices(offsets, 1 << 20):
        w = Words(data, offsets[lo : hi + 1], lower=True)
        hashes = shingle_hashes(w.hash)
        for k in range(lo, hi):
            begin, end = int(w.first[k - lo]), int(w.first[k - lo + 1])
            rows = pa.ipc.open_stream(batch.column(2)[k].as_buffer()).read_all()
            yield rows, hashes[begin : max(end - SHINGLE + 1, begin)]


def _gathered(batches: Iterator[pa.RecordBatch], fill: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `fill` bytes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size > fill:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _snippets(span: int):
    """Bundles of y with its text -> the links, with the hashes of y's shingles lo - shift .. hi - shift + span."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, hashes in _text_shingles(batch):
                shift, lo, hi = (rows.column(c).to_numpy() for c in ("shift", "lo", "hi"))
                own = [hashes[a - s : b - s + span].tobytes() for s, a, b in zip(shift, lo, hi, strict=True)]
                columns = [rows.column(c).combine_chunks() for c in _LINK]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(own, pa.binary())], [*_LINK, "own"])

    return lambda batches: _gathered(made(batches))


def similar_starts(a: np.ndarray, b: np.ndarray, span: int, threshold: float) -> np.ndarray:
    """For arrays of n + span - 1 shingles: Jaccard similarity of the sets of the
    n aligned subsequences of `span` shingles (0 where it is below the threshold)."""
    n = len(a) - span + 1
    if np.array_equal(a, b):
        return np.ones(n)
    out = np.zeros(n)
    order = np.argsort(b)
    if n > 3 and len(np.unique(a)) == len(a) and (np.diff(b[order].view(np.int64)) != 0).all():
        # each pair of equal shingles counts for the starts whose subsequences hold both
        at = np.minimum(np.searchsorted(b[order], a), len(b) - 1)
        i = np.flatnonzero(b[order][at] == a)
        j = order[at[i]]
        first, last = np.maximum(np.maximum(i, j) - span + 1, 0), np.minimum(np.minimum(i, j), n - 1)
        real = first <= last
        step = np.bincount(first[real], minlength=n + 1) - np.bincount(last[real] + 1, minlength=n + 1)
        both = np.cumsum(step)[:n]
        out = both / (2 * span - both)
    else:
        # sets that slide: how often each shingle stands in the two subsequences
        left, right, common = Counter(a[: span - 1].tolist()), Counter(b[: span - 1].tolist()), 0
        common = sum(x in right for x in left)
        for k, (u, v) in enumerate(zip(a[span - 1 :].tolist(), b[span - 1 :].tolist(), strict=True)):
            left[u] += 1
            common += left[u] == 1 and u in right
            right[v] += 1
            common += right[v] == 1 and v in left
            out[k] = common / (len(left) + len(right) - common)
            for mine, other, x in ((left, right, int(a[k])), (right, left, int(b[k]))):
                mine[x] -= 1
                if not mine[x]:
                    del mine[x]
                    common -= x in other
    return np.where(out >= threshold, out, 0.0)


_FOUND = ["doc", "mark", "start", "end", "other", "other_start", "similarity"]
_FOUND_SCHEMA = ", ".join(f"{c} bigint" for c in _FOUND[:-1]) + ", similarity double"


def _verify(words: int, threshold: float):
    """Bundles of x with its text -> verified spans of words start..end of x."""
    span = words - SHINGLE + 1

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, hashes in _text_shingles(batch):
                out, last_like = [], None
                for x, xm, y, _ym, shift, lo, hi, own in zip(*(rows.column(c).to_pylist() for c in [*_LINK, "own"]), strict=True):
                    level = similar_starts(hashes[lo : hi + span], np.frombuffer(own, np.uint64), span, threshold)
                    good = np.flatnonzero(level)
                    if not len(good):
                        continue
                    heads = np.flatnonzero(np.r_[True, np.diff(good) > words])
                    for s, e in zip(heads, [*heads[1:], len(good)], strict=True):
                        a, b = lo + int(good[s]), lo + int(good[e - 1]) + words
                        out.append((x, xm, a, b, y, a - shift, float(level[good[s:e]].min())))
                    if good[-1] == hi - lo:
                        last_like = _last_like(hashes, span) if last_like is None else last_like
                        if (last := int(last_like[hi])) > hi:
                            out.append((x, xm, hi, last + words, y, hi - shift, float(level[-1])))
                if out:
                    kinds = [pa.int64()] * 6 + [pa.float64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], _FOUND)

    return lambda batches: _gathered(made(batches))


def _contents(span: int):
    """Bundles of x with its text -> the rows, with the upper halves of the hashes of x's
    shingles lo .. hi + span and the last start like hi."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, hashes in _text_shingles(batch):
                lo, hi = rows.column("lo").to_numpy(), rows.column("hi").to_numpy()
                halves = (hashes >> np.uint64(32)).astype(np.uint32)
                own = [halves[a : b + span].tobytes() for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
                columns = [rows.column(c).combine_chunks() for c in _LINK]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(own, pa.binary()), pa.array(_last_like(hashes, span)[hi])], [*_LINK, "own", "reach"])

    return lambda batches: _gathered(made(batches))


#: Up to so many holders are compared without a look at what they have in common with each passage.
_FEW = 8


def _sliding_sum(marks: np.ndarray, span: int) -> np.ndarray:
    """Sums of each `span` consecutive columns."""
    total = np.zeros((marks.shape[0], marks.shape[1] + 1), np.int32)
    np.cumsum(marks, axis=1, out=total[:, 1:])
    return total[:, span:] - total[:, :-span]


def _again(shingles: np.ndarray, span: int) -> np.ndarray:
    """Whether each shingle stands among the `span` - 1 before it too."""
    order = np.argsort(shingles, kind="stable")
    out = np.zeros(len(shingles), bool)
    out[order[1:]] = (shingles[order[1:]] == shingles[order[:-1]]) & (np.diff(order) < span)
    return out


def _meet(rows: pa.Table, words: int, threshold: float) -> list[tuple]:
    """Rows of one key (side 1: not yet covered; side 0: holders) -> spans of those of
    side 1 that an earlier holder has; holders are tried until all starts are covered."""
    span = words - SHINGLE + 1
    side, x, xm, place, lo, hi, reach = (rows.column(c).to_numpy() for c in ("side", "x", "xm", "ym", "lo", "hi", "reach"))
    own = [np.frombuffer(v, np.uint32).astype(np.uint64) for v in rows.column("own").to_pylist()]
    sets = [np.unique(v) for v in own]
    # a passage lacks at most as many of its row's shingles as there are other starts
    fewest = np.maximum([len(v) for v in sets] - (hi - lo), 1)
    holders = np.flatnonzero(side == 0)
    if not len(holders):
        return []
    posted = np.concatenate([sets[h] for h in holders])
    of = np.repeat(np.arange(len(holders)), [len(sets[h]) for h in holders])
    order = np.argsort(posted, kind="stable")
    posted, of = posted[order], of[order]
    out = []
    for u in np.flatnonzero(side == 1).tolist():
        left, right = np.searchsorted(posted, sets[u], "left"), np.searchsorted(posted, sets[u], "right")
        times = right - left
        at = np.repeat(left - np.cumsum(times) + times, times) + np.arange(times.sum())
        common = np.bincount(of[at], minlength=len(holders))
        need = np.ceil(threshold / (1 + threshold) * (fewest[u] + fewest[holders]) - 1e-9)
        shift = place[u] - place[holders]
        same = (x[holders] == x[u]) & (xm[holders] == xm[u])
        earlier = np.where(same, shift >= words, (x[holders] < x[u]) | ((x[holders] == x[u]) & (xm[holders] < xm[u])))
        begin, end = np.maximum(lo[u], lo[holders] + shift), np.minimum(hi[u], hi[holders] + shift)
        fit = np.flatnonzero((common >= need) & earlier & (begin <= end))
        bare = np.ones(int(hi[u] - lo[u]) + 1, bool)
        if not len(fit):
            continue
        fit = fit[np.argsort(-common[fit], kind="stable")]
        start = np.arange(lo[u], hi[u] + 1)
        likely = (start >= begin[fit][:, None]) & (start <= end[fit][:, None])
        if len(fit) > _FEW:
            # a passage has no more in common with a holder's than it has places whose shingle the holder has at all
            holds = np.zeros((len(holders), len(sets[u])), bool)
            holds[of[at], np.repeat(np.arange(len(times)), times)] = True
            most = _sliding_sum(holds[fit][:, np.searchsorted(sets[u], own[u])], span)
            size = span - _sliding_sum(_again(own[u], span)[None], span)  # distinct shingles of each passage, at least
            other = fewest[holders[fit]][:, None]
            likely &= most >= np.maximum(threshold * np.maximum(size, other), threshold / (1 + threshold) * (size + other)) - 1e-9
        to_do = np.flatnonzero(likely.any(axis=1))
        while len(to_do):
            row, to_do = int(to_do[0]), to_do[1:]
            k = fit[row]
            h, a, b, d = holders[k], int(begin[k]), int(end[k]), int(shift[k])
            level = similar_starts(own[u][a - lo[u] : b - lo[u] + span], own[h][a - d - lo[h] : b - d - lo[h] + span], span, threshold)
            good = level > 0
            if not (good & bare[a - lo[u] : b - lo[u] + 1]).any():
                continue
            edge = np.diff(np.r_[0, good.astype(np.int8), 0])
            for i, j in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
                out.append((x[u], xm[u], a + i, a + j - 1 + words, x[h], a + i - d, float(level[i:j].min())))
            if good[-1] and b == hi[u] and reach[u] > b:
                out.append((x[u], xm[u], b, int(reach[u]) + words, x[h], b - d, float(level[-1])))
            bare[a - lo[u] : b - lo[u] + 1] &= ~good
            to_do = to_do[(likely[to_do] & bare).any(axis=1)]
    return out


def _met(words: int, threshold: float):
    """Rows sorted by (y, a, b): each such block of a key's rows -> its spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, mine = [], None

        def made():
            out = _meet(pa.Table.from_batches(held), words, threshold)
            kinds = [pa.int64()] * 6 + [pa.float64()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], _FOUND)

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(batch.schema.names.index(c)).to_numpy() for c in ("y", "a", "b")], axis=1)
            cuts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)]).tolist() + [len(key)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if mine is not None and tuple(key[lo]) != mine:
                    yield from made()
                    held = []
                mine = tuple(key[lo])
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield from made()

    return run


#: Rows on a side of a block in which rows of one key meet.
_SIDE = 1024


def _others(crowded: DataFrame, found: DataFrame, texts: Callable, words: int, threshold: float) -> DataFrame:
    """The exact way for keys of more than three rows: every row that no span of `found`
    covers meets all holders of its key, equal contents once.  Blocks of one side meet
    blocks of the other, so that no key is gathered whole."""
    span = words - SHINGLE + 1
    parts = int(crowded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spans = found.groupBy(F.col("doc").alias("x"), F.col("mark").alias("xm")).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    covered = F.expr(f"coalesce(exists(spans, s -> s.start <= lo AND s.end >= hi + {words}), false)")
    rows = crowded.join(spans, ["x", "xm"], "left").withColumn("shift", F.when(covered, 0).otherwise(F.col("shift")))
    rows = rows.select("x", "xm", "y", (-1 - F.col("ym")).alias("ym"), "shift", "lo", "hi")
    rows = checkpointed(rows.join(rows.where("shift = 1").select("y").distinct(), "y").select(*_LINK))
    with_text = texts(rows.select(F.col("x").alias("doc"), F.col("xm").alias("mark")))
    rows = with_text(_bundled(rows, "x", "xm", 1 << 20)).mapInArrow(_contents(span), _LINK_SCHEMA + ", own binary, reach bigint")
    same = Window.partitionBy("y", F.col("lo") - F.col("ym"), "own").orderBy("x", "xm", "lo")
    rows = rows.withColumn("lead", F.first(F.struct("x", "xm", "lo")).over(same)).withColumn("no", F.row_number().over(same))
    itself = (F.col("lead.x") == F.col("x")) & (F.col("lead.xm") == F.col("xm")) & (F.col("lo") - F.col("lead.lo") < words)
    rows = checkpointed(rows.withColumn("own_lead", itself))
    copies = rows.where("shift = 1 AND NOT own_lead").select(
        F.col("x").alias("doc"), F.col("xm").alias("mark"), F.col("lo").alias("start"), (F.col("reach") + words).alias("end"),
        F.col("lead.x").alias("other"), F.col("lead.lo").alias("other_start"), F.lit(1.0).alias("similarity"),
    )
    leads = rows.where("own_lead").drop("lead", "no", "own_lead")
    sizes = leads.groupBy("y").agg(F.count("*").alias("n"), F.max("shift").alias("some")).where("n > 1 AND some = 1")
    leads = leads.join(sizes.select("y", F.ceil(F.col("n") / _SIDE).alias("blocks")), "y")
    mine, every = F.pmod(F.xxhash64("x", "xm", "ym", "lo"), F.col("blocks")), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    sides = leads.where("shift = 1").withColumn("a", mine).withColumn("b", every).withColumn("side", F.lit(1)).unionByName(
        leads.withColumn("b", mine).withColumn("a", every).withColumn("side", F.lit(0))
    )
    met = sides.repartition(parts, "y", "a", "b").sortWithinPartitions("y", "a", "b").mapInArrow(_met(words, threshold), _FOUND_SCHEMA)
    return copies.union(met)


def _found(source: DataFrame, words: int, threshold: float) -> DataFrame:
    spark = source.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    span = words - SHINGLE + 1
    links = (
        _windows(source, words, threshold).repartition(parts, "key").sortWithinPartitions("key", "doc", "at", "seg")
        .mapInArrow(_links(words), _LINK_SCHEMA)
    )
    runs = checkpointed(
        links.repartition(parts, "x", "xm", "y", "ym", "shift").sortWithinPartitions(*_LINK).mapInArrow(_merge, _LINK_SCHEMA)
    )

    def texts(ids: DataFrame) -> Callable[[DataFrame], DataFrame]:
        """Joins bundles with the texts of `ids` (doc, mark); those alone are shuffled where a broadcast can tell."""
        ids = checkpointed(ids.distinct())
        some = source.join(F.broadcast(ids), ["doc", "mark"], "left_semi") if ids.count() <= MAX_BROADCAST else source
        some = some.groupBy("doc", "mark").agg(F.first("text").alias("text"))  # equal rows are one text
        return lambda bundles: bundles.join(some, ["doc", "mark"]).select("doc", "mark", "rows", "text")

    pairs = runs.where("ym >= 0")
    with_text = texts(pairs.select(F.col("x").alias("doc"), F.col("xm").alias("mark")).union(pairs.select("y", "ym")))
    snippets = with_text(_bundled(pairs, "y", "ym", 1 << 20)).mapInArrow(_snippets(span), _LINK_SCHEMA + ", own binary")
    found = checkpointed(with_text(_bundled(snippets, "x", "xm", 4 << 20, pairs)).mapInArrow(_verify(words, threshold), _FOUND_SCHEMA))
    return found.union(_others(runs.where("ym < 0"), found, texts, words, threshold))


def repeated_passages(docs: DataFrame, words: int = 50, threshold: float = 0.8) -> DataFrame:
    """Passages of `words` words or more that are near-duplicates of an earlier one.

    One row for each verified span: doc_id, start_word, end_word (exclusive),
    other_doc_id, other_start_word, similarity.  "Earlier" is the order of
    (doc_id, text digest, place), so other_doc_id <= doc_id, and the earliest
    holder of a passage is never listed for it.  Every passage of exactly
    `words` words inside a span has a Jaccard similarity of `threshold` or more
    on its sets of five-word shingles with the aligned passage of the other text
    (`similarity`: the least of them); spans that start where good passages lie
    closer than a passage's length are joined.  In a span over text that repeats
    itself all passages hold the set of shingles of its first one.

    Passages meet if they hold the least of their common shingles at the same
    place.  A passage is compared with the first and the previous holder of each
    of its least shingles; a shingle of more than three holders brings every passage
    that is not covered by then to all its holders, until one covers it.  So each
    passage with such an earlier partner is in a span of one of its partners; not
    all of them are listed, and no group of copies is paired out.

    Words are `[^\\x20\\x09-\\x0D]+` after A-Z folding.  Null ids sort first and
    are returned as null; null, empty and shorter texts have no passages; texts
    with the same id are kept apart by a digest, equal rows are one text; an
    empty table gives no rows.
    """
    rows = _found(_source(docs), words, threshold)
    name = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return rows.select(
        name("doc").alias("doc_id"), F.col("start").alias("start_word"), F.col("end").alias("end_word"),
        name("other").alias("other_doc_id"), F.col("other_start").alias("other_start_word"), "similarity",
    )


def cut_text(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the white space after them."""
    raw = text.encode()
    w = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), lower=True)
    keep = np.ones(len(raw), bool)
    n = len(w.start)
    for a, b in spans:
        keep[w.start[a] : w.start[b] if b < n else len(raw)] = False
    return np.frombuffer(raw, np.uint8)[keep].tobytes().decode()


def without_repeats(docs: DataFrame, words: int = 50, threshold: float = 0.8) -> DataFrame:
    """docs with every passage of `repeated_passages` cut out of its text; the
    earliest holder keeps it.  A text that has no word left is dropped; n_chars,
    where present, is set anew for cut texts; all else stays as it is."""
    source = _source(docs)
    spans = _found(source, words, threshold).groupBy("doc", "mark").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("__spans"))
    spans = checkpointed(spans.withColumnRenamed("doc", "__doc").withColumnRenamed("mark", "__mark"))
    marked = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("__doc"),
        F.expr("cast(xxhash64(text, doc_id) & 2147483647 as bigint)").alias("__mark"),
    ).join(spans, ["__doc", "__mark"], "left")
    at = docs.columns.index("text")
    source_columns = [F.col(f"`{c}`") for c in docs.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = batch.column(len(docs_names))
            texts = batch.column(at).to_pylist()
            keep = np.ones(len(texts), bool)
            for k in np.flatnonzero(given.is_valid().to_numpy(zero_copy_only=False)):
                texts[k] = cut_text(texts[k], [(s["start"], s["end"]) for s in given[k].as_py()])
                keep[k] = bool(texts[k].encode().split())
            columns = list(batch.columns[: len(docs_names)])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, docs_names).filter(pa.array(keep))

    docs_names = docs.columns
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    out = marked.select(*source_columns, "__spans").mapInArrow(run, schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(dict(docs.dtypes)["n_chars"])))
    return out
