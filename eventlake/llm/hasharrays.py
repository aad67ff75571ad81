"""Counts of hashed n-grams: pre-aggregated in each task, merged by key range,
and stored as sorted arrays in the shared folder, where tasks map them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from eventlake.llm.common import checkpointed
from eventlake.llm.files import array, new_file

_PACKED = "tbl int, part int, keys binary, counts binary"
_SHARD = "tbl int, part int, name string, rows bigint, total bigint"


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts (a row of counts for each kind)."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[heads], np.add.reduceat(counts, heads, axis=0, dtype=np.int64)


class _Held:
    """Keys of one table not yet sent, kept distinct when they grow."""

    def __init__(self, kinds: int):
        self.kinds = kinds
        self.clear()

    def clear(self) -> None:
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        keys, counts = merged(np.concatenate(self.keys), np.concatenate(self.counts))
        self.clear()
        return keys, counts.astype(np.uint32) if counts.max(initial=0) < 1 << 32 else counts


def store(
    rows: DataFrame, grams: Callable[[pa.RecordBatch], Iterator[tuple[int, np.ndarray, np.ndarray]]], path: str,
    tables: int, kinds: int = 1, parts: int | None = None, hold: int = 400_000,
) -> HashArrays:
    """Count what `grams(batch)` yields: (table, distinct uint64 keys, counts of
    shape (n, kinds)).  Keys must be spread evenly over 64 bits (hashes).

    A task sums up to `hold` keys of a table before it sends them, cut by key
    range into `parts` (default: four times the shuffle partitions) packed rows;
    a part is merged by one task and written as sorted arrays, so no key and no
    group is gathered beyond its range.  The manifest has a row for each part.
    """
    spark = rows.sparkSession
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = np.array([-(-(k << 64) // parts) for k in range(1, parts)], np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [_Held(kinds) for _ in range(tables)]

        def sent(t: int) -> pa.RecordBatch:
            keys, counts = held[t].take()
            cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
            full = [k for k in range(parts) if cuts[k] < cuts[k + 1]]
            if counts.dtype != np.uint32:
                raise OverflowError("one task has counted a key 2^32 times: read the table in more partitions")
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([t] * len(full), pa.int32()), pa.array(full, pa.int32()),
                    pa.array([keys[cuts[k] : cuts[k + 1]].tobytes() for k in full], pa.binary()),
                    pa.array([counts[cuts[k] : cuts[k + 1]].tobytes() for k in full], pa.binary()),
                ],
                ["tbl", "part", "keys", "counts"],
            )

        for batch in batches:
            for t, keys, counts in grams(batch):
                held[t].add(keys, counts.astype(np.uint32))
                if held[t].size > 2 * hold:
                    held[t].add(*held[t].take())
                    if held[t].size > hold:
                        yield sent(t)
        for t in range(tables):
            if held[t].size:
                yield sent(t)

    def merge(group: pa.Table) -> pa.Table:
        t, part = group.column("tbl")[0].as_py(), group.column("part")[0].as_py()
        keys = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("keys")])
        counts = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32).reshape(-1, kinds) for x in group.column("counts")]).astype(np.int64)
        keys, counts = merged(keys, counts)
        name = f"{path}/{t}-{part:06d}"
        with new_file(f"{name}.keys") as out:
            out.write(keys.tobytes())
        with new_file(f"{name}.counts") as out:
            out.write(counts.astype(np.uint32 if counts.max(initial=0) < 1 << 32 else np.uint64).tobytes())
        return pa.table({
            "tbl": pa.array([t], pa.int32()), "part": pa.array([part], pa.int32()), "name": [name],
            "rows": pa.array([len(keys)], pa.int64()), "total": pa.array([int(counts.sum())], pa.int64()),
        })

    packed = rows.mapInArrow(count, _PACKED)
    manifest = checkpointed(packed.groupBy("tbl", "part").applyInArrow(merge, _SHARD)).collect()
    return HashArrays(path, parts, kinds, {(r.tbl, r.part): (r.rows, r.total) for r in manifest})


class HashArrays:
    """Tables of sorted keys and counts; files are mapped in a worker when first used."""

    def __init__(self, path: str, parts: int, kinds: int, manifest: dict[tuple[int, int], tuple[int, int]]):
        self.path, self.parts, self.kinds, self.manifest = path, parts, kinds, manifest
        self.open: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def __getstate__(self):
        return self.__dict__ | {"open": {}}

    def rows(self, table: int) -> int:
        return sum(n for (t, _), (n, _) in self.manifest.items() if t == table)

    def shard(self, table: int, part: int) -> tuple[np.ndarray, np.ndarray]:
        at = (table, part)
        if at not in self.open:
            rows = self.manifest[at][0]
            name = f"{self.path}/{table}-{part:06d}"
            keys = array(f"{name}.keys", np.uint64)
            raw = array(f"{name}.counts", np.uint8)
            self.open[at] = keys, raw.view(np.uint32 if len(raw) == 4 * rows * self.kinds else np.uint64).reshape(rows, self.kinds)
        return self.open[at]

    def get(self, table: int, keys: np.ndarray) -> np.ndarray:
        """Counts (n, kinds) of keys; 0 for those that are not held.  Keys are looked up in
        sorted order, each once, so that neighbours share pages."""
        distinct, back = np.unique(keys, return_inverse=True)
        out = np.zeros((len(distinct), self.kinds), np.int64)
        edges = np.array([-(-(k << 64) // self.parts) for k in range(1, self.parts)], np.uint64)
        cuts = [0, *np.searchsorted(distinct, edges).tolist(), len(distinct)]
        for part in range(self.parts):
            a, b = cuts[part], cuts[part + 1]
            if a == b or (table, part) not in self.manifest:
                continue
            own, counts = self.shard(table, part)
            at = np.minimum(np.searchsorted(own, distinct[a:b]), len(own) - 1)
            hit = own[at] == distinct[a:b]
            out[a:b][hit] = counts[at[hit]]
        return out[back]
