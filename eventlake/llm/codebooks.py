"""Vector code compression: product codes whose codebooks are learned by ball k-means.

A vector of integers floor(scale * x) is cut into equal consecutive parts; each part
position has a codebook of at most 256 entries, and a code is the entry's index for each
part.  An assignment round knows the entry of every part from the round before, the centre of
the part's ball:

* Two entries are neighbours if half their distance is not above the ball's radius (the largest
  distance of a member in the block at hand): no other entry can take a member.
* A member nearer to its centre than half of the way to the nearest neighbour lies in the stable
  core and keeps its entry without another distance.
* The other members lie in rings: one at distance s from its centre compares only entries
  at most 2s from that centre.

All tests are made on squared integers, so the result is that of a full search, ties to the lower
index included: d(c, e) > 2 d(x, c) gives d(x, e) >= d(c, e) - d(x, c) > d(x, c).

Spark's part: each round is one narrow pass over the vectors; only sums for each entry and task are
shuffled, and the driver sees nothing but codebooks (entries x dimensions).  Vectors with their
entries are persisted from one round to the next and freed after it; a lost executor's share is
computed again from the source, since nothing else is shuffled.

Null vectors and vectors that hold null or non-finite components take no part.  Repeated rows each
count.  Rows without an id take part but do not start a codebook (ids ascending, then the
vector).  Fewer vectors than entries give smaller codebooks, an empty table no rows.  Vectors of
different lengths, or of a length that the parts do not divide, raise ValueError, as do components
so large that squares leave 64 bits.  Other columns of the table are not returned.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import checkpointed

#: Float sums of products below this are exact.
_EXACT = 1 << 53


def prepare(table: DataFrame, vector: str = "embedding", scale: int = 1024, row_id: str = "vec_id", label: str = "label") -> DataFrame:
    """Rows (vec_id, label, v): integer vectors of the rows that take part."""
    x = F.col(f"`{vector}`").cast("array<double>")
    ok = F.forall(x, lambda y: F.coalesce(~F.isnan(y) & (F.abs(y) < float("inf")), F.lit(False)))
    return table.where(F.coalesce(ok, F.lit(False))).select(
        F.col(f"`{row_id}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"),
        F.transform(x, lambda y: F.floor(y * scale).cast("int")).alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(rows) != width * len(column) or (len(column) and pc.min_max(pc.list_value_length(column)).as_py() != {"min": width, "max": width}):
        raise ValueError(f"vectors must all have {width} components")
    return rows.reshape(len(column), width)


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows: as float products where these are exact."""
    top = int(max(np.abs(x).max(initial=0), np.abs(centres).max(initial=0)))
    bound = 4 * top * top * max(1, x.shape[1])
    if bound >= 1 << 62:
        raise ValueError("components are too large for 64-bit squared distances")
    kind = np.float64 if bound < _EXACT else np.int64
    x, centres = x.astype(kind), centres.astype(kind)
    out = (x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2 * (x @ centres.T)
    return out.astype(np.int64)


class Balls:
    """Entries of one part position, with each entry's others by distance."""

    def __init__(self, centres: np.ndarray):
        self.centres = centres
        gaps = distances(centres, centres)
        self.order = np.argsort(gaps, 1, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.order, 1)
        self.work = 0  # distances computed

    def full(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of every row, compared with all entries."""
        d = distances(x, self.centres)
        self.work += d.size
        best = d.argmin(1)
        return best, d[np.arange(len(x)), best]

    def again(self, x: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of every row, given the entry whose ball it is in."""
        step = x - self.centres[entry]
        far = (step * step).sum(1)
        self.work += len(x)
        entry, out = entry.copy(), far.copy()
        place = np.argsort(entry, kind="stable")
        bounds = np.flatnonzero(np.diff(entry[place], prepend=-1, append=len(self.centres)))
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            members = place[lo:hi]
            ball = int(entry[members[0]])
            # how many entries lie within twice a member's distance, the centre's own first
            near = np.searchsorted(self.gaps[ball], 4 * far[members], "right")
            shell = np.frexp(near.astype(np.float64) - 0.5)[1]  # rings are taken together by powers of two
            for s in np.unique(shell[near > 1]):
                ring = members[(shell == s) & (near > 1)]
                among = np.sort(self.order[ball, : int(near[(shell == s) & (near > 1)].max())])
                d = distances(x[ring], self.centres[among])
                self.work += d.size
                best = d.argmin(1)
                entry[ring], out[ring] = among[best], d[np.arange(len(ring)), best]
        return entry, out


def _binary(codes: np.ndarray) -> pa.Array:
    n, width = codes.shape
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(codes, np.uint8))])


def _codes(column: pa.Array, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), parts).astype(np.int64)


def _assigner(books: np.ndarray, known: bool, errors: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A pass that gives every vector the entries of its parts (and their squared distances, summed)."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = [Balls(b) for b in books]
        for batch in batches:
            x = _matrix(batch.column("v"), parts * width)
            old = _codes(batch.column("code"), parts) if known else None
            new, total = np.zeros((len(x), parts), np.int64), np.zeros(len(x), np.int64)
            for p in range(parts):
                part = x[:, p * width : (p + 1) * width]
                new[:, p], d = balls[p].again(part, old[:, p]) if known else balls[p].full(part)
                total += d
            rest = pa.array(total) if errors else batch.column("v")
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), _binary(new), rest],
                                             ["vec_id", "label", "code", "error" if errors else "v"])

    return run


def _adder(parts: int, entries: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's sums: rows (cell, place, total) for each entry and component; place -1 counts members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = counts = None
        for batch in batches:
            if not len(batch):
                continue
            codes = _codes(batch.column("code"), parts)
            x = _matrix(batch.column("v"), len(batch.column("v")[0]))
            width = x.shape[1] // parts
            if sums is None:
                sums, counts = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
            for p in range(parts):
                place = np.argsort(codes[:, p], kind="stable")
                at = np.flatnonzero(np.diff(codes[place, p], prepend=-1))
                sums[p, codes[place[at], p]] += np.add.reduceat(x[place, p * width : (p + 1) * width], at, 0)
                counts[p] += np.bincount(codes[:, p], minlength=entries)
        if sums is not None:
            cell = np.flatnonzero(counts.ravel())
            width = sums.shape[2]
            total = np.concatenate([counts.ravel()[cell, None], sums.reshape(-1, width)[cell]], 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(cell, width + 1)), pa.array(np.tile(np.arange(-1, width), len(cell))), pa.array(total.ravel())],
                ["cell", "place", "total"])

    return run


def _moved(books: np.ndarray, state: DataFrame) -> np.ndarray:
    """Each entry at the floor of its members' mean; an entry without members stays."""
    parts, entries, width = books.shape
    rows = state.mapInArrow(_adder(parts, entries), "cell bigint, place bigint, total bigint")
    rows = rows.groupBy("cell", "place").agg(F.sum("total").alias("total")).toArrow()  # at most a codebook
    totals = np.zeros((parts * entries, width + 1), np.int64)
    totals[rows["cell"].to_numpy(), rows["place"].to_numpy() + 1] = rows["total"].to_numpy()
    used = totals[:, 0] > 0
    out = books.reshape(-1, width).copy()
    out[used] = totals[used, 1:] // totals[used, :1]
    return out.reshape(books.shape)


def first_books(rows: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """Codebooks made of the parts of the vectors of the smallest ids; None for an empty table."""
    head = rows.where("vec_id IS NOT NULL").orderBy("vec_id", "v").limit(entries).select("v").toArrow()["v"].to_pylist()
    if not head:
        return None
    if len({len(v) for v in head}) > 1 or len(head[0]) % parts:
        raise ValueError(f"vectors must have one length, a multiple of {parts}")
    return np.array(head, np.int64).reshape(len(head), parts, -1).transpose(1, 0, 2).copy()


def compress(rows: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> tuple[DataFrame, np.ndarray | None]:
    """Rows (vec_id, label, code binary, error long) of prepared vectors, and the final codebooks
    (part, entry, component)."""
    if not 0 < entries <= 256:
        raise ValueError("a code is one byte")
    label = rows.schema["label"].dataType.simpleString()
    spark = rows.sparkSession
    books = first_books(rows, parts, entries)
    result = f"vec_id bigint, label {label}, code binary, error bigint"
    if books is None:
        if rows.limit(1).count():
            raise ValueError("no vector has an id to start a codebook")
        return spark.createDataFrame([], result), None
    state, known = rows, False
    for _ in range(rounds):
        after = state.mapInArrow(_assigner(books, known, False), f"vec_id bigint, label {label}, code binary, v array<int>")
        after = after.persist(StorageLevel.MEMORY_AND_DISK)
        books = _moved(books, after)
        if known:
            state.unpersist()
        state, known = after, True
    out = checkpointed(state.mapInArrow(_assigner(books, known, True), result))
    if known:
        state.unpersist()
    return out, books


def books_digest(books: np.ndarray) -> str:
    """sha256 of all components in decimal, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame, salts: int = 16) -> DataFrame:
    """Adds `label_error`: the error summed over rows of an equal label (nulls together).

    Sums are combined map-side; a label held by a third of all rows is joined in salted copies."""
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).select(
        F.col("label").alias("__label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt"))
    rows = coded.withColumn("__place", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts)).cast("int"))
    same = rows["label"].eqNullSafe(sums["__label"]) & (rows["__place"] == sums["__salt"])
    return rows.join(sums, same).drop("__label", "__salt", "__place")


def oracle_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """The query in DuckDB SQL: every round compares all entries."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
    SELECT u, p, k, s FROM (SELECT x.u, x.p, c.k, sum((x.val - c.val) * (x.val - c.val)) AS s FROM x JOIN c{r} c USING (p, d) GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY u, p ORDER BY s, k) = 1
)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (
    SELECT c.p, c.k, c.d, coalesce(m.val, c.val) AS val FROM c{r} c LEFT JOIN (
        SELECT p, k, d, CAST((t - (t % n + n) % n) // n AS BIGINT) AS val FROM (
            SELECT p, k, d, CAST(sum(val) AS BIGINT) AS t, count(*) AS n FROM a{r} JOIN x USING (u, p) GROUP BY ALL)) m USING (p, k, d)
)""")
    return f"""
WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS u, vec_id, label,
           list_transform(embedding, lambda y: CAST(floor(1024 * CAST(y AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0
), x AS MATERIALIZED (
    SELECT u, (i - 1) // w AS p, (i - 1) % w AS d, val FROM (
        SELECT u, len(e) // {parts} AS w, unnest(e) AS val, unnest(range(1, len(e) + 1)) AS i FROM v)
), c0 AS MATERIALIZED (
    SELECT p, k, d, val FROM x JOIN (
        SELECT u, row_number() OVER (ORDER BY vec_id, e) - 1 AS k FROM v WHERE vec_id IS NOT NULL QUALIFY k < {entries}) USING (u)
),{','.join(steps)}, o AS (
    SELECT u, string_agg(printf('%02x', k), '' ORDER BY p) AS code, CAST(sum(s) AS BIGINT) AS error FROM a{rounds} GROUP BY u
), h AS (
    SELECT sha256(string_agg(CAST(val AS VARCHAR), ',' ORDER BY p, k, d)) AS codebooks_sha256 FROM c{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN o USING (u), h
"""
