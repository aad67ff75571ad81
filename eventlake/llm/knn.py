"""Exact top-k search by inner product as a Voronoi kNN join.

Vectors are compared as integers floor(64 * x).  A vector x of norm at most M
gets one more component sqrt(M^2 - |x|^2), a query is scaled to norm M with 0
there: then the nearest vectors are those of the highest inner product, and
distances obey the triangle inequality that the bounds need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import checkpointed

SCALE = 64.0
#: Largest integer below which products and sums of doubles are exact.
EXACT = 2.0**53


def prepare(table: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows (uid, vec_id, v): v holds floor(64 * x) as little-endian int64 (clipped
    to their range).  Null vectors and vectors with a null, NaN or infinite
    component take no part.  uid tells rows with equal ids apart."""
    x = f"`{vector}`"
    good = f"{x} IS NOT NULL AND NOT exists({x}, e -> e IS NULL OR isnan(e) OR abs(e) = double('infinity'))"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            sizes = np.asarray(column.value_lengths())
            values = np.clip(np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE), -9.2e18, 9.2e18)
            raw, ends = values.astype("<i8").tobytes(), np.r_[0, np.cumsum(sizes)] * 8
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())], ["vec_id", "v"]
            )

    rows = table.where(good).select(F.col(f"`{id_column}`").cast("bigint").alias("vec_id"), F.expr(x).cast("array<double>").alias("x"))
    rows = rows.mapInArrow(run, "vec_id bigint, v binary")
    return checkpointed(rows.withColumn("uid", F.monotonically_increasing_id()).select("uid", "vec_id", "v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Integer vectors as rows; shorter ones end in zeros."""
    out = np.zeros((len(column), width), np.int64)
    for k, raw in enumerate(column.to_pylist()):
        out[k, : len(raw) // 8] = np.frombuffer(raw, "<i8")
    return out


def _raised(x: np.ndarray, top: float) -> np.ndarray:
    x = x.astype(np.float64)
    rest = np.sqrt(np.maximum(top * top - (x * x).sum(1), 0.0))
    return np.c_[x, rest]


def _scaled(q: np.ndarray, top: float) -> np.ndarray:
    q = q.astype(np.float64)
    norm = np.sqrt((q * q).sum(1, keepdims=True))
    return np.c_[q * (top / np.maximum(norm, 1e-300)), np.zeros(len(q))]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0.0))


class Cells:
    """Pivots and, once the summaries are known, what each query group needs."""

    def __init__(self, pivots: np.ndarray, top: float, width: int):
        self.pivots, self.top, self.width = _raised(pivots, top), top, width
        self.between = _distances(self.pivots, self.pivots)
        # rounding errors of distances, which come from squares
        self.slack = 1e-6 * max(top, 1.0)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = _distances(points, self.pivots)
        cell = d.argmin(1)
        return cell, d[np.arange(len(d)), cell]

    def bound(self, radius: np.ndarray, nearest: dict[int, list[float]], wanted: int, groups: int) -> None:
        """radius: of each cell's queries (negative: none); nearest: the least
        distances of each cell's vectors to its pivot; wanted: rows to be found."""
        self.radius = radius
        reach = np.full(len(radius), np.inf)
        pairs = [(j, d) for j, ds in nearest.items() for d in ds]
        if len(pairs) >= wanted:
            cell, away = np.array([j for j, _ in pairs]), np.array([d for _, d in pairs])
            for i in np.flatnonzero(radius >= 0):
                reach[i] = np.partition(radius[i] + self.between[i, cell] + away, wanted - 1)[wanted - 1]
        self.reach = reach + self.slack
        # neighbouring cells share a group: walk along the pivots from one to the nearest not yet visited
        left, order, at = set(np.flatnonzero(radius >= 0).tolist()), [], 0
        while left:
            at = min(left, key=lambda j: (self.between[at, j], j))
            order.append(at)
            left.remove(at)
        self.group = np.full(len(radius), -1)
        self.group[order] = np.arange(len(order)) * groups // max(len(order), 1)

    def needed(self, cell: np.ndarray, away: np.ndarray, groups: int) -> np.ndarray:
        """Which groups need each vector (rows x groups)."""
        out = np.zeros((len(cell), groups), bool)
        for i in np.flatnonzero(self.radius >= 0):
            apart = self.between[i, cell]
            least = np.maximum(apart - away, away - apart) - self.radius[i]
            out[:, self.group[i]] |= least <= self.reach[i]
        return out


def best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k highest values, of equal ones the first."""
    if scores.shape[1] <= k:
        return tuple(x.ravel() for x in np.indices(scores.shape))
    limit = np.partition(scores, -k, axis=1)[:, -k][:, None]
    above = scores > limit
    ties = scores == limit
    room = k - above.sum(1, keepdims=True)
    return np.nonzero(above | (ties & (np.cumsum(ties, axis=1) <= room)))


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; through doubles where those are exact (beyond the long range they wrap)."""
    if float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1] < EXACT:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def _block(group: int, salt: int, rows: list[tuple]) -> tuple:
    uid, vec_id, v = (np.concatenate(c) for c in zip(*rows, strict=True))
    return group, salt, uid.tobytes(), vec_id.tobytes(), v.tobytes()


_BLOCK = "grp int, salt int, uids binary, ids binary, vs binary"


def _blocks(choose, width: int, size: int, salts: int):
    """Rows -> blocks of about `size` rows for each group, made while rows stream through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: dict[int, list[tuple]] = {}
        counts: dict[int, int] = {}
        salt = TaskContext.get().partitionId()

        def out(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), *[pa.binary()] * 3), strict=True)],
                ["grp", "salt", "uids", "ids", "vs"],
            )

        for batch in batches:
            for lo in range(0, batch.num_rows, size):
                part = batch.slice(lo, size)
                uid, vec_id = (part.column(k).to_numpy() for k in range(2))
                v = _matrix(part.column(2), width)
                for g, mine in choose(v):
                    held.setdefault(g, []).append((uid[mine], vec_id[mine], v[mine]))
                    counts[g] = counts.get(g, 0) + len(uid[mine])
                    if counts[g] >= size:
                        salt += 1
                        yield out([_block(g, salt % salts, held.pop(g))])
                        counts[g] = 0
        for g, rows in held.items():
            salt += 1
            yield out([_block(g, salt % salts, rows)])

    return run


def top_k(
    queries: DataFrame, data: DataFrame, k: int = 20, n_pivots: int = 128, groups: int = 16, salts: int = 8, block_rows: int = 2048
) -> DataFrame:
    """For each query its k rows of data with the highest integer inner product
    (all, if there are fewer), its own row (same uid) excluded; ties go to the
    smaller vec_id, then uid.  Rows (query_id, rank from 1, vec_id, score).

    1. Pivots: `n_pivots` data rows with the least hash of the uid, the only
       rows that are gathered besides the summaries.
    2. Summaries: the radius of each cell's queries, and the k + 1 least pivot
       distances of each cell's vectors.  They bound how far the k-th neighbour
       of a cell's queries can be.
    3. A vector goes to a group of query cells only if the triangle inequality
       leaves a chance to be that near; blocks of vectors meet blocks of the
       group's queries, dealt by (group, salt), so that a crowded cell is
       spread over many tasks.
    4. Every pair of blocks gives at most k rows for each query; the best k of
       these are the result.

    Zero queries have score 0 with every row and take the smallest vec_ids.
    Vectors of unequal length: missing components count as 0.  Null ids come
    last among ties.  Empty sides give no rows.
    """
    spark = data.sparkSession
    width = data.agg(F.max(F.length("v"))).first()[0]
    more = queries.agg(F.max(F.length("v")), F.count("*")).first()
    if width is None or not more[1]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    width = max(width, more[0], 8) // 8
    zero = F.length(F.regexp_replace(F.hex("v"), "0", "")) == 0
    null_id = (1 << 63) - 1
    data = data.withColumn("vec_id", F.coalesce("vec_id", F.lit(null_id)))
    queries = queries.withColumn("vec_id", F.coalesce("vec_id", F.lit(null_id)))

    def norms(batches):
        for batch in batches:
            v = _matrix(batch.column(0), width).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array([float(np.sqrt((v * v).sum(1).max(initial=0.0)))])], ["top"])

    top = max(data.select("v").mapInArrow(norms, "top double").agg(F.max("top")).first()[0], 1.0)
    picked = data.orderBy(F.xxhash64("uid"), "uid").limit(n_pivots).select("v").toPandas()["v"]
    pivots = np.unique(_matrix(pa.array(picked.map(bytes)), width), axis=0)
    cells = Cells(pivots, top, width)

    def radius(batches):
        far = np.full(len(pivots), -1.0)
        for batch in batches:
            cell, away = cells.nearest(_scaled(_matrix(batch.column(0), width), top))
            np.maximum.at(far, cell, away)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(far))), pa.array(far)], ["cell", "far"])

    def nearest(batches):
        kept: dict[int, np.ndarray] = {}
        for batch in batches:
            cell, away = cells.nearest(_raised(_matrix(batch.column(0), width), top))
            for c in np.unique(cell):
                both = np.sort(np.r_[kept.get(int(c), np.zeros(0)), away[cell == c]])
                kept[int(c)] = both[: k + 1]
        rows = [(c, float(d)) for c, ds in kept.items() for d in ds]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], ["cell", "away"])

    asking = queries.where(~zero)
    far = np.full(len(pivots), -1.0)
    for cell, value in asking.select("v").mapInArrow(radius, "cell bigint, far double").groupBy("cell").agg(F.max("far")).collect():
        far[cell] = value
    least = Window.partitionBy("cell").orderBy("away")
    near: dict[int, list[float]] = {}
    summary = data.select("v").mapInArrow(nearest, "cell bigint, away double").withColumn("n", F.row_number().over(least))
    for cell, away in summary.where(F.col("n") <= k + 1).select("cell", "away").collect():
        near.setdefault(cell, []).append(away)
    cells.bound(far, near, k + 1, groups)
    known = spark.sparkContext.broadcast(cells)

    def for_queries(v):
        cells = known.value
        own = cells.group[cells.nearest(_scaled(v, cells.top))[0]]
        return [(int(g), np.flatnonzero(own == g)) for g in np.unique(own)]

    def for_data(v):
        cells = known.value
        need = cells.needed(*cells.nearest(_raised(v, cells.top)), groups)
        return [(g, np.flatnonzero(need[:, g])) for g in range(groups) if need[:, g].any()]

    left = asking.select("uid", "vec_id", "v").mapInArrow(_blocks(for_queries, width, block_rows // 2, 1), _BLOCK)
    left = left.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    right = data.select("uid", "vec_id", "v").mapInArrow(_blocks(for_data, width, block_rows, salts), _BLOCK)
    pairs = left.join(right.toDF("grp", "salt", "d_uids", "d_ids", "d_vs"), ["grp", "salt"])

    def solve(batches):
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("uids", "ids", "vs", "d_uids", "d_ids", "d_vs")), strict=True):
                qu, qi, qv, du, di, dv = (np.frombuffer(x, np.int64) for x in row)
                order = np.lexsort((du, di))
                du, di, dv = du[order], di[order], dv.reshape(-1, width)[order]
                score = products(qv.reshape(-1, width), dv)
                i, j = best(score, k + 1)
                good = qu[i] != du[j]
                i, j = i[good], j[good]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (qu[i], qi[i], du[j], di[j], score[i, j])], ["q_uid", "query_id", "uid", "vec_id", "score"]
                )

    found = pairs.select("uids", "ids", "vs", "d_uids", "d_ids", "d_vs").mapInArrow(
        solve, "q_uid bigint, query_id bigint, uid bigint, vec_id bigint, score bigint"
    )
    # the k + 1 rows that zero queries take, as a constant
    first = data.orderBy("vec_id", "uid").limit(k + 1).select("uid", "vec_id").collect()
    rows = F.array(*[F.struct(F.lit(r.uid).cast("bigint").alias("uid"), F.lit(r.vec_id).cast("bigint").alias("vec_id")) for r in first])
    idle = queries.where(zero).select(F.col("uid").alias("q_uid"), F.col("vec_id").alias("query_id"), F.explode(rows).alias("d"))
    found = found.union(idle.where("q_uid <> d.uid").select("q_uid", "query_id", "d.uid", "d.vec_id", F.lit(0).cast("bigint")))
    order = Window.partitionBy("q_uid").orderBy(F.desc("score"), "vec_id", "uid")
    name = lambda c: F.when(F.col(c) != null_id, F.col(c)).alias(c)
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select(name("query_id"), F.col("rank").cast("int").alias("rank"), name("vec_id"), "score")
    )
