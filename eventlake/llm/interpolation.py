"""Language-model scores by deleted interpolation: n-gram maximum-likelihood
estimates mixed by context-frequency buckets, weights learned by EM on the
counts of held-out training documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import Words, checkpointed, mix, row_slices, shared_dir, text_buffer
from eventlake.llm.hasharrays import HashArrays, store

#: Keys of the end of a text and of the place before its first word (no word hashes to them but by chance).
END, START = np.uint64(0xE7D0E7D0E7D0E7D1), np.uint64(0x57A2757A2757A273)
_STEP = np.uint64(0xD6E8FEB86659FD93)
BUCKETS = 24


def id_crc():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))


def held_out():
    """Rows that are only scored: crc32(doc_id as text) mod 7 is 2 (a null id counts as empty text)."""
    return id_crc() % 7 == 2


def delta():
    """Training rows on whose counts the weights are learned (and which count in the final model)."""
    return id_crc() % 7 == 5


def sequences(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, token keys, offsets): the words of each text, A-Z folded, then END."""
    data, offsets = text_buffer(column)
    for lo, hi in row_slices(offsets, 1 << 20):
        w = Words(data, offsets[lo : hi + 1], lower=True)
        first = w.first + np.arange(hi - lo + 1)
        keys = np.full(first[-1], END, np.uint64)
        inside = np.ones(first[-1], bool)
        inside[first[1:] - 1] = False
        keys[inside] = w.hash
        yield lo, hi, keys, first


def histories(keys: np.ndarray, first: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 .. order the keys of the n-grams that end at each token; START stands before a text."""
    grams, place = [keys], np.arange(len(keys)) - np.repeat(first[:-1], np.diff(first))
    for n in range(2, order + 1):
        # the n-gram is its first n - 1 tokens' n-gram (one token earlier) and the token
        before = np.r_[START, grams[-1][:-1]]
        before = np.where(place == 0, mix(np.full(1, START + np.uint64(n), np.uint64))[0], before)
        grams.append(mix(before * _STEP + keys))
    return grams


def _contexts(keys: np.ndarray, first: np.ndarray, grams: list[np.ndarray]) -> list[np.ndarray]:
    """Keys of the history of each n-gram, n = 2 .. order (valid where the token is not the first)."""
    return [np.r_[START, g[:-1]] for g in grams[:-1]]


@dataclass
class Interpolated:
    """Counts (kind 0: without the delta rows, kind 1: delta rows) and what was learned."""

    arrays: HashArrays
    order: int
    tokens: int
    distinct: int
    docs: int
    weights: np.ndarray  # buckets x (order + 1): uniform, unigram, ..., highest order


def bucket(context: np.ndarray) -> np.ndarray:
    """Frequency class of a context: 0 if never seen, else 1 + floor(log2), at most BUCKETS - 1."""
    return np.minimum(np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))) + 1, 0), BUCKETS - 1).astype(np.int64)


def _estimates(arrays: HashArrays, order: int, kinds, tokens: int, distinct: int, docs: int, keys, first) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, estimates n x (order + 1), unigram counts) of each token; kinds: which counts to add up."""
    grams = histories(keys, first, order)
    counts = [arrays.get(n, g)[:, kinds].sum(1) for n, g in enumerate(grams)]
    out = np.zeros((len(keys), order + 1))
    out[:, 0] = 1.0 / (distinct + 1)
    out[:, 1] = counts[0] / max(tokens, 1)
    begins = np.zeros(len(keys), bool)
    begins[first[:-1][np.diff(first) > 0]] = True
    context = np.zeros(len(keys), np.int64)
    for n in range(2, order + 1):
        # every token but END is followed by another, so a history was seen as often as its n-gram; START once a document
        context = np.where(begins, docs, np.r_[0, counts[n - 2][:-1]])
        out[:, n] = np.where(context > 0, counts[n - 1] / np.maximum(context, 1), 0.0)
    return bucket(context), out, counts[0]


def train(docs: DataFrame, order: int = 2, rounds: int = 30, tolerance: float = 1e-4, path: str | None = None) -> Interpolated:
    """Learn from the rows of docs (doc_id, text) that are not held out.

    Counts of all n-grams are merged over the whole table.  The mixture weights
    of each bucket come from expectation-maximisation on the delta rows
    against the counts of the rest, as a count table of equal cases (bucket and
    the counts of their n-grams), which stays in Spark: each round is one
    aggregate with a row for each bucket.  A bucket that the delta rows do not
    reach takes the weights of all together.  Without training rows every
    token has the uniform estimate.
    """
    spark = docs.sparkSession
    rows = docs.where(~held_out()).select(F.col("text").cast("string").alias("text"), delta().cast("int").alias("kind"))

    def grams(batch):
        kind = batch.column(1).to_numpy()
        for lo, hi, keys, first in sequences(batch.column(0)):
            of = np.repeat(kind[lo:hi], np.diff(first))
            for n, g in enumerate(histories(keys, first, order)):
                distinct, back = np.unique(g, return_inverse=True)
                counts = np.bincount(back * 2 + of, minlength=2 * len(distinct)).reshape(-1, 2)
                yield n, distinct, counts

    arrays = store(rows, grams, path or shared_dir(spark, "interpolation"), tables=order, kinds=2)
    sizes = dict(rows.groupBy("kind").count().collect())
    tokens = sum(total for (t, _), (_, total) in arrays.manifest.items() if t == 0)

    # tokens and distinct tokens without the delta rows, from the unigram arrays
    parts = spark.createDataFrame([(p,) for (t, p) in arrays.manifest if t == 0], "part int")

    def plain(batches):
        for batch in batches:
            got = [arrays.shard(0, p)[1][:, 0] for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(g.sum()) for g in got], pa.int64()), pa.array([int((g > 0).sum()) for g in got], pa.int64())], ["n", "v"]
            )

    n_rest, v_rest = (x or 0 for x in parts.mapInArrow(plain, "n bigint, v bigint").agg(F.sum("n"), F.sum("v")).first())
    d_rest = sizes.get(0, 0)

    def cases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, keys, first in sequences(batch.column(0)):
                b, p, _ = _estimates(arrays, order, [0], n_rest, v_rest, d_rest, keys, first)
                case, back = np.unique(np.c_[b, p], axis=0, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(case[:, 0].astype(np.int32)), pa.array(list(case[:, 1:]), pa.list_(pa.float64())), pa.array(np.bincount(back.ravel(), minlength=len(case)))],
                    ["bucket", "p", "n"],
                )

    seen = rows.where("kind = 1").select("text").mapInArrow(cases, "bucket int, p array<double>, n bigint")
    seen = checkpointed(seen.groupBy("bucket", "p").agg(F.sum("n").alias("n")))
    weights = np.full((BUCKETS, order + 1), 1.0 / (order + 1))
    last = None
    for _ in range(rounds):
        table = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in weights])
        shares = F.transform(F.arrays_zip(F.col("p"), table[F.col("bucket")].alias("w")), lambda x: x["p"] * x["w"])
        parted = seen.select("bucket", "n", shares.alias("s")).withColumn("t", F.aggregate("s", F.lit(0.0), lambda a, x: a + x))
        got = parted.groupBy("bucket").agg(F.sum(F.col("n") * F.log("t")).alias("l"), *[F.sum(F.col("n") * F.col("s")[k] / F.col("t")).alias(f"w{k}") for k in range(order + 1)]).collect()
        if not got:
            weights[:] = np.eye(order + 1)[0] if not tokens else 1.0 / (order + 1)
            break
        parts_of = {r.bucket: np.array([r[f"w{k}"] for k in range(order + 1)]) for r in got}
        pooled = sum(parts_of.values())
        weights = np.array([parts_of.get(b, pooled) for b in range(BUCKETS)])
        weights[0, order] = 0.0 if order > 1 else weights[0, order]  # a context never seen says nothing
        weights /= weights.sum(1, keepdims=True)
        level = sum(r.l for r in got)
        if last is not None and abs(level - last) <= tolerance * abs(last) / 100:
            break
        last = level
    return Interpolated(arrays, order, tokens, arrays.rows(0), sum(sizes.values()), weights)


def score(docs: DataFrame, model: Interpolated) -> DataFrame:
    """Score every whole text (null: empty): doc_id, n_tokens (END counts), n_known,
    train_tokens, base_score (add-one unigram) and score (log10 probability)."""
    known = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = known.value
        for batch in batches:
            out = [[], [], [], []]
            for _, _, keys, first in sequences(batch.column(1)):
                b, p, c = _estimates(m.arrays, m.order, [0, 1], m.tokens, m.distinct, m.docs, keys, first)
                logs = np.log10((p * m.weights[b]).sum(1))
                base = np.log10((c + 1) / (m.tokens + m.distinct + 1))
                for x, y in zip(out, (np.diff(first), np.add.reduceat(c > 0, first[:-1], dtype=np.int64), np.add.reduceat(base, first[:-1]), np.add.reduceat(logs, first[:-1])), strict=True):
                    x.append(y)
            if out[0]:
                n, k, base, logs = (np.concatenate(x) for x in out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(k), pa.array(np.full(len(n), m.tokens)), pa.array(base), pa.array(logs)],
                    ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    kind = dict(source.dtypes)["doc_id"]
    return source.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
