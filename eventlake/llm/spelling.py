"""Spelling variants by reduced-alphabet generation.

Two words are near if one inserted, deleted or replaced code point turns one into the other.
Letters are hashed to a few symbols; the reduced forms of near words are equal or near, too.  So each word
generates the one-edit neighbourhood of its reduced form (itself, replacements by each of the few
symbols, deletions; an insertion is the other word's deletion), the generated forms are
joined with the reduced vocabulary, and the words that meet are verified on their letters.

A reduced form that many words share would make them all meet.  Such crowded words, and words of
more than `long` code points, are joined by patterns over the whole alphabet instead: the word with one
letter masked, or left out.  Words of one pattern are near for certain and no more than the
alphabet has letters, so there is no hot group and no cap.

Forms and patterns travel as 64-bit hashes; what they bring together is verified, so a
collision adds no pair.

The statistics cover all documents and words: null texts hold no words, a null id counts as an
empty text in the deletion rule, equal rows count each time, an empty table gives no rows, other columns
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import ascii_lower, checkpointed, mix

_BASE = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_MASKED, _PLAIN = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
#: Cells of one numpy step (words x places x symbols).
_CELLS = 1 << 21

WORDS = "wid bigint, word string, n bigint"


def word_counts(docs: DataFrame, text: str = "text", row_id: str = "doc_id", least_chars: int = 6, least: int = 5,
                every: int = 199) -> DataFrame:
    """The vocabulary: rows (wid, word, n) of words with at least `least` occurrences.

    Words are maximal runs of Latin letters, A-Z lower-cased.  A run whose crc32 of
    `<id>:<run>` is divisible by `every` (0: none) loses one letter first."""
    # shorter runs cannot make a word of `least_chars`; longer ones are found whole, as the expression is greedy
    runs = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(f"[A-Za-zÀ-ÿ]{{{least_chars},}}"), F.lit(0))
    rows = docs.select(F.col(f"`{row_id}`").cast("string").alias("id"), F.explode(runs).alias("run"))
    low = F.when(F.col("run").rlike("[A-Z]"), ascii_lower(F.col("run"))).otherwise(F.col("run"))
    rows = rows.select("id", low.alias("low"))
    word: Column = F.col("low")
    if every:
        rows = rows.withColumn("h", F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), F.col("low")).cast("binary")))
        at = F.pmod("h", F.length("low")).cast("int")
        less = F.concat(F.substring("low", F.lit(1), at), F.substring("low", at + 2, F.length("low")))
        word = F.when(F.col("h") % every == 0, less).otherwise(word)
    counted = rows.select(word.alias("word")).where(F.length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n"))
    return checkpointed(counted.where(F.col("n") >= least).select(F.monotonically_increasing_id().alias("wid"), "word", "n"))


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, code points) of words of one length at a time: a matrix with a row for each word."""
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
    starts = np.cumsum(lengths) - lengths
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        step = max(1, _CELLS // (16 * int(n) + 1))
        for lo in range(0, len(rows), step):
            part = rows[lo : lo + step]
            yield part, points[starts[part, None] + np.arange(n)]


def _sums(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights of the places, symbol values by place, and running sums (one more than places)."""
    n = symbols.shape[1]
    weight = np.full(n, _BASE, np.uint64)
    weight[:1] = 1
    weight = np.cumprod(weight, dtype=np.uint64)
    value = symbols * weight
    running = np.zeros((len(symbols), n + 1), np.uint64)
    np.cumsum(value, 1, out=running[:, 1:])
    return weight, value, running


def _plain(total: np.ndarray, n: int, kind: np.uint64) -> np.ndarray:
    return mix(total + np.uint64(n * int(kind) % (1 << 64)))


def _shorter(running: np.ndarray) -> np.ndarray:
    """Hash sums of the sequences without one place."""
    return running[:, :-1] + (running[:, -1:] - running[:, 1:]) * _INVERSE


def symbols_of(points: np.ndarray, symbols: int) -> np.ndarray:
    """The reduced alphabet: each letter's symbol, from 1."""
    return mix(points.astype(np.uint64) + np.uint64(_BASE)) % np.uint64(symbols) + np.uint64(1)


def own_keys(points: np.ndarray, symbols: int) -> np.ndarray:
    s = symbols_of(points, symbols)
    return _plain(_sums(s)[2][:, -1], s.shape[1], _PLAIN)


def neighbour_keys(points: np.ndarray, symbols: int) -> np.ndarray:
    """Keys of the reduced word itself, of its replacements and of its deletions (a row for each word)."""
    s = symbols_of(points, symbols)
    n = s.shape[1]
    weight, value, running = _sums(s)
    total = running[:, -1:]
    other = (s[:, :, None] - np.uint64(1) + np.arange(1, symbols, dtype=np.uint64)) % np.uint64(symbols) + np.uint64(1)
    replaced = total[:, :, None] - value[:, :, None] + other * weight[None, :, None]
    return np.concatenate([_plain(total, n, _PLAIN), _plain(replaced.reshape(len(s), -1), n, _PLAIN),
                           _plain(_shorter(running), n - 1, _PLAIN)], 1)


def pattern_keys(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the word with a place masked, of the word without a place, and of the word, all over its own letters."""
    s = points.astype(np.uint64) + np.uint64(1)
    n = s.shape[1]
    _, value, running = _sums(s)
    total = running[:, -1:]
    return _plain(total - value, n, _MASKED), _plain(_shorter(running), n - 1, _PLAIN), _plain(total, n, _PLAIN)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and key of each row's different keys."""
    keys = np.sort(keys, 1)
    first = np.ones(keys.shape, bool)
    first[:, 1:] = keys[:, 1:] != keys[:, :-1]
    return np.nonzero(first)[0], keys[first]


def _emit(batch: pa.RecordBatch, rows: np.ndarray, keys: np.ndarray, names: list[str], **more: np.ndarray) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(rows), 1 << 17):
        part = slice(lo, lo + (1 << 17))
        at = pa.array(rows[part])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[part].view(np.int64)), *[batch.column(c).take(at) for c in names], *[pa.array(v[part]) for v in more.values()]],
            ["key", *names, *more])


def _own(symbols: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            for rows, points in _by_length(batch.column("word")):
                yield from _emit(batch, rows, own_keys(points, symbols), ["wid", "word", "n"])

    return run


def _neighbours(symbols: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            for rows, points in _by_length(batch.column("word")):
                at, keys = _distinct(neighbour_keys(points, symbols))
                yield from _emit(batch, rows[at], keys, ["word", "n"])

    return run


def _patterns(left: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Left and right rows meet where both have a place masked, or where one is the other without a place."""

    def run(batches):
        for batch in batches:
            for rows, points in _by_length(batch.column("word")):
                masked, shorter, whole = pattern_keys(points)
                for side, keys in ((0, masked), (1, shorter if left else whole), (2, whole if left else shorter)):
                    at, found = _distinct(keys)
                    yield from _emit(batch, rows[at], found, ["wid"], side=np.full(len(at), side, np.int32))

    return run


def _near(a: str, b: str) -> Column:
    return F.levenshtein(F.col(a), F.col(b), 1) == 1


def near_words(vocabulary: DataFrame, symbols: int = 8, crowd: int = 64, long: int = 32) -> DataFrame:
    """Rows (word, n, near, near_n) of all near pairs of a vocabulary (wid, word, n), in both directions."""
    short = vocabulary.where(F.length("word") <= long)
    own = short.mapInArrow(_own(symbols), "key bigint, wid bigint, word string, n bigint")
    crowded = checkpointed(own.groupBy("key").agg(F.count("*").alias("words")).where(F.col("words") > crowd).select("key"))
    any_crowded = crowded.limit(1).count() > 0
    longer = vocabulary.where(F.length("word") > long)
    left, right, free = longer, vocabulary.where(F.length("word") >= long), own
    if any_crowded:
        # a crowded form may hold a third of the vocabulary: joined in salted copies
        salted = crowded.select("key", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("salt"), F.lit(True).alias("is_crowded"))
        marked = own.withColumn("salt", F.pmod("wid", F.lit(16)).cast("int")).join(salted, ["key", "salt"], "left")
        marked = checkpointed(marked.select("key", "wid", "word", "n", F.coalesce("is_crowded", F.lit(False)).alias("is_crowded")))
        free = marked.where("NOT is_crowded").drop("is_crowded")
        left = marked.where("is_crowded").select("wid", "word", "n").unionByName(longer)
        right = vocabulary
    # within the free words: generated forms meet reduced words
    asked = free.select("wid", "word", "n").mapInArrow(_neighbours(symbols), "key bigint, word string, n bigint")
    known = free.select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    met = asked.join(known, "key").where(_near("word", "near")).select("word", "n", "near", "near_n")
    # replacements are found from both words, a deletion only from the longer one
    turned = F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    straight = F.struct("word", "n", "near", "near_n")
    pairs = met.select(F.explode(F.when(F.length("word") == F.length("near"), F.array(straight)).otherwise(F.array(straight, turned))).alias("p")).select("p.*")
    # crowded and long words with all words, by patterns
    a = left.mapInArrow(_patterns(True), "key bigint, wid bigint, side int").withColumnRenamed("wid", "a")
    b = right.mapInArrow(_patterns(False), "key bigint, wid bigint, side int").withColumnRenamed("wid", "b")
    links = a.join(b, ["key", "side"]).where("a <> b").select("a", "b").distinct()
    # a right word that is no left word does not ask itself
    asks = left.select(F.col("wid").alias("b"), F.lit(True).alias("asks"))
    links = links.join(asks, "b", "left").select("a", "b", F.coalesce("asks", F.lit(False)).alias("asks"))
    links = links.join(vocabulary.select(F.col("wid").alias("a"), "word", "n"), "a")
    links = links.join(vocabulary.select(F.col("wid").alias("b"), F.col("word").alias("near"), F.col("n").alias("near_n")), "b")
    links = links.where(_near("word", "near"))
    more = links.select(F.explode(F.when(F.col("asks"), F.array(straight)).otherwise(F.array(straight, turned))).alias("p")).select("p.*")
    return pairs.unionByName(more)


def group_variants(vocabulary: DataFrame, pairs: DataFrame, ratio: int = 5) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n): the form is the near word of largest n (ties: the smallest
    word) if it occurs at least `ratio` times as often; the root is where forms lead in the end."""
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("best"))
    rows = vocabulary.select("word", "n").join(best, "word", "left")
    held = -F.col("best.k") >= ratio * F.col("n")
    rows = checkpointed(rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(held, F.col("best.near")).alias("form"), F.when(held, -F.col("best.k")).alias("form_n")))
    # n grows by the ratio with every step, which bounds the chain; pointers double
    top = rows.agg(F.max("n"), F.min("n")).first()
    steps = 0 if top[0] is None else math.floor(math.log(top[0] / top[1], ratio) + 1e-9) + 1
    to = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(1, steps))))):
        onward = to.select(F.col("word").alias("root"), F.col("root").alias("next"))
        to = checkpointed(to.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    out = rows.join(to, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, text: str = "text", row_id: str = "doc_id", **options) -> DataFrame:
    """Spelling variants of all words of a table."""
    vocabulary = word_counts(docs, text, row_id)
    return group_variants(vocabulary, near_words(vocabulary, **options))
