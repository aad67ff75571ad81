"""Quality rules with n-gram perplexity: a modified Kneser-Ney model, counted
and smoothed by Spark, stored in sorted hash arrays; a document is rejected
outside the perplexity band of its language.

Tokens of the model are characters (folded to 4095 classes of 12 bits), so that
a 5-gram is one 60-bit key from which suffix and history follow by bit
operations, and the model's size is that of the alphabet's habits rather than
of the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import Words, checkpointed, mix, row_slices, shared_dir, text_buffer
from eventlake.llm.files import array, new_file

ORDER, BITS = 5, 12
#: Fixed values of the base rule.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
MAX_BROADCAST = 10_000
#: Each text is scored by the model of the other folds' texts.
FOLDS = 2
#: Rows of a model's table for each of its partitions.
PART_ROWS = 100_000
_UNIT = float(1 << 32)
_CLASS: list[np.ndarray] = []


def _classes() -> np.ndarray:
    """Class of each code point: lower case, one class for white space and one for
    digits; from 2048 on code points share classes. 0 stands before a text."""
    if not _CLASS:
        table = np.arange(0x110000, dtype=np.int64)
        for c in range(0x800):
            low = chr(c).lower()
            table[c] = ord(low) if len(low) == 1 else c
            if chr(c).isspace() or c < 32:
                table[c] = 32
            elif chr(c).isdigit():
                table[c] = 48
        table = np.where(table >= 0x800, 0x800 + table % 0x7FF, table)
        _CLASS.append(table.astype(np.uint64))
    return _CLASS[0]


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the ORDER-grams that end at each character, and offsets of the texts in them."""
    lo, hi = int(offsets[0]), int(offsets[-1])
    part = data[lo:hi]
    points = np.frombuffer(part.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    heads = np.r_[0, np.cumsum((part & 0xC0) != 0x80)]
    first = heads[offsets - lo]
    chars = _classes()[points]
    place = np.arange(len(chars)) - np.repeat(first[:-1], np.diff(first))
    keys = chars.copy()
    for back in range(1, ORDER):
        before = np.r_[np.zeros(min(back, len(chars)), np.uint64), chars[: max(len(chars) - back, 0)]]
        before[place < back] = 0
        keys |= before << np.uint64(BITS * back)
    return keys, first


def count(docs: DataFrame) -> DataFrame:
    """Rows (lang, key, a): how often each 5-gram stands in the texts of a language (null: '')."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def out():
            for lang, parts in held.items():
                keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                n = np.bincount(back, np.concatenate([c for _, c in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "key", "a"])

        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            data, offsets = text_buffer(batch.column(1))
            for lo, hi in row_slices(offsets, 1 << 20):
                keys, first = grams(data, offsets[lo : hi + 1])
                of = np.repeat(np.arange(hi - lo), np.diff(first))
                for lang in sorted(set(langs[lo:hi])):
                    distinct, n = np.unique(keys[(langs[lo:hi] == lang)[of]], return_counts=True)
                    held.setdefault(lang, []).append((distinct, n))
                    size += len(distinct)
                if size > 4_000_000:
                    yield from out()
                    held, size = {}, 0
        yield from out()

    source = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, "lang string, key bigint, a bigint").groupBy("lang", "key").agg(F.sum("a").alias("a"))


def gram_tag(n: int) -> int:
    """Upper bits of the key of an n-gram of order n (none for the highest order)."""
    return (n % ORDER) << (BITS * ORDER)


def history_tag(n: int) -> int:
    """Upper bits of the key of a history of order n, as a signed number."""
    return ((8 + n) << (BITS * ORDER)) - (1 << 64)


def in_parts(table: DataFrame, rows: int) -> DataFrame:
    """A table of `rows` rows at most in no more partitions than these need: the lower orders are
    small, and each partition costs files in every shuffle and checkpoint."""
    return table.coalesce(max(1, -(-rows // PART_ROWS)))


def smooth(counts: DataFrame) -> DataFrame:
    """Rows (lang, key, logp): natural log of the interpolated modified Kneser-Ney
    probability of the last character of each n-gram after the others, for 5-grams
    and all lower orders, and of the weight that each history leaves to the next
    lower order (order 1: times the uniform probability).  The upper four bits of
    a key tell them apart, see `gram_tag` and `history_tag`.

    Lower orders count the distinct characters before an n-gram.  Discounts of
    1, 2 and 3 or more come from the counts of counts of each language and
    order; where those are too few, 0.5, 1 and 1.5.
    """
    counts = checkpointed(counts)
    rows = {ORDER: counts.count()}
    tables = {ORDER: in_parts(counts, rows[ORDER])}
    for n in range(ORDER - 1, 0, -1):
        lower = tables[n + 1].groupBy("lang", F.col("key").bitwiseAND((1 << (BITS * n)) - 1).alias("key")).agg(F.count("*").alias("a"))
        tables[n] = checkpointed(in_parts(lower, rows[n + 1]))
        rows[n] = tables[n].count()
    below, out = None, []
    for n in range(1, ORDER + 1):
        table = tables[n]
        ones = [F.sum(F.when(F.col("a") == k, 1).otherwise(0)).cast("double").alias(f"n{k}") for k in range(1, 5)]
        y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

        def discount(k: int):
            value = k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}"))
            enough = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0)
            return F.when(enough & (value > 0) & (value < k), value).otherwise(k / 2)  # noqa: B023

        levels = table.groupBy("lang").agg(*ones, F.count("*").alias("types")).select("lang", "types", *[discount(k).alias(f"d{k}") for k in (1, 2, 3)])
        history = F.shiftrightunsigned("key", BITS).alias("h")
        mine = F.when(F.col("a") == 1, F.col("d1")).when(F.col("a") == 2, F.col("d2")).otherwise(F.col("d3"))
        sizes = (
            table.groupBy("lang", history)
            .agg(F.sum("a").alias("s"), *[F.sum(F.when(F.col("a") == k, 1).otherwise(0)).alias(f"c{k}") for k in (1, 2)], F.sum(F.when(F.col("a") > 2, 1).otherwise(0)).alias("c3"))
            .join(levels, "lang")
            .select("lang", "h", "s", "types", "d1", "d2", "d3", ((F.col("d1") * F.col("c1") + F.col("d2") * F.col("c2") + F.col("d3") * F.col("c3")) / F.col("s")).alias("g"))
        )
        sizes = checkpointed(in_parts(sizes, rows[n]))
        own = table.withColumn("h", history).join(sizes, ["lang", "h"])
        first = (F.col("a") - mine) / F.col("s")
        if below is None:
            done = own.select("lang", "key", (first + F.col("g") / (F.col("types") + 1)).alias("p"))
        else:
            lower = below.select("lang", F.col("key").alias("suffix"), F.col("p").alias("q"))
            done = own.withColumn("suffix", F.col("key").bitwiseAND((1 << (BITS * (n - 1))) - 1)).join(lower, ["lang", "suffix"]).select(
                "lang", "key", (first + F.col("g") * F.col("q")).alias("p")
            )
        below = checkpointed(in_parts(done, rows[n]))
        left = F.col("g") if n > 1 else F.col("g") / (F.col("types") + 1)
        out.append(below.select("lang", F.col("key").bitwiseOR(F.lit(gram_tag(n))).alias("key"), F.log("p").alias("logp")))
        out.append(sizes.select("lang", F.col("h").bitwiseOR(F.lit(history_tag(n))).alias("key"), F.log(left).alias("logp")))
    return reduce(DataFrame.union, out)


def lang_key(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang))


class LogProbs:
    """Sorted hash arrays of log probabilities in the shared folder, cut by key range."""

    def __init__(self, path: str, parts: int, held: frozenset[int]):
        self.path, self.parts, self.held = path, parts, held
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __getstate__(self):
        return self.__dict__ | {"open": {}}

    def edges(self) -> np.ndarray:
        return np.array([-(-(k << 64) // self.parts) for k in range(1, self.parts)], np.uint64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Value of each key (sorted and distinct); NaN where there is none."""
        out = np.full(len(keys), np.nan)
        cuts = [0, *np.searchsorted(keys, self.edges()).tolist(), len(keys)]
        for part in range(self.parts):
            a, b = cuts[part], cuts[part + 1]
            if a == b or part not in self.held:
                continue
            if part not in self.open:
                name = f"{self.path}/{part:06d}"
                self.open[part] = array(f"{name}.keys", np.uint64), array(f"{name}.values", np.float32)
            own, values = self.open[part]
            at = np.minimum(np.searchsorted(own, keys[a:b]), len(own) - 1)
            hit = own[at] == keys[a:b]
            out[a:b][hit] = values[at[hit]]
        return out


def log_probs(model: LogProbs, keys: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """Log probability of the last character of each 5-gram (a language's seed beside
    it); an unseen one falls back through the lower orders.  Without a model: 0."""

    def find(keys: np.ndarray, seeds: np.ndarray, tag: int) -> np.ndarray:
        hashes, back = np.unique(mix((keys | np.uint64(tag % (1 << 64))) ^ seeds), return_inverse=True)
        return model.get(hashes)[back]

    total, left = np.zeros(len(keys)), np.arange(len(keys))
    for n in range(ORDER, 0, -1):
        part = keys[left] & np.uint64((1 << (BITS * n)) - 1)
        got = find(part, seeds[left], gram_tag(n))
        seen = ~np.isnan(got)
        total[left[seen]] += got[seen]
        left, part = left[~seen], part[~seen]
        if not len(left):
            break
        total[left] += np.nan_to_num(find(part >> np.uint64(BITS), seeds[left], history_tag(n)))
    return total


def store(table: DataFrame, path: str | None = None, part_rows: int = 500_000) -> LogProbs:
    """Write rows (lang, key, logp) as sorted hash arrays; each part is one key range of about `part_rows` rows."""
    path = path or shared_dir(table.sparkSession, "kneser-ney")
    parts = max(1, -(-table.count() // part_rows))
    arrays = LogProbs(path, parts, frozenset())

    def hashed(batches):
        edges = arrays.edges()
        for batch in batches:
            langs = batch.column(0).to_pylist()
            seeds = {x: lang_key(x) for x in set(langs)}
            keys = mix(batch.column(1).to_numpy().view(np.uint64) ^ np.array([seeds[x] for x in langs], np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.searchsorted(edges, keys, "right").astype(np.int32)), pa.array(keys.view(np.int64)), batch.column(2)], ["part", "hash", "logp"]
            )

    def write(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        keys = group.column("hash").to_numpy().view(np.uint64)
        order = np.argsort(keys)
        for suffix, values in (("keys", keys[order]), ("values", group.column("logp").to_numpy()[order].astype(np.float32))):
            with new_file(f"{path}/{part:06d}.{suffix}") as out:
                out.write(values.tobytes())
        return pa.table({"part": pa.array([part], pa.int32())})

    rows = table.select("lang", "key", "logp").mapInArrow(hashed, "part int, hash bigint, logp double")
    made = checkpointed(rows.groupBy("part").applyInArrow(write, "part int")).collect()
    arrays.held = frozenset(r.part for r in made)
    return arrays


def line_repeats(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def base_counts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    w = Words(data, offsets, lower=False)
    n = np.diff(w.first)
    part = data[offsets[0] : offsets[-1]]
    at = offsets - offsets[0]
    over = lambda marks: np.diff(np.r_[0, np.cumsum(marks)][at])
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    space = np.zeros(256, bool)
    space[[0x20, *range(0x09, 0x0E)]] = True
    chars = over(((part & 0xC0) != 0x80) & ~space[part])
    lines = np.array([line_repeats(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.int64)
    repeated = np.zeros(len(w.hash), bool)
    if len(w.hash) > 2:
        of = np.repeat(np.arange(len(n)), n)
        inside = of[2:] == of[:-2]
        step = np.uint64(0x9E3779B97F4A7C15)
        three = mix((w.hash[:-2] * step + w.hash[1:-1]) * step + w.hash[2:]) ^ mix(of[2:].astype(np.uint64) + np.uint64(1))
        _, back, times = np.unique(three[inside], return_inverse=True, return_counts=True)
        again = np.flatnonzero(inside)[times[back] > 1]
        for k in range(3):
            repeated[again + k] = True
    repeats = np.diff(np.r_[0, np.cumsum(repeated)][w.first])
    return [n, chars, over(symbol[part]), lines, repeats]


def measure(docs: DataFrame, model: LogProbs) -> DataFrame:
    """doc_id, lang, digest of the text, the base counts and `level`, the mean negative
    log probability of a character (log perplexity; null for texts without characters)."""
    known = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = known.value
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            seeds = {x: lang_key(x) for x in set(batch.column(1).to_pylist())}
            seed = np.array([seeds[x] for x in batch.column(1).to_pylist()], np.uint64)
            counts, levels = [], []
            for lo, hi in row_slices(offsets, 1 << 20):
                mine = offsets[lo : hi + 1]
                counts.append(base_counts(data, mine))
                keys, first = grams(data, mine)
                n = np.diff(first)
                seeded = np.repeat(seed[lo:hi], n)
                distinct, back = np.unique(keys ^ seeded, return_inverse=True)
                at = np.empty(len(distinct), np.int64)
                at[back] = np.arange(len(back))
                values = log_probs(m, keys[at], seeded[at])
                # whole numbers: the level of a text does not hang on its place in the batch
                steps = np.rint(values * _UNIT).astype(np.int64)
                total = np.diff(np.r_[0, np.cumsum(steps[back])][first]) / _UNIT
                levels.append(np.where(n > 0, -total / np.maximum(n, 1), np.nan))
            columns = [np.concatenate(c) for c in zip(*counts, strict=True)] if counts else [np.zeros(0, np.int64)] * 5
            level = np.concatenate(levels) if levels else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), *(pa.array(c, pa.int64()) for c in columns), pa.array(level, mask=np.isnan(level))],
                ["doc_id", "lang", "digest", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "level"],
            )

    kind = dict(source.dtypes)["doc_id"]
    return source.mapInArrow(
        run, f"doc_id {kind}, lang string, digest bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, level double"
    )


def judge(docs: DataFrame, below: float = 6.0, above: float = 4.0) -> DataFrame:
    """Base counts of every whole text and whether it is kept.

    base_failed: fewer than 50 words, or more than half of the words stand in
    repeated three-word windows.  Of the others those are kept whose log
    perplexity lies within the band of their language: from the lower quartile
    less `below` quartile distances to the upper quartile plus `above` of them.

    Texts are dealt to FOLDS folds by their digest, so copies share a fold; each
    is scored by the model of its language's texts in the other folds, and held
    against the band of its language and fold (levels of one model).  Quartiles
    are over distinct texts that pass the base rule; the quartile distance counts
    as half the pooled one of all languages at least (of levels less the median
    of their band).  Null languages are one language; null and empty texts fail
    the base rule; a language without texts in the other folds has no model, all
    its levels are 0; an empty table gives no rows.
    """
    lang, fold = F.coalesce(F.col("lang").cast("string"), F.lit("")), F.pmod(F.xxhash64("text"), F.lit(FOLDS))
    texts = docs.select("doc_id", "lang", F.col("text").cast("string").alias("text"))
    others = F.filter(F.sequence(F.lit(0), F.lit(FOLDS - 1)), lambda k: k != fold)  # the folds whose texts this one teaches
    taught = texts.select(lang.alias("l"), "text", F.explode(others).alias("k")).select(F.concat_ws("\0", "l", "k").alias("lang"), "text")
    model = store(smooth(count(taught)))
    base = F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")
    scored = texts.withColumn("lang", F.concat_ws("\0", lang, fold))
    rows = checkpointed(measure(scored, model).withColumn("base_failed", base))
    distinct = rows.where(~F.col("base_failed")).groupBy(F.col("lang").alias("band_lang"), "digest").agg(F.first("level").alias("level"))
    distinct = checkpointed(distinct)
    quartiles = F.percentile_approx("level", [0.25, 0.5, 0.75], 10_000).alias("q")
    bands = checkpointed(distinct.groupBy("band_lang").agg(quartiles))
    small = bands.count() <= MAX_BROADCAST  # a row for each band: a language with most rows then stays where it is
    near = F.broadcast(bands) if small else bands
    off = distinct.join(near, "band_lang").select((F.col("level") - F.col("q")[1]).alias("off"))
    pooled = off.agg(F.percentile_approx("off", [0.25, 0.75], 10_000)).first()[0] or [0.0, 0.0]
    spread = F.greatest(F.col("q")[2] - F.col("q")[0], F.lit((pooled[1] - pooled[0]) / 2))
    bands = bands.select("band_lang", (F.col("q")[0] - below * spread).alias("low"), (F.col("q")[2] + above * spread).alias("high"))
    if small:
        bands = F.broadcast(bands)
    return rows.join(bands, F.col("lang") == F.col("band_lang"), "left").drop("digest").withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("level").between(F.col("low"), F.col("high")), F.lit(False))
    ).withColumn("lang", F.expr("substring(lang, 1, length(lang) - 2)")).drop("band_lang")
