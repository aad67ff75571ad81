"""Temperature mixing of sources: exponentiated token shares, realised as
budgeted block permutations of each source's documents."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventlake.llm.common import checkpointed, row_key

WORDS = r"[^\x20\x09-\x0D]+"
STEPS, ROUNDS = 16, 9
#: Sources x blocks beyond this many rows are joined by a shuffle, not broadcast.
BROADCAST_ROWS = 100_000


def word_count(text: str = "text"):
    """Tokens of a document for mixing: its words; null has none."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`").cast("string"), F.lit(WORDS)), F.lit(0)).cast("bigint")


@dataclass
class Mixture:
    """The exponent met, the token budget, and rows (source_key, source, tokens,
    docs, weight, epochs, rest): whole epochs and tokens left for the last one."""

    exponent: float
    budget: float
    sources: DataFrame


def _bounded(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _first(low: float, high: float, fits, values) -> float:
    """Least exponent in [low, high] that `fits`; each round asks for STEPS + 1 at once."""
    for _ in range(ROUNDS):
        grid = [low + (high - low) * k / STEPS for k in range(STEPS + 1)]
        good = [fits(*v) for v in zip(grid, values(grid), strict=True)]
        k = next((k for k, ok in enumerate(good) if ok), STEPS)
        if k == 0:
            return low
        low, high = grid[k - 1], grid[k]
    return high


def solve(
    sources: DataFrame, budget: float | None, entropy_share: float | None = None, max_repeats: float | None = None
) -> tuple[float, float]:
    """(exponent, budget) for rows with a share p > 0.

    Weights are p^a / sum(p^a), 0 <= a <= 1.  `entropy_share`: the least a at
    which the entropy of the weights is down to that part of the greatest
    possible one (a = 1 if the shares are flatter still).  `max_repeats`: the
    least a at which no source is read more often.  With both, the larger a.
    Without a budget it is the least one at which every source is read once.
    The sums over sources are Spark aggregates of one row; sources are never
    collected.
    """
    n, low, high, total = sources.agg(F.count("*"), F.min("p"), F.max("p"), F.sum("tokens")).first()
    if not n:
        return 1.0, 0.0

    def sums(grid: list[float]) -> list[tuple[float, float]]:
        row = sources.agg(*[x for a in grid for x in (F.sum(F.expr(f"pow(p, {a!r}D)")), F.sum(F.expr(f"pow(p, {a!r}D) * ln(p)")))]).first()
        return [(row[2 * k], row[2 * k + 1]) for k in range(len(grid))]

    def read(a: float, z: float) -> float:
        """Times that the source read most often is read."""
        return (high / low) ** (1 - a) if budget is None else low ** (a - 1) / z * budget / total

    exponent = 0.0
    if entropy_share is not None:
        exponent = _first(0.0, 1.0, lambda a, s: math.log(s[0]) - a * s[1] / s[0] <= entropy_share * math.log(n) + 1e-12, sums)
    if max_repeats is not None:
        exponent = max(exponent, _first(0.0, 1.0, lambda a, s: read(a, s[0]) <= max_repeats + 1e-9, sums))
    z = sums([exponent])[0][0]
    if budget is None:
        budget = total * z * high ** (1 - exponent)
    elif max_repeats is not None:
        budget = min(budget, max_repeats * total)
    return exponent, float(budget)


def plan(docs: DataFrame, budget: float | None = None, budget_share: float | None = None, entropy_share: float | None = None, max_repeats: float | None = None) -> Mixture:
    """Mixture for docs with columns __source (key), __tokens and source.

    `budget` in tokens, or `budget_share` of the corpus; without either, the
    least budget at which every document is read at least once.  A source
    without tokens has weight 0 and is read once, as that costs nothing.
    """
    table = checkpointed(
        docs.groupBy("__source").agg(F.first("source", ignorenulls=True).alias("source"), F.sum("__tokens").alias("tokens"), F.count("*").alias("docs"))
    )
    total = table.agg(F.sum("tokens")).first()[0] or 0
    shares = checkpointed(table.where("tokens > 0").withColumn("p", F.col("tokens") / F.lit(float(max(total, 1)))))
    budget = budget_share * total if budget is None and budget_share is not None else budget
    exponent, budget = solve(shares, budget, entropy_share, max_repeats)
    z = shares.agg(F.sum(F.expr(f"pow(p, {exponent!r}D)"))).first()[0] or 1.0
    p = F.col("tokens") / F.lit(float(max(total, 1)))
    weight = F.when(F.col("tokens") > 0, F.pow(p, F.lit(exponent)) / F.lit(z)).otherwise(F.lit(0.0))
    turns = F.when(F.col("tokens") > 0, F.col("weight") * F.lit(budget) / F.col("tokens")).otherwise(F.lit(1.0))
    done = (
        table.withColumn("weight", weight).withColumn("turns", turns + F.lit(1e-9))
        .withColumn("epochs", F.floor("turns").cast("int"))
        .withColumn("rest", F.greatest(F.lit(0), F.floor((F.col("turns") - F.col("epochs")) * F.col("tokens"))).cast("bigint"))
        .withColumnRenamed("__source", "source_key").drop("turns")
    )
    return Mixture(exponent, budget, checkpointed(done))


def mix(
    docs: DataFrame, budget: float | None = None, budget_share: float | None = None, entropy_share: float | None = None,
    max_repeats: float | None = None, block_tokens: int = 1 << 20, max_blocks: int = 4096, seed: int = 1,
) -> DataFrame:
    """docs realised to the mixture: a row for each reading of a document, with
    __epoch, __block, __block_key, __order_key, __tokens and __weight.

    Reading order: per source by epoch, then __block_key, then __order_key: in
    each epoch the blocks of a source are permuted anew, and so are the
    documents of a block.  Blocks are dealt by a row digest, about
    `block_tokens` tokens each and at most `max_blocks` a source, so that a
    source with a third of all rows is spread over many groups.  Whole epochs
    read every document; the last one reads blocks in order until the source's
    tokens are used up, and in the block of the cut those documents that still
    fit.  Each source stays below its budget by less than one document or one
    set of equal rows.

    Null sources are one source of their own; null and empty texts have no
    tokens; equal rows are read equally often; empty tables give no rows.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    keyed = row_key(docs, "__row").select(  # the row as one value: its names cannot clash with ours
        F.struct(*own).alias("__doc"), "__row", word_count().alias("__tokens"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")).alias("__source"),
    )
    narrow = checkpointed(keyed.select("__row", "__source", "source", "__tokens"))
    mixture = plan(narrow, budget, budget_share, entropy_share, max_repeats)
    blocks_of = F.least(F.lit(max_blocks), F.ceil(F.col("tokens") / F.lit(block_tokens)) + 1).cast("int")
    source = mixture.sources.select(F.col("source_key").alias("__source"), "epochs", "rest", F.col("weight").alias("__weight"), blocks_of.alias("blocks"))
    source = _bounded(source)

    def placed(rows: DataFrame) -> DataFrame:
        """Block of each row, and its place in the source's last epoch."""
        return (
            rows.join(source, "__source")
            .withColumn("__block", F.pmod(F.xxhash64("__row", F.lit(seed)), F.col("blocks")).cast("int"))
            .withColumn("last_block", F.xxhash64(F.lit(seed), "__source", "epochs", "__block"))
            .withColumn("last_order", F.xxhash64(F.lit(seed), "epochs", "__row"))
        )

    cut_rows = placed(narrow).where("rest > 0")
    sums = cut_rows.groupBy("__source", "__block", "last_block", "rest").agg(F.sum("__tokens").alias("size"))
    running = Window.partitionBy("__source").orderBy("last_block", "__block").rowsBetween(Window.unboundedPreceding, 0)
    cuts = checkpointed(
        sums.withColumn("until", F.sum("size").over(running)).where("until > rest AND until - size <= rest")
        .select("__source", F.col("__block").alias("cut_block"), F.col("last_block").alias("cut_key"), (F.col("rest") - F.col("until") + F.col("size")).alias("room"))
        # of blocks without tokens at the cut the last one
        .groupBy("__source").agg(F.max(F.struct("cut_key", "cut_block", "room")).alias("c")).select("__source", "c.*")
    )
    inside = cut_rows.join(_bounded(cuts), "__source").where("__block = cut_block")
    upto = Window.partitionBy("__source").orderBy("last_order").rangeBetween(Window.unboundedPreceding, 0)
    edge = (
        inside.withColumn("used", F.sum("__tokens").over(upto)).where("used <= room")
        .groupBy("__source").agg(F.max("last_order").alias("edge"))
    )
    last = checkpointed(cuts.join(edge, "__source", "left").select(F.col("__source"), "cut_key", "cut_block", "edge"))
    whole = placed(keyed.drop("source")).join(_bounded(last), "__source", "left")
    extra = F.when(
        (F.col("rest") > 0) & F.col("cut_key").isNotNull()
        & ((F.col("last_block") < F.col("cut_key"))
           | ((F.col("last_block") == F.col("cut_key")) & (F.col("__block") < F.col("cut_block")))
           | ((F.col("__block") == F.col("cut_block")) & (F.col("last_order") <= F.col("edge")))),
        1,
    ).otherwise(F.when((F.col("rest") > 0) & F.col("cut_key").isNull(), 1).otherwise(0))
    return (
        whole.withColumn("__times", F.col("epochs") + extra).where("__times > 0")
        .withColumn("__epoch", F.explode(F.sequence(F.lit(0), F.col("__times") - 1)))
        .select(
            *[F.col("__doc")[c].alias(c) for c in docs.columns], "__epoch", "__block",
            F.xxhash64(F.lit(seed), "__source", "__epoch", "__block").alias("__block_key"),
            F.xxhash64(F.lit(seed), "__epoch", "__row").alias("__order_key"), "__tokens", "__weight",
        )
    )
