"""Corpus pipeline over `documents`: stages written as Parquet and read again.

Every stage takes all rows that its predecessor kept.  Null and empty texts: clean in the first stage, one
SimHash group (fingerprint zero, so one of them stays), no passages, then read and packed as their end token
alone.  Null ids are allowed.  Ties and repeated rows: of equal rows in a SimHash group one stays.  Empty
tables give no rows in every stage.  Columns beside those of documents pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import mixing, packing, passages, simhash, toxicity
from eventlake.llm.common import free_name, shared_dir
from eventlake.llm.queries import TOXIC, vocabulary


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; the model learns from `labels`.

    Null and empty texts have the score of an empty text.  Repeated rows are judged alike."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").select("doc_id", "toxic")
    score = free_name(docs, "__score")
    scored = toxicity.with_score(docs, toxicity.train(docs, labels), score)
    return scored.where(F.col(score) < TOXIC).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: that of the smallest id (nulls last), of equal rows one.

    Texts without words are one group."""
    return simhash.one_of_each(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document holds (null ids first).

    Shorter, empty and null texts stay as they are; a text of which nothing is left goes."""
    return passages.without_repeats(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, small sources up to twice: a row for each reading.

    A null source is a source like any other; texts without words cost nothing and are read once."""
    return mixing.mix(docs, max_repeats=2.0).select(*[F.col(f"`{c}`") for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces packed into sequences of at most 1024 tokens; null and empty texts are their end token."""
    return packing.pack(packing.pieces(docs, vocabulary("byte_bpe_50k.json")))


STAGES = [
    ("toxicity", without_toxic),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", without_repeats),
    ("temperature_mixing", mixed_sources),
    ("best_fit_packing", best_fit_packing),
]

#: Tokenizers and trained scores cannot be written in SQL; tests/llm has the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        out = shared_dir(spark, name)
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return STAGES[-1][1](spark, docs, sf_dir)
