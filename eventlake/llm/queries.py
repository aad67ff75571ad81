"""Driver queries of the training-data operators, one for each, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import (
    codebooks, interpolation, kneser, knn, mixing, packing, passages, secret_scan, seekable, simhash, spelling, toxicity,
    urlfilter,
)
from eventlake.sources.tables import read_table


#: A text of at least this score is taken as toxic.
TOXIC = 0.3


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = knn.prepare(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))
    return knn.top_k(vectors.where("vec_id % 20 = 0"), vectors, k=20)


def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A corpus-sized budget at 95 % of the greatest entropy, no source read over four times."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "source", "text"])
    out = mixing.mix(docs, budget_share=1.0, entropy_share=0.95, max_repeats=4.0)
    return out.select(
        "doc_id", "source", F.col("__epoch").alias("epoch"), F.col("__block").alias("block"),
        F.col("__block_key").alias("block_key"), F.col("__order_key").alias("order_key"),
        F.col("__tokens").alias("n_tokens"), F.col("__weight").alias("weight"),
    )


def op3_seekable_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return seekable.round_trip(docs, vocabulary("word_bpe_49k.json"), end_id=1).select("doc_id", "start", "n_tokens", "ids_crc32")


#: The rules of the driver's filter.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op4_url_digest_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = urlfilter.build(urlfilter.rule_table(spark, URL_RULES))
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url"])
    return urlfilter.judge(pages, index).select("page_id", "host", "path", "rule", "verdict")


def op5_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return simhash.groups(docs).select("doc_id", "fingerprint", "component_id")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return packing.pack(packing.pieces(docs, vocabulary("byte_bpe_50k.json")))


def op8_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    scored = interpolation.score(docs, interpolation.train(docs, order=2))
    return scored.select(
        "doc_id", interpolation.held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op9_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "lang", "text"])
    return kneser.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))
    scored = toxicity.with_score(docs, model)
    return scored.select(
        "doc_id", toxicity.held_out().alias("held_out"), "score",
        F.when(F.col("score") >= TOXIC, 1).otherwise(0).cast("int").alias("predicted"),
    )


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return found.select("doc_id", *secret_scan.digest_columns())


def op12_ball_codebooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4 parts, 256 entries, 4 rounds."""
    vectors = codebooks.prepare(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"]))
    coded, books = codebooks.compress(vectors)
    return codebooks.with_label_error(coded).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(None if books is None else codebooks.books_digest(books)).cast("string").alias("codebooks_sha256"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_voronoi_knn": op1_voronoi_knn,
    "op2_temperature_mixing": op2_temperature_mixing,
    "op3_seekable_token_files": op3_seekable_token_files,
    "op4_url_digest_filter": op4_url_digest_filter,
    "op5_compact_windows": op5_compact_windows,
    "op6_simhash": op6_simhash,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_deleted_interpolation": op8_deleted_interpolation,
    "op9_kneser_ney_quality": op9_kneser_ney_quality,
    "op10_toxicity": op10_toxicity,
    "op11_secret_scan": op11_secret_scan,
    "op12_ball_codebooks": op12_ball_codebooks,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE: dict[str, str] = {
    "op11_secret_scan": secret_scan.oracle_sql(),
    "op12_ball_codebooks": codebooks.oracle_sql(),
    "op1_voronoi_knn": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, d.vec_id, CAST(list_sum(list_transform(list_zip(q.e, d.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 20
""",
    "op4_url_digest_filter": """
WITH rules(verdict, rule) AS (
    VALUES ('block', 'net/'), ('allow', 'example.net/en/'), ('block', 'example.com/de/'), ('allow', 'org/fr/')
), a AS (
    SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), b AS (
    SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM a
), c AS (
    SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
    FROM b
), f AS (
    SELECT c.page_id, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
    FROM c JOIN rules r
      ON starts_with(c.path, substr(r.rule, strpos(r.rule, '/')))
     AND (c.host = split_part(r.rule, '/', 1) OR ends_with(c.host, '.' || split_part(r.rule, '/', 1)))
    GROUP BY c.page_id
)
SELECT c.page_id, c.host, c.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM c LEFT JOIN f USING (page_id)
""",
}
