"""Queries over the tables of a folder, one for each operator; and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, jaccard, language, licenses, mixing, quality, secrets, tokenfiles, topk, urls
from .common import table


def _tokenizers():
    """The vocabulary files installed beside this library; operators take any path."""
    import public_tokenizers

    return public_tokenizers


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.token_files(table(spark, sf_dir, "documents"), _tokenizers().path("byte_bpe_50k.json"))


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _tokenizers()
    return bpe.encode_documents(table(spark, sf_dir, "documents"), files.path("byte_bpe_multi_50k.tiktoken"), files.PATTERN)


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_scan(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_filter(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_license_scan, op2_topk_search, op3_token_files, op4_bpe_codec, op5_source_mix, op6_jaccard_join, op7_language_id, op8_quality_rules, op9_secret_scan, op10_url_filter)}

#: The other operators' results depend on trained models, hashes, sketches or other libraries; tests hold them against plain versions.
ORACLE: dict[str, str] = {
    "op2_topk_search": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e, row_number() OVER () AS u FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, q.u AS qu, r.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(r.e AS DOUBLE[])) AS BIGINT) AS score
              FROM v q JOIN v r ON q.u <> r.u AND len(q.e) = len(r.e) WHERE q.vec_id % 50 = 0),
        t AS (SELECT *, row_number() OVER (PARTITION BY qu ORDER BY score DESC, vec_id) AS rank FROM s)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM t WHERE rank <= 5""",
}
