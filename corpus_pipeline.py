"""A corpus pipeline: documents in, encoded documents out. Each stage works on all rows that the one before it wrote."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import bpe, jaccard, mixing, quality, secrets
from sluice.llm.common import shared_dir, table
from sluice.llm.queries import _tokenizers


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, each row judged for itself. Null texts are empty and go; other columns stay."""
    return quality.keep_good(docs)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates; rows without words all stay, as do other columns."""
    return jaccard.keep_one(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked and n_chars counted anew where that changed; null texts stay null."""
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in as many copies as the mix takes; those without words stay as they are, as do other columns."""
    return mixing.repeat(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of what they decode to, a row a copy; null texts have no ids.

    By the last stage the executors' heaps have grown, so that the tables of the workers are kept small.
    """
    files = _tokenizers()
    return bpe.encode_documents(docs, files.path("byte_bpe_multi_50k.tiktoken"), files.PATTERN, max_chunks=100_000)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_stage),
    ("n-gram jaccard join", jaccard_stage),
    ("secret scans", secret_stage),
    ("mixing sources", mixing_stage),
    ("bpe encoding", encode_stage),
]
#: Sketches, a forest and a transducer are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    base = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        path = f"{base}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
