"""From raw documents to tokens: quality, near copies, secrets, mixture, encoding.

Each stage works on all that its predecessor kept, and its result is written and read again for the next one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import byte_bpe, jaccard_join, mixing, quality, secrets
from plumbline.llm.common import written
from plumbline.session import bound_batches, pin_utc


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    bound_batches(spark)
    return quality.kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest id."""
    bound_batches(spark)
    return jaccard_join.one_of_each(docs, width=5, percent=80)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets become a mask; every document stays."""
    return secrets.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and with as many of their words, as the mixture takes."""
    return mixing.mixed_documents(docs)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and a digest of the bytes that they decode to."""
    bound_batches(spark)
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    # written in between, so that no task holds two Python workers, one of each step
    tokens = written(byte_bpe.encode(docs, "doc_id", "text", path, pattern), "tokens")
    tokens = tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("ids").alias("_ids"))
    back = byte_bpe.decode(tokens, "_ids", path, pattern)
    return back.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_classifier", keep_quality),
    ("ngram_jaccard_join", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("source_mixing", mix_sources),
    ("byte_bpe", encode_texts),
]

#: No SQL has the classifier, the mixture or the tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
