"""The corpus pipeline: quality, near duplicates, secrets, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last
give the columns of ``documents``. A stage works on all that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stormfare.llm import bpe, mixing, ngram, quality, secrets
from stormfare.llm.queries import VOCABULARIES
from stormfare.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, copies under one id and without id included."""
    return ngram.keep_one(docs, by_row=True)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; documents without any stay as they are."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out, so that the sources come near their target weights."""
    return mixing.mix(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids, with their digest and that of the decoded bytes."""
    return bpe.encode_texts(docs, f"{VOCABULARIES}/byte_bpe_50k.tiktoken", keep_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("secret masking", mask_secrets),
    ("source mixing", mix_sources),
    ("byte BPE", encode_tokens),
]

#: Set similarity, decoding and recursion over texts are beyond one SQL statement.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
