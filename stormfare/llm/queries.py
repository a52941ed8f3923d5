"""The registered queries of the operators, and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stormfare.llm import (
    bpe, conversation_trie, embeddings, hard_negatives, merge_rounds, mixing, ngram, oracle, quality, secrets,
    token_files, toxicity, urls, warc,
)

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


#: Where the vocabulary files of public tokenizers lie.
VOCABULARIES = "/opt/tokenizers"


def _given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    report = quality.quality_report(_given(spark, folder, "documents"))
    return report.drop("class_distance", "word_distance")


def systematic_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixing_report(_given(spark, folder, "documents"))


def warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(_given(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_texts(_given(spark, folder, "documents"), f"{VOCABULARIES}/byte_bpe_50k.tiktoken")


def token_id_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_file_report(
        _given(spark, folder, "documents"), f"{VOCABULARIES}/word_bpe_49k.json")


def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.secret_report(_given(spark, folder, "documents"))


def embedding_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(_given(spark, folder, "embeddings"))


def ngram_groups(spark: SparkSession, folder: str) -> DataFrame:
    return ngram.duplicate_groups(_given(spark, folder, "documents"))


def toxic_scores(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(_given(spark, folder, "documents"), _given(spark, folder, "labels"))


def url_rules(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    return urls.judge_urls(_given(spark, folder, "pages"), rules)


def merge_round_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return merge_rounds.round_trip(_given(spark, folder, "documents"), f"{VOCABULARIES}/byte_bpe_50k.json")


def mined_negatives(spark: SparkSession, folder: str) -> DataFrame:
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(_given(spark, folder, "embeddings"), label=changed)


def conversation_prefixes(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie.prefix_trie(_given(spark, folder, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": quality_rules,
    "op2_systematic_mix": systematic_mix,
    "op3_toxicity": toxic_scores,
    "op4_warc_round_trip": warc_round_trip,
    "op5_byte_bpe": byte_bpe,
    "op6_ngram_groups": ngram_groups,
    "op7_token_files": token_id_files,
    "op8_secret_scan": secret_scan,
    "op9_embedding_duplicates": embedding_duplicates,
    "op10_url_rules": url_rules,
    "op11_merge_rounds": merge_round_bpe,
    "op12_hard_negatives": mined_negatives,
    "op13_conversation_trie": conversation_prefixes,
}

ORACLE: dict[str, str] = {
    "op1_quality_rules": oracle.quality_rules(),
    "op2_systematic_mix": oracle.systematic_mix(),
    "op4_warc_round_trip": oracle.warc_round_trip(),
    "op6_ngram_groups": oracle.ngram_groups(),
    "op9_embedding_duplicates": oracle.embedding_duplicates(),
    "op10_url_rules": oracle.url_rules(URL_RULES),
    "op12_hard_negatives": oracle.hard_negatives(),
    "op13_conversation_trie": oracle.conversation_prefixes(),
}
