"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    decontaminate,
    language,
    licenses,
    lines,
    packing,
    quality,
    rules,
    sharding,
    simhash,
    trie,
    urls,
    vectors,
    whitening,
)
from tickloom.llm.common import table

TOKENIZER = "byte_bpe_50k.json"


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.digest(packing.pack(docs, public_tokenizers.path(TOKENIZER), added_tokens=True))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.placements(table(spark, sf_dir, "documents"), sharding.shard_names())


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return groups.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, items)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = urls.rows_of(spark, urls.RULES, "key", "verdict")
    blocked = urls.rows_of(spark, tuple((key,) for key in urls.BLOCKED), "key")
    return urls.judge(table(spark, sf_dir, "pages"), rules, blocked)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.cleaned(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn_languages(docs))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scores = quality.quality_scores(docs, quality.learn_quality(docs, labels))
    return scores.select("doc_id", "held_out", "score", "predicted")


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.forked_conversations(table(spark, sf_dir, "conversations"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), most=4, scale=256)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": op1_licenses,
    "op2_packing": op2_packing,
    "op3_sharding": op3_sharding,
    "op4_simhash": op4_simhash,
    "op5_decontamination": op5_decontamination,
    "op6_url_filter": op6_url_filter,
    "op7_line_dedup": op7_line_dedup,
    "op8_language": op8_language,
    "op9_quality": op9_quality,
    "op10_top_k": op10_top_k,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_whitening": op12_whitening,
    "op13_quality_rules": op13_quality_rules,
}

SQL: dict[str, str] = {
    "op1_licenses": licenses.SCAN_SQL,
    "op3_sharding": sharding.placements_sql(sharding.shard_names()),
    "op6_url_filter": urls.JUDGED_SQL,
    "op7_line_dedup": lines.CLEANED_SQL,
    "op10_top_k": vectors.TOP_SQL,
    "op11_conversation_trie": trie.TRIE_SQL,
}
