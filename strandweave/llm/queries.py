"""The registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, langid, mixing, packing, quality, rules, secrets, simhash, tokencount, urlfilter
from .common import crc_fold, read_table


def op1_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", crc_fold(F.col("doc_id"), 3) == 1)
    voter = quality.fit(docs.filter(~F.col("held_out")), read_table(spark, sf_dir, "labels"))
    return quality.classify(docs, voter, ["doc_id", "held_out"])


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), ["doc_id"])


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read_table(spark, sf_dir, "documents"), ["doc_id"], vocabulary=public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(read_table(spark, sf_dir, "pages"), ["page_id"])


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return tokencount.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"])


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", crc_fold(F.col("doc_id"), 4) == 2)
    net = langid.fit(docs.filter(~F.col("held_out")))
    return langid.identify(docs, net, ["doc_id", "held_out"])


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read_table(spark, sf_dir, "embeddings"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_knn": op1_quality_knn,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_mix_sources": op3_mix_sources,
    "op4_secret_scan": op4_secret_scan,
    "op5_url_filter": op5_url_filter,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_language_id": op8_language_id,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_quality_rules": op10_quality_rules,
}

ORACLE_SQL = {
    "op3_mix_sources": mixing.ORACLE_SQL,
    "op5_url_filter": urlfilter.ORACLE_SQL,
    "op9_nearest_neighbours": ann.ORACLE_SQL,
    "op10_quality_rules": rules.ORACLE_SQL,
}
