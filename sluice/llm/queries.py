"""The queries of this package: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluice.llm import bpe, chat_format, decontaminate, language_id, license_scan, lm_scoring, merkle, pii, quality_classifier, quality_rules, simhash, token_alignment, warc
from sluice.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = lm_scoring.held_out(docs)
    model = lm_scoring.learn(docs.filter(~out))
    scored = lm_scoring.scored(docs, model)
    return scored.withColumn("held_out", lm_scoring.held_out(scored))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = language_id.predicted(docs, language_id.learn(docs.filter(~language_id.held_out(docs))))
    return found.withColumn("held_out", language_id.held_out(found))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_classifier.scores(docs, quality_classifier.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(documents(spark, sf_dir))


#: A conversation of control strings, besides those of the table.
CONTROLS = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return chat_format.digests(chat_format.windows(told.union(spark.createDataFrame(CONTROLS, told.schema)), path=public_tokenizers.path("word_bpe_49k.json")))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scanned(documents(spark, sf_dir), license_scan.known_texts(spark), license_scan.long_texts(spark))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "capture")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_alignment.file_contents(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    texts, _ = token_alignment.aligned(documents(spark, sf_dir), *files)
    return token_alignment.digests(texts)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(documents(spark, sf_dir))


def queries() -> dict[str, Query]:
    every = (op1_lm_scoring, op2_decontaminate, op3_simhash_near_dedup, op4_quality_rules, op5_language_id, op6_quality_classifier, op7_pii, op8_chat_format, op9_license_scan, op10_bpe, op11_warc, op12_token_alignment, op13_merkle_manifest)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op9_license_scan": license_scan.oracle(), "op11_warc": warc.ORACLE, "op13_merkle_manifest": merkle.ORACLE}
