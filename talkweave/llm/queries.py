"""One query per operator, over its whole table with production parameters."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.llm import (
    byte_bpe, chat_format, decontaminate, katz, license_scan, merkle, periodic_runs, simhash_dedup, substring_dedup, surrogates, toxicity, warc, whitening,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.digests(byte_bpe.encode(docs, *vocabulary, packed=True, decoded=True))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    return chat_format.digests(chat_format.format_conversations(turns))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(license_scan.scan(table(spark, sf_dir, "documents")))


def op4_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compared(table(spark, sf_dir, "documents"))


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_values(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_values")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring_dedup.remove_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.scores(table(spark, sf_dir, "documents"))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(warc.round_trip(table(spark, sf_dir, "pages")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents"))
    return periodic_runs.report(periodic_runs.periodic_runs(planted))


def queries() -> dict[str, Query]:
    return {name: made for name, made in globals().items() if name.startswith("op") and callable(made)}
