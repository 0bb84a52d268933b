"""Documents to training tokens: toxic documents out, one of each near-duplicate class, no benchmark passages, surrogates
for personal data, byte-level BPE ids."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.llm import byte_bpe, decontaminate, simhash_dedup, surrogates, toxicity
from talkweave.staging import materialise

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; null and empty texts are scored like any other, rows without doc_id stay unless toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.clean(docs, toxicity.fit(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class: fingerprints of four-word shingles, linked at 4 or fewer differing bits.

    The one with the smallest doc_id stays, null ids last. Texts without words, null ones too, share fingerprint zero and are a
    class of their own kind; of repeated rows one stays; all columns stay as they are.
    """
    return simhash_dedup.keep_one(docs, size=4, radius=4)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; null and empty texts have none."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and secrets; null texts stay null; n_chars, if there, follows the new text."""
    replaced = surrogates.without_values(docs)
    if "n_chars" not in docs.columns:
        return replaced
    return replaced.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ids, n_tokens, and whether the ids decode to the text; a null text has no ids.

    Columns of the input that bear one of these names are replaced; every other one stays, also one called decoded.
    """
    vocabulary = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    others = [docs[c] for c in docs.columns if c != "text"]
    own = [F.struct(*others).alias("doc")] if others else []
    coded = byte_bpe.encode(docs.select("text", *own), *vocabulary, decoded=True)
    same = F.coalesce(F.col("text"), F.lit("")).cast("binary") == F.col("decoded")
    new = {"ids": F.col("ids"), "n_tokens": F.size("ids").cast("long"), "round_trip": same}
    kept = [F.col("text") if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns if c.lower() not in new]
    return coded.select(*kept, *[value.alias(name) for name, value in new.items()])


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("personal_data", replace_personal_data),
    ("byte_bpe", encode),
]

#: A trained network and XXH64 fingerprints have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
