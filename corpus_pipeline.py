"""From documents to packed training sequences: filter by language, drop near-duplicates and leaked
benchmarks, mask personal data, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daylake.llm import decontaminate, langid, packing, pii, simhash
from daylake.llm.common import stored, table
from daylake.llm.queries import tokenizer_path

#: A document is kept if a language is found with this score at least.
LEAST_SCORE = 0.25


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is learned from the labelled ones. Those without a letter and those unlike any
    language known go; where none is labelled, all with a letter stay. Repeated rows share their fate, a null id
    is like any other."""
    model = langid.fit_model(langid.sample(docs))
    return langid.accepted(docs, model, LEAST_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the least id: fingerprints of three-word shingles, at
    most three bits apart at each link. Rows that repeat an id and a fingerprint are one; a null id stays only
    where its group has no other; null and empty texts are copies of each other."""
    return simhash.one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none, and so stay; null and empty items are
    held by none."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind in brackets; n_chars follows the new text. A null text stays null
    and keeps its n_chars. Every row stays."""
    return pii.masked(docs).withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens. A null text is its end token alone; repeated rows are documents
    of their own."""
    return packing.packed(docs, tokenizer_path()).drop("ids")


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("packing", pack),
]

#: SQL cannot express these stages; tests/llm compares run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
