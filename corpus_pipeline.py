"""A training corpus from ``documents``: five stages, each written and read again by its caller.

The stages keep the columns of ``documents``; the last one returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import decontamination, language, packing, personal, setsketch
from newsloom.llm.tables import broadcast_within, texts_by_id
from newsloom.session import Staging, configure

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` except the ids in ``dropped``; rows without an id stay."""
    dropped = Staging(docs.sparkSession)(dropped.where("doc_id IS NOT NULL").distinct(), "dropped")
    return docs.select(*COLUMNS).join(broadcast_within(dropped, dropped.count()), "doc_id", "left_anti").select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: rows without a language (no words, or undecided) go, others with their id stay.

    A row is known by its id and a hash of the rest of its evidence; rows alike in all of that
    have the same verdict.
    """
    configure(spark)
    options, key = language.LanguageOptions(), F.xxhash64("text", "lang", "source")
    docs = docs.select(*COLUMNS)
    evidence = language.document_evidence(docs).withColumn("key", F.xxhash64("text", "declared", "host"))
    found = language.identified(evidence, language.fit(docs, options), options, carry=("key",))
    judged = found.where(F.col("language") == language.UNKNOWN).select(F.col("doc_id").alias("gone_id"), F.col("key").alias("gone_key"))
    gone = Staging(spark)(judged.distinct(), "dropped")
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (key == F.col("gone_key"))
    return docs.join(broadcast_within(gone, gone.count()), same, "left_anti")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7 on five-word shingles at 0.8: the smallest id of each group stays."""
    configure(spark)
    found = setsketch.near_duplicates(docs, setsketch.SketchOptions())
    return _without(docs, found.where("NOT kept").select("doc_id"))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents with a passage of the benchmark go."""
    configure(spark)
    found = decontamination.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, found.where("contaminated").select("doc_id"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: personal data is replaced by its kind; ``n_chars`` follows the text."""
    configure(spark)
    found = personal.personal_data(docs, personal.fit(texts_by_id(docs)), carry=("lang", "source"))
    return found.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: pieces of the remaining documents in windows of 4096 tokens."""
    configure(spark)
    return packing.packed(docs, packing.PackOptions(tokenizer=public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written before the next reads it."""
    keep = Staging(configure(spark))
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# Trained models and hashes decide; tests hold the stages against brute-force versions.
ORACLE_SQL = None
