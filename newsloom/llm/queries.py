"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import (
    anchors,
    centroids,
    decontamination,
    language,
    licences,
    packing,
    personal,
    phrases,
    planes,
    quality,
    quartiles,
    setsketch,
    token_counts,
)
from newsloom.llm.tables import texts_by_id
from newsloom.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op7_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), setsketch.CONTRACT)


@query
def op9_fixed_block_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anchors.without_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("repeats", F.lit(0).cast("long"), lambda total, x: total + (x["finish"] - x["begin"]))
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.col("text"), 256).alias("kept_sha256"))


@query
def op10_least_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = packing.PackOptions(tokenizer=public_tokenizers.path("word_bpe_49k.json"))
    return packing.packed(table(spark, sf_dir, "documents"), options)


@query
def op5_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op8_boosted_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    found = personal.personal_data(documents, personal.fit(texts_by_id(documents)))
    count = lambda kind: F.regexp_count("base", F.lit(f"{kind}:")).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, personal.KINDS), F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op3_factorisation_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, options = table(spark, sf_dir, "documents"), quality.FmOptions()
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    machine = quality.fit(documents, table(spark, sf_dir, "labels"), ~held_out, options)
    found = quality.scored(documents, machine, options)
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op6_quartile_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quartiles.compared(table(spark, sf_dir, "documents"))


@query
def op1_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, options = table(spark, sf_dir, "documents"), language.LanguageOptions()
    model = language.fit(documents, options)
    return language.identified(language.document_evidence(documents), model, options)


@query
def language_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator with all four kinds of evidence: raw pages."""
    options = language.LanguageOptions()
    model = language.fit(table(spark, sf_dir, "documents"), options)
    found = language.identified(language.page_evidence(table(spark, sf_dir, "pages")), model, options)
    return found.withColumnRenamed("doc_id", "page_id")


@query
def op2_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document is edited three times: a cut, a copied passage and a replacement."""
    options = token_counts.CountOptions(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    index = token_counts.indexed(table(spark, sf_dir, "documents"), options)
    size = F.char_length("text")
    part = F.greatest(F.lit(1), F.floor(size / 50)).cast("int")

    def edit(place: Column, removed: Column, added: Column) -> Column:
        return F.struct(place.cast("int").alias("place"), removed.alias("removed"), added.alias("added"))

    edits = F.array(
        edit(F.floor(size / 4), part, F.lit("")),
        edit(F.floor(size / 2), F.lit(0), F.right("text", part)),
        edit(F.floor(size * 3 / 4), part, F.concat(F.lit(" "), F.col("doc_id").cast("string"))),
    )
    found = token_counts.recounted(index, edits, options)
    return found.select(
        "doc_id",
        F.col("n_before").alias("n_tokens"),
        F.get("tokens", F.lit(1)).cast("long").alias("n_tokens_edited"),
        F.char_length("text").cast("long").alias("n_chars_edited"),
        "n_encoded",
    )


@query
def op4_licence_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licensed(table(spark, sf_dir, "documents"), licences.known_licences(spark))


SQL["op4_licence_digests"] = licences.oracle()


@query
def op11_dynamic_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


SQL["op11_dynamic_collocations"] = phrases.oracle()


@query
def op13_subvector_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = centroids.clustered(table(spark, sf_dir, "embeddings"))
    digest = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256)
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256"))


SQL["op13_subvector_centroids"] = centroids.oracle()


@query
def op12_plane_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    options = planes.PlaneOptions(tokenizer=public_tokenizers.path("byte_bpe_50k.json"))
    return planes.round_trip(table(spark, sf_dir, "documents"), options)
