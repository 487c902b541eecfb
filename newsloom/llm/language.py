"""Language identification by Bayesian fusion of evidence.

Four sources are combined in log space: the likelihood of the text under byte-trigram models,
the declared markup language through its measured confusion with the text, the suffix of the
address, and the host. Suffix and host give priors from grouped sums of the text's posteriors;
each level is smoothed towards the one above it, and a document's own share is left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.tables import broadcast_within, sampled
from newsloom.llm.words import buffers
from newsloom.session import Staging

UNKNOWN = "und"
SLICE_BYTES = 1 << 18  # text whose trigrams a worker holds at a time; their arrays take some 40 times as much
HELD = 64  # languages whose counts a worker sums up before it hands them on


@dataclass(frozen=True)
class LanguageOptions:
    """``sample`` bounds the labelled rows for the trigram models.

    Trigrams of a text depend on each other, so ``n`` of them count as ``n / (1 + n / effective)``.
    ``strength`` is the number of documents a parent prior is worth; a posterior below ``least``
    is no decision.
    """

    bits: int = 14
    sample: int = 4000
    effective: float = 200.0
    strength: float = 20.0
    least: float = 0.8


@dataclass
class TextModel:
    """Log probabilities of hashed byte trigrams per language."""

    languages: list[str]
    logs: np.ndarray


def _trigrams(data: np.ndarray, bits: int) -> np.ndarray:
    """Hashed trigrams of lower-cased ASCII and all other bytes as they are."""
    b = data.astype(np.uint32)
    b += ((b >= 65) & (b <= 90)).astype(np.uint32) * np.uint32(32)
    code = b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)


def _lettered(data: np.ndarray) -> np.ndarray:
    """Whether a byte belongs to a letter (ASCII letters and everything beyond ASCII)."""
    return (data >= 128) | ((data | 32) >= 97) & ((data | 32) <= 122)


def _parts(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First document, bytes and offsets of slices of at most :data:`SLICE_BYTES`.

    A longer document comes in several slices; each also has the next two bytes, so that every
    trigram lies in one.
    """
    data, offsets = buffers(texts)
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        if last > first:
            yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        else:
            last = first + 1
            for low in range(int(offsets[first]), int(offsets[last]) - 2, SLICE_BYTES):
                piece = data[low : min(low + SLICE_BYTES + 2, offsets[last])]
                yield first, piece, np.array([0, len(piece)])
        first = last


def _usable(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of trigrams inside one document that hold at least two letters, per document."""
    if len(data) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    letters = _lettered(data).astype(np.int8)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    good = (letters[:-2] + letters[1:-1] + letters[2:] >= 2) & (owner[:-2] == owner[2:])
    at = np.flatnonzero(good)
    return at, owner[at]


def fit(labelled: DataFrame, options: LanguageOptions) -> TextModel:
    """Trigram models from at most ``options.sample`` rows ``doc_id, text, lang``, by hash order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def summed() -> Iterator[pa.RecordBatch]:
            for name in sorted(held):
                yield pa.record_batch([pa.array([name]), pa.array([held[name]], pa.list_(pa.int64()))], names=["lang", "counts"])
            held.clear()

        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), dtype=object)
            for first, data, offsets in _parts(batch.column(0)):
                at, owner = _usable(data, offsets)
                grams = _trigrams(data, options.bits)[at] if len(at) else np.zeros(0, dtype=np.uint32)
                own = names[first : first + len(offsets) - 1]
                for name in sorted(set(own)):
                    held[name] = held.get(name, 0) + np.bincount(grams[own[owner] == name] if len(at) else grams, minlength=1 << options.bits)
                    if len(held) == HELD:
                        yield from summed()
        yield from summed()

    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text", "lang")
    rows = sampled(rows, options.sample).select("text", "lang")
    totals: dict[str, np.ndarray] = {}
    for name, counts in rows.mapInArrow(run, "lang string, counts array<long>").toLocalIterator():
        totals[name] = totals.get(name, 0) + np.array(counts)
    languages = sorted(totals)
    counts = np.stack([totals[x] for x in languages], axis=1) + 0.5 if languages else np.ones((1 << options.bits, 1))
    return TextModel(languages or [UNKNOWN], np.log(counts / counts.sum(axis=0)).astype(np.float32))


def likelihoods(model: TextModel, options: LanguageOptions):
    """Arrow mapper: the first column is the text; the others pass; adds tempered log likelihoods."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(model.languages)
        for batch in batches:
            found = np.zeros((batch.num_rows, width))
            counts = np.zeros(batch.num_rows, dtype=np.int64)
            for first, data, offsets in _parts(batch.column(0)):
                at, owner = _usable(data, offsets)
                if not len(at):
                    continue
                n = np.bincount(owner, minlength=len(offsets) - 1)
                grams = _trigrams(data, options.bits)[at]
                for k in range(width):
                    found[first : first + len(n), k] += np.bincount(owner, model.logs[grams, k], len(offsets) - 1)
                counts[first : first + len(n)] += n
            found /= (1 + counts / options.effective)[:, None]
            lists = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), width).cast(pa.list_(pa.float64()))
            yield pa.record_batch([*batch.columns[1:], pa.array(counts), lists], names=[*batch.schema.names[1:], "n_grams", "likelihood"])

    return run


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    powers = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(powers, lambda p: p / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def _sums(df: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Posterior mass per language and key: partial sums before the shuffle."""
    each = [F.sum(F.get("posterior", F.lit(k))).alias(f"s{k}") for k in range(width)]
    return df.groupBy(*keys).agg(*each).select(*keys, F.array(*[f"s{k}" for k in range(width)]).alias("mass"))


def _smoothed(mass: Column, parent: Column, strength: float) -> Column:
    total = F.aggregate(mass, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(mass, parent, lambda m, p: (m + strength * p) / (total + strength))


def identified(evidence: DataFrame, model: TextModel, options: LanguageOptions | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, language, probability, text_language, n_grams`` and the ``carry`` columns per row of ``evidence``.

    ``evidence`` has ``doc_id, text, declared, suffix, host``, any of them null. A null or
    unknown declaration is no evidence, a null suffix or host has the prior of the level above.
    The language is ``und`` if the text has no trigram of letters or the posterior stays below
    ``options.least``; so null and empty texts are ``und``. Ties go to the first language by
    name. Rows with a null or repeated id are judged like any other; an empty table gives no
    rows; other columns are not read.
    """
    options = options or LanguageOptions()
    width, spark = len(model.languages), evidence.sparkSession
    keep = Staging(spark)
    base = evidence.select("text", F.col("doc_id").cast("long").alias("doc_id"), F.lower(F.regexp_extract(F.col("declared"), "^[A-Za-z]+", 0)).alias("declared"), F.lower("suffix").alias("suffix"), F.lower("host").alias("host"), *carry)
    passed = "".join(f", `{c}` {evidence.schema[c].dataType.simpleString()}" for c in carry)
    schema = f"doc_id long, declared string, suffix string, host string{passed}, n_grams long, likelihood array<double>"
    rows = keep(base.mapInArrow(likelihoods(model, options), schema), "likelihood")
    names = F.array(*map(F.lit, model.languages))
    rows = rows.withColumn("posterior", _softmax(F.col("likelihood")))
    # rows without text evidence say nothing about their host or declaration
    sure = rows.where("n_grams > 0")

    whole = sure.agg(*[F.sum(F.get("posterior", F.lit(k))) for k in range(width)]).first()
    mass = np.array([x or 0.0 for x in whole])
    overall = F.array(*[F.lit(float(x)) for x in (mass + 1) / (mass.sum() + width)])
    confusion = {row["declared"]: row["mass"] for row in _sums(sure.where(F.col("declared").isin(model.languages)), ["declared"], width).collect()}
    table = np.array([confusion.get(x, [0.0] * width) for x in model.languages]) + 0.5
    logs = np.log(table / table.sum(axis=0))
    spoken = F.lit(None).cast("array<double>")
    for name, line in zip(model.languages, logs):
        spoken = F.when(F.col("declared") == name, F.array(*[F.lit(float(x)) for x in line])).otherwise(spoken)
    silent = F.array(*[F.lit(0.0)] * width)

    suffixes = _sums(sure.where("suffix IS NOT NULL"), ["suffix"], width).withColumnRenamed("mass", "suffix_mass")
    hosts = _sums(sure.where("host IS NOT NULL"), ["host"], width).withColumnRenamed("mass", "host_mass")
    suffixes, hosts = keep(suffixes, "suffixes"), keep(hosts, "hosts")
    joined = rows.join(broadcast_within(suffixes, suffixes.count(), 100_000), "suffix", "left").join(broadcast_within(hosts, hosts.count(), 100_000), "host", "left")
    own = F.when(F.col("n_grams") > 0, F.col("posterior")).otherwise(silent)

    def others(name: str) -> Column:
        return F.coalesce(F.zip_with(name, own, lambda m, p: F.greatest(m - p, F.lit(0.0))), silent)

    prior = _smoothed(others("host_mass"), _smoothed(others("suffix_mass"), overall, options.strength), options.strength)
    fused = F.zip_with(F.zip_with("likelihood", F.coalesce(spoken, silent), lambda a, b: a + b), "prior", lambda a, p: a + F.log(p))
    judged = joined.withColumn("prior", prior).withColumn("fused", _softmax(fused)).withColumn("probability", F.array_max("fused"))
    best = F.element_at(names, F.array_position("fused", F.col("probability")).cast("int"))
    text_best = F.element_at(names, F.array_position("posterior", F.array_max("posterior")).cast("int"))
    sure_enough = (F.col("n_grams") > 0) & (F.col("probability") >= options.least)
    return judged.select(
        "doc_id",
        F.when(sure_enough, best).otherwise(UNKNOWN).alias("language"),
        "probability",
        F.when(F.col("n_grams") > 0, text_best).otherwise(UNKNOWN).alias("text_language"),
        "n_grams",
        *carry,
    )


def document_evidence(docs: DataFrame) -> DataFrame:
    """Evidence of ``documents``: the declared language and the source as host."""
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").alias("declared"), F.lit(None).cast("string").alias("suffix"), F.col("source").alias("host"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """Evidence of raw pages: visible text, ``<html lang>``, the host and its last label."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&\w+;", " ")
    declared = F.nullif(F.regexp_extract(html, r"(?i)<html[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1), F.lit(""))
    host = F.nullif(F.regexp_extract(F.col("url"), r"(?i)^[a-z]+://(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit(""))
    return pages.select(F.col("page_id").alias("doc_id"), text.alias("text"), declared.alias("declared"), F.nullif(F.regexp_extract(host, r"([^.]+)$", 1), F.lit("")).alias("suffix"), host.alias("host"))
