"""Article search over an inverted term table, page by page without sorting what comes before.

Postings are written in partitions by a hash of the term, so a search reads only those of its
terms. A page begins behind the last article of the page before (newest first, then by id), so
every page is one bounded top-k over narrow rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.text import fold

BUCKETS = 64
_WORD = r"([\p{L}\p{N}]+)"
NEVER = datetime(1600, 1, 1)  # stands for articles without a date, which come last; none is older


def terms_of(text: Column) -> Column:
    """The distinct folded words of a text; null has none."""
    return F.array_distinct(F.regexp_extract_all(fold(F.coalesce(text, F.lit(""))), F.lit(_WORD), F.lit(1)))


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(term), F.lit(buckets)).cast("int")


def write_postings(articles: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Write ``term, article_id`` of ``articles`` (``article_id, text``), in partitions by term.

    A partition is spread over several files, so a frequent term needs no single task.
    """
    rows = articles.select("article_id", F.explode(terms_of(F.col("text"))).alias("term"))
    keyed = rows.withColumn("bucket", _bucket(F.col("term"), buckets))
    spread = F.pmod(F.xxhash64("article_id"), F.lit(8))
    keyed.repartition("bucket", spread).write.partitionBy("bucket").mode("errorifexists").parquet(path)


@dataclass(frozen=True)
class Search:
    """All conditions hold together: all words of ``text``, one of ``sources``, dates from
    ``date_from`` up to but not including ``date_to``, all of ``entities``, with or without
    any mention (``mentioned``). An empty condition does not restrict."""

    text: str = ""
    sources: Sequence[str] = ()
    date_from: datetime | None = None
    date_to: datetime | None = None
    entities: Sequence[object] = ()
    mentioned: bool | None = None


@dataclass(frozen=True)
class Place:
    """The last article of a page: where the next one begins."""

    published_at: datetime
    article_id: object


def _with_all(rows: DataFrame, key: str, wanted: Sequence[object]) -> DataFrame:
    """Articles that have every wanted value; partial counts keep a frequent value spread."""
    found = rows.where(F.col(key).isin(list(wanted))).select("article_id", key).distinct()
    return found.groupBy("article_id").agg(F.count("*").alias("n")).where(F.col("n") == len(set(wanted))).select("article_id")


def matches(articles: DataFrame, search: Search, postings: DataFrame | None = None, mentions: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The rows of ``articles`` (``article_id, source, published_at`` and others) that match."""
    found = articles
    if search.sources:
        found = found.where(F.col("source").isin(list(search.sources)))
    if search.date_from is not None:
        found = found.where(F.col("published_at") >= F.lit(search.date_from))
    if search.date_to is not None:
        found = found.where(F.col("published_at") < F.lit(search.date_to))
    if search.text.strip():
        words = articles.sparkSession.range(1).select(F.explode(terms_of(F.lit(search.text))).alias("t"), _bucket(F.col("t"), buckets).alias("b")).collect()
        if not words:
            return found.limit(0)  # nothing but punctuation
        near = postings.where(F.col("bucket").isin(sorted({w.b for w in words})))
        found = found.join(_with_all(near, "term", [w.t for w in words]), "article_id", "left_semi")
    if search.entities:
        found = found.join(_with_all(mentions, "entity_id", search.entities), "article_id", "left_semi")
    if search.mentioned is not None:
        kind = "left_semi" if search.mentioned else "left_anti"
        found = found.join(mentions.select("article_id").distinct(), "article_id", kind)
    return found


def page(found: DataFrame, size: int, after: Place | None = None) -> DataFrame:
    """The next ``size`` rows, newest first, then by falling id; rows without a date last."""
    date = F.coalesce("published_at", F.lit(NEVER))
    if after is not None:
        found = found.where((date < F.lit(after.published_at)) | ((date == F.lit(after.published_at)) & (F.col("article_id") < F.lit(after.article_id))))
    return found.orderBy(date.desc(), F.col("article_id").desc()).limit(size)


def end_of(rows: DataFrame) -> Place | None:
    """The place behind a page; null behind an empty one."""
    date = F.coalesce("published_at", F.lit(NEVER))
    last = rows.agg(F.min(F.struct(date.alias("date"), "article_id")).alias("last")).first().last
    return None if last is None else Place(last.date, last.article_id)


def open_postings(spark: SparkSession, path: str, id_type: str) -> DataFrame:
    return spark.read.schema(f"article_id {id_type}, term string, bucket int").parquet(path)
