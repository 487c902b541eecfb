"""Landed pages: the table that stands in for live HTTP.

A cluster keeps it bucketed by ``request_url`` (:func:`land_pages`), so that joining requests or
article links to it never shuffles the HTML. One row per ``request_url`` is expected; history
tables go through :func:`latest_pages` first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FETCH_ERROR, PARSE_ERROR = "fetch", "parse"
FEW_URLS = 500_000  # that are broadcast: they take some hundred bytes each


def land_pages(pages: DataFrame, table: str, buckets: int) -> DataFrame:
    """Write landed pages as a table bucketed and sorted by ``request_url``."""
    (
        pages.repartition(buckets, "request_url")
        .write.bucketBy(buckets, "request_url")
        .sortBy("request_url")
        .mode("errorifexists")
        .saveAsTable(table)
    )
    return pages.sparkSession.table(table)


def row_hash() -> Column:
    """Tells apart rows of one URL and time."""
    return F.xxhash64("final_url", "status_code", "html")


def latest_pages(history: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """The most recently fetched row per ``request_url``, of all or of those in ``wanted``.

    Rows of a URL that was landed once stay where they are. Of the others only a hash travels in the
    grouping; copies of one URL are pre-aggregated before the shuffle and the rows are found again
    by (url, time, hash), which spreads a URL fetched very often.
    """
    history = history.where("request_url IS NOT NULL").select("request_url", *[c for c in history.columns if c != "request_url"])
    once, again = by_count(history, ["request_url"])
    pages = once
    if again is not None:
        mark = F.struct("fetched_at", row_hash().alias("row_hash"))
        marked = again.withColumn("mark", mark)
        newest = marked.groupBy("request_url").agg(F.max("mark").alias("mark"))
        kept = marked.join(newest, ["request_url", "mark"], "left_semi")
        pages = once.unionByName(kept.dropDuplicates(["request_url", "mark"]).drop("mark"))
    return pages if wanted is None else pages.join(wanted, "request_url", "left_semi")


def by_count(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """The rows whose key comes once, and those whose key comes again, or None if there are none.

    Only keys are shuffled, unless very many repeat; the keys are never null.
    """
    repeated = rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    n = repeated.count()
    if n == 0:
        return rows, None
    marked = F.broadcast(repeated) if n <= FEW_URLS else repeated
    return rows.join(marked, list(keys), "left_anti"), rows.join(marked, list(keys), "left_semi")


def fetch_failed(status_code: Column) -> Column:
    return status_code.isNull() | (status_code >= 400)


def join_pages(requests: DataFrame, raw_pages: DataFrame, url: str = "request_url", how: str = "left") -> DataFrame:
    """Join requests to their landed page; refused requests get ``error_kind='fetch'``.

    ``left`` also keeps the requests without a page, as fetch errors. ``inner`` leaves them out,
    which lets Spark broadcast a small request side instead of shuffling the HTML; callers find
    the missing ones by their order afterwards.
    """
    pages = raw_pages.select(
        F.col("request_url").alias("_landed_url"),
        F.coalesce("final_url", "request_url").alias("final_url"),
        "status_code",
        F.when(~fetch_failed(F.col("status_code")), F.coalesce("html", F.lit(""))).alias("html"),
    )
    joined = requests.join(pages, requests[url] == pages["_landed_url"], how)
    error = F.when(fetch_failed(F.col("status_code")), F.lit(FETCH_ERROR))
    return joined.withColumn("error_kind", error).drop("_landed_url", "status_code")
