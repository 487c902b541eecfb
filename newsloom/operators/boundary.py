"""Item numbering and the page error boundary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK = 4096


def running_offset(counts: DataFrame, keys: Sequence[str], pos: str, count: str, block: int = BLOCK) -> DataFrame:
    """Add ``offset``: the sum of ``count`` over the rows of the same keys with a smaller ``pos``.

    Prefix sums in two levels, so a key with very many rows is never one window: blocks of
    ``block`` positions are summed first, and only the block totals are accumulated per key.
    """
    blocked = counts.withColumn("_block", F.floor(F.col(pos) / block).cast("long"))
    inner = W.partitionBy(*keys, "_block").orderBy(pos).rowsBetween(W.unboundedPreceding, -1)
    outer = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    totals = (
        blocked.groupBy(*keys, "_block")
        .agg(F.sum(count).alias("_total"))
        .withColumn("_before", F.coalesce(F.sum("_total").over(outer), F.lit(0)))
        .drop("_total")
    )
    within = blocked.withColumn("_within", F.coalesce(F.sum(count).over(inner), F.lit(0)))
    joined = within.join(totals, [*keys, "_block"])
    return joined.withColumn("offset", F.col("_before") + F.col("_within")).drop("_block", "_before", "_within")


def page_status(pages: DataFrame, failed_pages: DataFrame, on_error: str) -> DataFrame:
    """Add ``page_state`` to pages.

    With ``abort`` the first failing page of a portal is an ``error`` and ends that portal: it
    yields nothing and the later pages are ``not_run``. With ``skip`` a failing page is
    ``skipped``: it loses the requests that failed, and the portal goes on. Others are ``fetched``.
    """
    if on_error == "skip":
        lost = failed_pages.select("portal_idx", "page_index", F.lit("skipped").alias("page_state")).distinct()
        joined = pages.join(lost, ["portal_idx", "page_index"], "left")
        return joined.withColumn("page_state", F.coalesce("page_state", F.lit("fetched")))
    if on_error != "abort":
        raise ValueError("on_error must be 'abort' or 'skip'")
    first = failed_pages.groupBy("portal_idx").agg(F.min("page_index").alias("abort_page"))
    state = (
        F.when(F.col("abort_page").isNull() | (F.col("page_index") < F.col("abort_page")), F.lit("fetched"))
        .when(F.col("page_index") == F.col("abort_page"), F.lit("error"))
        .otherwise(F.lit("not_run"))
    )
    return pages.join(first, "portal_idx", "left").withColumn("page_state", state).drop("abort_page")
