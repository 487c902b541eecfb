"""A run against stored tables: collect, then append to the article store."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from newsloom.plans.collect import Options, collect
from newsloom.session import Staging, shuffles_removed
from newsloom.sources.store import (
    WAITING_LOG,
    current_articles,
    seen_fingerprints,
    waiting_items,
    write_articles,
    write_version,
)


def run_collect(
    spark: SparkSession,
    plan: DataFrame,
    raw_pages: DataFrame,
    root: str,
    version: int,
    options: Options,
    remember: bool = False,
    landed_only: bool = False,
    wait: bool = False,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """Collect against the tables below ``root``, append this run as ``version``, give its report.

    Tables: ``articles``, ``write_log``, ``outcomes``, ``report`` (JSON), with ``remember``
    ``seen`` and with ``wait`` ``waiting``: the items whose article page a later run may bring.
    Only versions below this one are read, so a repeated run writes the same rows.
    """
    stored = current_articles(spark, f"{root}/articles", ["article_id", "url", "fingerprint"], before=version)
    seen = seen_fingerprints(spark, f"{root}/seen", before=version) if remember else None
    if options.run_id is None:
        options = replace(options, run_id=f"{options.run_ts}/{version}")
    report = f"{root}/report/version={version}"
    with shuffles_removed(spark, plan.sparkSession), Staging(spark, compression="zstd") as staged:
        waiting = waiting_items(spark, f"{root}/waiting", version, staged) if wait else None
        result = collect(
            plan, raw_pages, options, stored, seen, staged, landed_only, waiting=waiting, earlier=earlier
        )
        if result.waiting is not None:
            write_version(result.waiting.select(*WAITING_LOG.names), f"{root}/waiting", version)
        staged.remove("rows")  # the listing's part of the items is not needed any more
        if options.components.write is None:
            write_articles(result.changes, f"{root}/articles", version)
        else:
            options.components.write(result, root, version)
        write_version(result.items, f"{root}/write_log", version)
        write_version(result.outcomes, f"{root}/outcomes", version)
        if remember:
            write_version(result.new_seen.filter("NOT fingerprint LIKE 'noop:%'"), f"{root}/seen", version)
        rows = result.report
        rows.write.mode("overwrite").json(report)
    return spark.read.schema(rows.schema).json(report)
