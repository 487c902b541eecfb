"""Selection of stored articles to process again, and writing them back in place.

The store is partitioned by source and day. A request names an article, or a source and days; it
is turned into the partitions it concerns, so a join with these few rows prunes the scan, and
only the partitions with reprocessed rows are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.session import Staging

PARTITION = ("source", "day")


def write_store(articles: DataFrame, path: str) -> None:
    """Write ``articles`` (with ``source`` and the date ``day``) in partitions of both."""
    articles.repartition(*PARTITION, F.pmod(F.xxhash64("article_id"), F.lit(4))).write.partitionBy(*PARTITION).parquet(path)


def read_store(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def requested_days(requests: DataFrame) -> DataFrame:
    """The partitions of the requests ``source, date_from, date_to`` (both days included)."""
    days = F.explode(F.sequence(F.col("date_from"), F.col("date_to")))
    fine = requests.where("source IS NOT NULL AND date_from <= date_to")
    return fine.select("source", days.alias("day")).distinct()


def selected(store: DataFrame, days: DataFrame | None = None, articles: DataFrame | None = None) -> DataFrame:
    """Stored rows to process again: those of whole partitions, and single ones.

    ``days`` has ``source, day``. ``articles`` has ``article_id`` and, as ids alone say nothing
    about partitions, also ``source, day``.
    """
    found = []
    if days is not None:
        found.append(store.join(F.broadcast(days.select(*PARTITION)), list(PARTITION), "left_semi"))
    if articles is not None:
        wanted = articles.select(*PARTITION, "article_id").distinct()
        rest = store if days is None else store.join(F.broadcast(days.select(*PARTITION)), list(PARTITION), "left_anti")
        near = rest.join(F.broadcast(wanted.select(*PARTITION).distinct()), list(PARTITION), "left_semi")
        found.append(near.join(wanted, [*PARTITION, "article_id"], "left_semi"))
    if not found:
        return store.limit(0)
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def write_back(store: DataFrame, path: str, done: DataFrame) -> int:
    """Replace the rows of ``done`` in the store at ``path``; returns the partitions written.

    ``done`` keeps ``article_id, source, day``. Rows of its partitions that it does not hold are
    kept. The new partitions are written beside the store first, as they are read from it; then
    each replaces its partition, so a repeated call ends in the same store.
    """
    spark = store.sparkSession
    with Staging(spark) as keep:
        done = keep(done.select(*store.columns), "done")
        touched = keep(done.select(*PARTITION).distinct(), "touched")
        near = store.join(F.broadcast(touched), list(PARTITION), "left_semi")
        kept = near.join(done.select(*PARTITION, "article_id"), [*PARTITION, "article_id"], "left_anti")
        fresh = keep(kept.unionByName(done), "fresh")
        split = F.pmod(F.xxhash64("article_id"), F.lit(4))
        writer = fresh.repartition(*PARTITION, split).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*PARTITION).parquet(path)
        return touched.count()
