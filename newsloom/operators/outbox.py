"""The outbox of ingested articles: appended once per article and pipeline version.

An event lists an article's entities in parts of bounded size. A run appends below its own
number: it leaves out what earlier runs have sent, and a run that is repeated, wholly or after a
failure, replaces its own rows by the same ones. So a replay adds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.sources.store import VERSION, read_versions, write_version

PART = 1000  # entities in one event


def ingested_events(articles: DataFrame, entities: DataFrame, pipeline_version: str, carry: Sequence[str] = (), part: int = PART) -> DataFrame:
    """``article_id, pipeline_version, part, n_parts, entities`` and the ``carry`` columns.

    ``entities`` has ``article_id, entity_id, name, uf``; repeated ones count once. They are
    numbered by id, ``part`` to an event; an article without any has one event with none.
    """
    # Repeated entities are folded first, so an article named very often is no large group; one
    # shuffle by article then serves numbering, parts and the join.
    own = entities.select("article_id", "entity_id", "name", "uf").groupBy("article_id", "entity_id").agg(F.min("name").alias("name"), F.min("uf").alias("uf"))
    article = Window.partitionBy("article_id")
    placed = own.withColumns({
        "part": F.floor((F.row_number().over(article.orderBy("entity_id")) - 1) / part).cast("int"),
        "n_parts": F.ceil(F.count("*").over(article) / part).cast("int"),
    })
    parts = placed.groupBy("article_id", "n_parts", "part").agg(F.sort_array(F.collect_list(F.struct("entity_id", "name", "uf"))).alias("entities"))
    kind = parts.schema["entities"].dataType
    heads = articles.select("article_id", *carry).dropDuplicates(["article_id"])
    rows = heads.join(parts, "article_id", "left")
    rows = rows.withColumns({"n_parts": F.coalesce("n_parts", F.lit(1)), "part": F.coalesce("part", F.lit(0))})
    return rows.select(
        "article_id", F.lit(pipeline_version).alias("pipeline_version"), "part", "n_parts",
        F.coalesce("entities", F.array().cast(kind)).alias("entities"), *carry,
    )


def append_events(events: DataFrame, path: str, run: int) -> DataFrame:
    """Append the events of articles that no earlier run has sent in their pipeline version.

    Only two narrow columns of the earlier events are read. Returns what this run has appended.
    """
    spark = events.sparkSession
    sent = read_versions(spark, path, events.schema, before=run).select("article_id", "pipeline_version").distinct()
    write_version(events.join(sent, ["article_id", "pipeline_version"], "left_anti").select(*events.columns), path, run)
    return read_events(spark, path, events.schema).where(F.col("version") == run).drop("version")


def read_events(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All events with the run (``version``) that appended them."""
    return read_versions(spark, path, schema).select(*schema.names, VERSION.name)
