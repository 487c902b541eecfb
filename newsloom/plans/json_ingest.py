"""JSON listing -> fields by selector -> simply normalized articles."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.metadata import has_key, merge_maps
from newsloom.operators.extract import extract_fields, missing_fields
from newsloom.operators.normalize import simple_normalize
from newsloom.functions.text import DEFAULT_TITLE
from newsloom.sources.json_listing import listing_items
from newsloom.sources.landed import PARSE_ERROR

REQUIRED = ("title", "body")


def parse_fields(
    items: DataFrame, selectors: dict[str, str], required: tuple[str, ...] = REQUIRED
) -> DataFrame:
    """Raw articles from listing items: a field that is missing overwrites metadata with null,
    a required one that is missing or empty gives ``error_kind='parse'``."""
    found = items.withColumn("fields", extract_fields(F.col("content"), selectors))
    missing = missing_fields(F.col("fields"), required)
    value = lambda key: F.try_element_at(F.col("fields"), F.lit(key))
    extra = F.map_filter("fields", lambda key, _: ~key.isin("title", "body"))
    metadata = merge_maps(F.col("metadata"), extra)
    bad = F.col("fields").isNull() | (F.size(missing) > 0)
    kept = [c for c in items.columns if c not in ("content", "metadata")]
    return found.select(
        *kept,
        value("title").alias("title"),
        F.coalesce(value("body"), F.lit("")).alias("body"),
        metadata.alias("metadata"),
        missing.alias("missing"),
        F.when(bad, F.lit(PARSE_ERROR)).alias("parse_error"),
    )


def ingest_json_listing(
    payloads: DataFrame,
    selectors: dict[str, str],
    run_ts: datetime | str,
    item_key: str = "items",
    required: tuple[str, ...] = REQUIRED,
    default_tags: Iterable[str] = (),
    fallback_title: str = DEFAULT_TITLE,
) -> DataFrame:
    """Normalized rows of every listing item; ``error_kind`` is ``parse``, ``normalize`` or null.

    Tags given as text are not a list, so the default applies to them.
    """
    raw = parse_fields(listing_items(payloads, item_key), selectors, required)
    listed = F.from_json(F.try_element_at("metadata", F.lit("tags")), "array<string>")
    is_list = F.try_element_at("metadata", F.lit("tags")).startswith("[")
    raw = raw.withColumn("tags", F.when(is_list, listed)).withColumn(
        "published_at",
        F.when(has_key(F.col("metadata"), "published_at"), F.try_element_at("metadata", F.lit("published_at"))),
    )
    rows = simple_normalize(raw.drop("missing"), run_ts, default_tags, fallback_title)
    error = F.coalesce("parse_error", "error_kind")
    return rows.withColumn("error_kind", error).drop("parse_error")
