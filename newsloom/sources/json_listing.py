"""JSON listings: landed payloads to listing items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.sources.landed import FETCH_ERROR, fetch_failed

OBJECT = "map<string,variant>"


def _text(value: Column) -> Column:
    """Plain text of a scalar, JSON text of anything else; JSON null becomes null."""
    return F.when(
        ~F.is_variant_null(value), F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value))
    )


def _entries(payload: Column, item_key: str) -> Column:
    """The objects of the listing; null when there is no list to read."""
    doc = F.try_parse_json(payload)
    is_object = F.schema_of_variant(doc).startswith("OBJECT")
    found = F.when(is_object, F.try_variant_get(doc, f"$['{item_key}']", "array<variant>")).otherwise(
        F.try_variant_get(doc, "$", "array<variant>")
    )
    objects = F.transform(found, lambda entry: F.try_variant_get(entry, "$", OBJECT))
    return F.filter(objects, lambda entry: entry.isNotNull())


def _url(entry: Column) -> Column:
    return _text(F.try_element_at(entry, F.lit("url")))


def read_listings(payloads: DataFrame, item_key: str = "items") -> DataFrame:
    """Payload rows with their ``entries`` and an ``error_kind``.

    A payload fails as a whole when it was refused, is not JSON, holds no list, or has an object
    without ``url``. Entries that are not objects are dropped.
    """
    entries = payloads.withColumn("entries", _entries(F.col("payload"), item_key))
    incomplete = F.exists("entries", lambda e: _url(e).isNull())
    bad = fetch_failed(F.col("status_code")) | F.col("entries").isNull() | incomplete
    error = F.when(F.coalesce(bad, F.lit(True)), F.lit(FETCH_ERROR))
    return entries.drop("payload").withColumn("error_kind", error)


def listing_items(payloads: DataFrame, item_key: str = "items") -> DataFrame:
    """One row per item: ``url``, ``content`` (default empty) and the other keys as ``metadata``."""
    good = read_listings(payloads, item_key).filter(F.col("error_kind").isNull())
    keep = [c for c in payloads.columns if c not in ("payload", "status_code")]
    rows = good.select(*keep, F.posexplode("entries").alias("item_pos", "entry"))
    entry = F.col("entry")
    others = F.map_filter(entry, lambda key, _: ~key.isin("url", "content"))
    content = F.coalesce(_text(F.try_element_at(entry, F.lit("content"))), F.lit(""))
    return rows.select(
        *keep,
        "item_pos",
        _url(entry).alias("url"),
        content.alias("content"),
        F.transform_values(others, lambda _, value: _text(value)).alias("metadata"),
    )
