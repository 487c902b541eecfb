"""Metadata maps: last-wins merge, set-default, portal name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import bind, empty_to_null


def empty_map() -> Column:
    return F.create_map().cast("map<string,string>")


def _merged(pair: Column) -> Column:
    left, right = pair["left"], pair["right"]
    kept = F.map_filter(left, lambda key, _: ~F.map_contains_key(right, key))
    return F.map_concat(kept, right)


def merge_maps(*maps: Column) -> Column:
    """Merge from left to right; a later entry wins, even when its value is null."""
    merged = F.coalesce(maps[0], empty_map())
    for later in maps[1:]:
        right = F.coalesce(later, empty_map())
        merged = bind(F.struct(merged.alias("left"), right.alias("right")), _merged)
    return merged


def has_key(metadata: Column, key: str) -> Column:
    return F.coalesce(F.map_contains_key(metadata, F.lit(key)), F.lit(False))


def _with_default(metadata: Column, key: str, value: Column, keep_null: bool) -> Column:
    def extended(pair: Column) -> Column:
        base, new = pair["base"], pair["value"]
        added = F.map_concat(base, F.create_map(F.lit(key), new))
        present = has_key(base, key) if keep_null else has_key(base, key) | new.isNull()
        return F.when(present, base).otherwise(added)

    base = F.coalesce(metadata, empty_map())
    return bind(F.struct(base.alias("base"), value.cast("string").alias("value")), extended)


def set_default(metadata: Column, key: str, value: Column) -> Column:
    """Add ``key`` unless it is present already."""
    return _with_default(metadata, key, value, keep_null=True)


def set_default_if(metadata: Column, key: str, value: Column) -> Column:
    """Like :func:`set_default`, but a null value adds nothing."""
    return _with_default(metadata, key, value, keep_null=False)


def portal_name(*maps: Column) -> Column:
    """First non-empty ``portal_name`` of the maps, else the empty string."""
    found = [empty_to_null(F.try_element_at(m, F.lit("portal_name"))) for m in maps]
    return F.coalesce(*found, F.lit(""))
