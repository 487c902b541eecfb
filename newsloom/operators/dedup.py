"""Ordered first-wins dedup without windows over hot keys.

The winner of a key is found by ``min`` of the row's order, which pre-aggregates before the
shuffle, so a key that holds a third of all rows costs one partial row per task. Losers are then
told apart by joining the winners back on the order itself, a unique and evenly spread key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unique order of an item within a run.
ORDER = ("portal_idx", "page_index", "position")


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER) -> DataFrame:
    """One row per key: the order columns of its first row, and the keys."""
    first = df.groupBy(*keys).agg(F.min(pack_order(df, order)).alias("_first"))
    own = [key for key in keys if key not in order]
    return first.select(*own, *unpack_order(F.col("_first"), df, order))


_BITS = {"tinyint": 31, "smallint": 31, "int": 31, "bigint": 63}


def _widths(df: DataFrame, order: Sequence[str]) -> list[int] | None:
    """Bits of every order column if all but the last fit 63 bits together, else None."""
    bits = [_BITS.get(df.schema[name].dataType.simpleString()) for name in order]
    return bits if None not in bits and sum(bits[:-1]) <= 63 else None


def _counted(name: str) -> Column:
    number = F.col(name).cast("long")
    return F.when(number >= 0, number).when(number < 0, F.raise_error(F.lit(f"negative order column {name}")).cast("long"))


def pack_order(df: DataFrame, order: Sequence[str] = ORDER) -> Column:
    """The order columns as one value that sorts the same way.

    ``min`` over a struct needs a sorting aggregate. Whole numbers from 0 on, up to the largest
    of their type, are packed into one long and, beyond 63 bits, one decimal instead, which keeps
    aggregation hash based. Columns of other types, or wider together, stay a struct. A negative
    number ends the job.
    """
    bits = _widths(df, order)
    if bits is None:
        return F.struct(*order)
    head, used = _counted(order[0]), bits[0]
    for name, width in zip(order[1:-1], bits[1:-1], strict=True):
        head, used = F.shiftleft(head, width).bitwiseOR(_counted(name)), used + width
    if len(order) == 1:
        return head
    if used + bits[-1] <= 63:
        return F.shiftleft(head, bits[-1]).bitwiseOR(_counted(order[-1]))
    wide = "decimal(38,0)"
    shifted = (head.cast("decimal(19,0)") * F.lit(str(1 << bits[-1])).cast("decimal(19,0)")).cast(wide)
    return (shifted + _counted(order[-1]).cast("decimal(19,0)")).cast(wide)


def unpack_order(packed: Column, df: DataFrame, order: Sequence[str] = ORDER) -> list[Column]:
    """The order columns that :func:`pack_order` packed, in their types."""
    bits = _widths(df, order)
    kind = lambda name: df.schema[name].dataType
    if bits is None:
        return [packed[name].alias(name) for name in order]
    found, head, width = [], packed, bits[-1]
    if len(order) > 1 and sum(bits) > 63:
        size = F.lit(str(1 << width)).cast("decimal(19,0)")
        found.append((packed % size).cast(kind(order[-1])).alias(order[-1]))
        head = F.call_function("div", packed, size)
    elif len(order) > 1:
        found.append(packed.bitwiseAND(F.lit((1 << width) - 1)).cast(kind(order[-1])).alias(order[-1]))
        head = F.shiftright(packed, width)
    for name, width in zip(reversed(order[1:-1]), reversed(bits[1:-1]), strict=True):
        found.append(head.bitwiseAND(F.lit((1 << width) - 1)).cast(kind(name)).alias(name))
        head = F.shiftright(head, width)
    return [head.cast(kind(order[0])).alias(order[0]), *reversed(found)]


def mark_first(
    df: DataFrame, keys: Sequence[str], flag: str, order: Sequence[str] = ORDER, where: Column | None = None
) -> DataFrame:
    """Add a boolean ``flag``: the row is the first of its key among the rows ``where`` holds.

    ``order`` must identify a row. Null keys group together, as in ``groupBy``.
    """
    candidates = df if where is None else df.filter(where)
    winners = first_rows(candidates, keys, order).select(*order, F.lit(True).alias("_won"))
    joined = df.join(winners, list(order), "left")
    won = F.coalesce(F.col("_won"), F.lit(False))
    return joined.withColumn(flag, won if where is None else won & where).drop("_won")


def url_winners(items: DataFrame) -> DataFrame:
    """Order of the first item per (portal, url)."""
    return first_rows(items, ["portal_idx", "url"]).select(*ORDER)


def fingerprint_winners(items: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Order of the first item per (portal, fingerprint) that the seen store does not hold.

    The store is probed with one row per fingerprint, so copies never meet it.
    """
    first = first_rows(items, ["portal_idx", "fingerprint"])
    if seen is not None:
        first = first.join(seen.select("fingerprint"), "fingerprint", "left_anti")
    return first.select(*ORDER)


def dedup_url(items: DataFrame) -> DataFrame:
    """Keep the first item per portal and url."""
    return items.join(url_winners(items), list(ORDER), "left_semi")


def dedup_fingerprint(items: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Keep the first item per portal and fingerprint that is new to the seen store."""
    return items.join(fingerprint_winners(items, seen), list(ORDER), "left_semi")


def new_fingerprints(items: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Distinct fingerprints to append to the seen store."""
    fresh = items.select("fingerprint").distinct()
    return fresh if seen is None else fresh.join(seen.select("fingerprint"), "fingerprint", "left_anti")
