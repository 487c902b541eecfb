"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Most rows of narrow keys that may be broadcast: 4 million longs are about 100 MB as a hash
# relation. Every use counts its rows first and has a shuffled join beyond the bound.
BROADCAST_ROWS = 4_000_000


def broadcast_within(df: DataFrame, rows: int, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if its counted ``rows`` are within ``bound``."""
    return F.broadcast(df) if rows <= bound else df


def texts_by_id(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only ``doc_id, text``: other columns, whatever their names, stay outside the operator."""
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))


def fraction_key(*columns: Column) -> Column:
    """A fixed pseudo-random order of rows, the same in every run."""
    return F.xxhash64(*columns)


def sampled(rows: DataFrame, size: int) -> DataFrame:
    """At most ``size`` rows with different ``doc_id``, taken in the order of a hash of the id.

    Ids are chosen first, on that column alone; other columns move for the chosen ids only. Of
    rows that share an id, the one with the smallest hash of its other columns is taken.
    """
    ids = rows.where("doc_id IS NOT NULL").select("doc_id").distinct()
    few = ids.orderBy(fraction_key(F.col("doc_id")), "doc_id").limit(size)
    rest = [c for c in rows.columns if c != "doc_id"]
    row = F.struct(fraction_key(*map(F.col, rest)).alias("key"), *rest)
    found = rows.join(F.broadcast(few), "doc_id").groupBy("doc_id").agg(F.min(row).alias("row"))  # bounded by size
    return found.select("doc_id", *[F.col(f"row.{c}").alias(c) for c in rest])
