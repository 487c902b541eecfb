"""Benchmark passages in documents: SimHash windows, Hamming blocks, exact verification.

All of it is DataFrame functions. A window has as many words as the benchmark item it is held
against. To reach the threshold, a window must hold enough places whose five-word shingle is in
the item. Among those, moving a window by one place to the left loses nothing unless the place
before it is no hit or its shingle occurs again, so only windows behind such a place (or at the
start of the text) are fingerprinted: the best window is one of them, however the passage was
edited, and their number follows the passages found instead of the text times the item sizes.

A fingerprint is the 64-bit SimHash of the window's shingles, each as often as it occurs.
Windows and items meet in ``radius + 1`` blocks of bits: within the radius at least one block
is equal. At similarity 0.8 the distance has mean 9.7 and deviation 2.9, so a radius of 22
covers it but for about one pair in 10^5 right at the threshold. The blocks thus filter windows
that shingles found. The weighted similarity of the shingles then decides exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.tables import broadcast_within, texts_by_id
from newsloom.session import Staging

BITS = 64
_WORD_GAP = r"[^\p{L}\p{N}]+"


@dataclass(frozen=True)
class MatchOptions:
    """``words`` a shingle, ``threshold`` of the weighted similarity, Hamming ``radius``."""

    words: int = 5
    threshold: float = 0.8
    radius: int = 22


def _shingles(text: Column, words: int) -> Column:
    """Hashes of all runs of ``words`` words in order; shorter texts are one run."""
    found = F.array_remove(F.split(F.lower(text), _WORD_GAP), "")

    def runs(tokens: Column) -> Column:
        long = F.transform(F.sequence(F.lit(1), F.size(tokens) - (words - 1)), lambda i: F.xxhash64(F.slice(tokens, i, words)))
        return F.when(F.size(tokens) >= words, long).when(F.size(tokens) > 0, F.array(F.xxhash64(tokens)))

    # the one-element array gives the words a name, so that they are split once a row
    return F.coalesce(F.element_at(F.transform(F.array(found), runs), 1), F.array().cast("array<long>"))


def fingerprint(shingles: Column) -> Column:
    """SimHash: a bit is set if more shingle occurrences have it than not."""

    def bit(b: Column) -> Column:
        votes = F.aggregate(shingles, F.lit(0), lambda total, h: total + F.call_function("getbit", h, b).cast("int") * 2 - 1)
        return F.when(votes > 0, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

    bits = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), bit)
    return F.aggregate(bits, F.lit(0).cast("long"), lambda total, x: total.bitwiseOR(x))


def blocks(mark: Column, radius: int) -> Column:
    """``(block, value)`` pairs: ``radius + 1`` blocks of nearly equal width."""
    count = radius + 1
    edges = [BITS * i // count for i in range(count + 1)]
    return F.array(
        *[
            F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(mark, low).bitwiseAND(F.lit((1 << (high - low)) - 1)).alias("value"))
            for i, (low, high) in enumerate(zip(edges, edges[1:]))
        ]
    )


def _weighted(shingles: Column) -> Column:
    """Occurrences told apart, so that set operations respect how often a shingle occurs."""
    return F.transform(shingles, lambda h, i: F.xxhash64(h, F.size(F.filter(F.slice(shingles, F.lit(1), i), lambda x: x == h))))


def _starts(least: float) -> Column:
    """Starts of the windows of ``shingles`` that can be the best one for ``sought``.

    ``spots`` has the places of the document that hold a shingle of the item, in order, and
    whether that shingle occurs ``again``. A window that reaches ``least`` covers ``needed`` of
    them; the first one it covers decides for which starts. A start right behind a hit is left
    out, as the window one place earlier is no worse, unless that hit may count for nothing.
    """
    length, size = F.size("sought"), F.size("shingles")
    room = F.greatest(size - length, F.lit(0))
    needed = F.ceil((F.least(size, length) + length) * F.lit(least / (1 + least)) - 1e-9).cast("int")
    own = F.filter("spots", lambda s: F.array_contains(F.col("sought"), F.get(F.col("shingles"), s["place"])))
    none = F.array().cast("array<int>")

    def ranges(spots: Column) -> Column:
        def of_first(i: Column) -> Column:
            before = F.get(spots, i - 1)
            behind = F.coalesce(before["place"] + F.when(before["again"], 1).otherwise(2), F.lit(0))
            low = F.greatest(behind, F.get(spots, i + needed - 1)["place"] - length + 1, F.lit(0))
            high = F.least(F.get(spots, i)["place"], room)
            return F.when(low <= high, F.sequence(low, high)).otherwise(none)

        firsts = F.sequence(F.lit(0), F.size(spots) - needed)
        return F.when(F.size(spots) >= needed, F.flatten(F.transform(firsts, of_first))).otherwise(none)

    # the one-element array gives the row's own spots a name, so that they are filtered once
    return F.element_at(F.transform(F.array(own), ranges), 1)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    options: MatchOptions | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
) -> DataFrame:
    """``doc_id, contaminated, n_items, item_id, similarity`` for every row of ``docs``.

    A document is contaminated by an item if a window of it, as long as the item (or the whole
    document, if that is shorter), reaches the threshold. ``n_items`` counts such items; the
    best one, smallest id first among equals, is named with its similarity, or null and 0.

    Case, punctuation and line breaks do not matter. Null and empty texts on either side match
    nothing; an item or text under five words is one shingle. Repeated items count once per id.
    Rows that repeat a document id share one result; a row without an id is never
    contaminated. Empty tables are allowed. Other columns are not read.
    """
    options = options or MatchOptions()
    texts = texts_by_id(docs, id_column, text_column)
    keep = Staging(texts.sparkSession)
    least = options.threshold

    items = texts_by_id(benchmark, item_column, text_column).where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"])
    items = items.select(F.col("doc_id").alias("item_id"), _shingles(F.col("text"), options.words).alias("sought"))
    items = keep(items.where(F.size("sought") > 0), "items")
    each = keep(items.select("item_id", F.posexplode("sought").alias("item_place", "shingle")), "each")

    found = texts.where("doc_id IS NOT NULL").select("doc_id", _shingles(F.col("text"), options.words).alias("shingles"))
    places = found.select("doc_id", F.posexplode("shingles").alias("place", "shingle"))
    hits = keep(places.join(broadcast_within(each, each.count()), "shingle").select("doc_id", "item_id", "shingle", "place", "item_place"), "hits")

    enough = hits.groupBy("doc_id", "item_id").agg(F.size(F.collect_set("item_place")).alias("common"))
    enough = enough.join(items.select("item_id", F.size("sought").alias("length")).groupBy("item_id").agg(F.min("length").alias("length")), "item_id")
    enough = enough.where(F.col("common") >= F.col("length") * least).select("doc_id", "item_id")
    spots = hits.join(enough, ["doc_id", "item_id"]).groupBy("doc_id", "item_id", "shingle").agg(F.collect_set("place").alias("places"))
    spot = F.transform("places", lambda p: F.struct(p.alias("place"), (F.size("places") > 1).alias("again")))
    spots = spots.select("doc_id", "item_id", F.inline(spot)).groupBy("doc_id", "item_id")
    spots = keep(spots.agg(F.sort_array(F.collect_list(F.struct("place", "again"))).alias("spots")), "spots")

    wanted = keep(spots.select("doc_id").distinct(), "wanted")
    some = found.join(broadcast_within(wanted, wanted.count()), "doc_id", "left_semi")
    lined = spots.join(items, "item_id").join(some, "doc_id")
    windows = F.transform(
        _starts(least), lambda s: F.struct(s.alias("start"), F.slice("shingles", s + 1, F.size("sought")).alias("window"))
    )
    windows = lined.select("doc_id", "item_id", "sought", F.explode(windows).alias("at")).select(
        "doc_id", "item_id", "at.start", "at.window", "sought"
    )
    marked = keep(windows.withColumn("mark", fingerprint(F.col("window"))), "windows")

    def blocked(df: DataFrame, *columns: str) -> DataFrame:
        return df.select(*columns, "mark", F.inline(blocks(F.col("mark"), options.radius)))

    sought = items.select("item_id", fingerprint(F.col("sought")).alias("mark"))
    sought = blocked(sought, "item_id").withColumnRenamed("mark", "item_mark")
    near = (
        blocked(marked, "doc_id", "item_id", "start")
        .join(sought, ["item_id", "block", "value"])
        .where(F.bit_count(F.col("mark").bitwiseXOR(F.col("item_mark"))) <= options.radius)
        .select("doc_id", "item_id", "start")
        .distinct()
    )
    checked = marked.join(near, ["doc_id", "item_id", "start"]).select(
        "doc_id", "item_id", _weighted(F.col("window")).alias("x"), _weighted(F.col("sought")).alias("y")
    )
    common = F.size(F.array_intersect("x", "y"))
    checked = checked.withColumn("similarity", common / (F.size("x") + F.size("y") - common)).where(F.col("similarity") >= least)
    per_item = checked.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"))
    best = keep(
        per_item.groupBy("doc_id").agg(
            F.count("*").alias("n_items"),
            F.min_by("item_id", F.struct(-F.col("similarity"), F.col("item_id"))).alias("item_id"),
            F.max("similarity").alias("similarity"),
        ),
        "best",
    )
    return texts.select("doc_id").join(best, "doc_id", "left").select(
        "doc_id",
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        "item_id",
        F.coalesce("similarity", F.lit(0.0)).alias("similarity"),
    )
