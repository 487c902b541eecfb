"""Near duplicates by SetSketch registers.

Every distinct shingle starts a Poisson process; its points fall on registers at random and a
register keeps the earliest point of any shingle. That is an exponential minimum, so registers
of two sets merge by taking the earlier one, and the share of equal registers follows the
Jaccard similarity. A shingle's points come in ascending order (exponential spacing) and are
cut off once they lie behind every register, so a document costs about ``n + m ln m`` points
instead of ``n * m``. Registers hold the truncated logarithm of the minimum.

Bands of registers give candidates; the joint maximum-likelihood estimate of the similarity
discards the hopeless ones; what remains is decided on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.operators.components import Keep, components
from newsloom.llm.tables import broadcast_within, texts_by_id
from newsloom.llm.words import list_array, mix, shingles, slices
from newsloom.session import Staging, stage

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xE7037ED1A0B428DB)
_MASK = np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class SketchOptions:
    """``threshold`` is ``percent / 100``; two sets link with ``100 * common >= percent * union``.

    With ``rows`` registers a band and ``bands`` bands a linked pair is missed with probability
    ``(1 - threshold ** rows) ** bands``: 2e-7 at 0.85 and 2e-5 at 0.8. ``margin`` is five
    standard deviations of the estimate.
    """

    words: int = 5
    percent: int = 80
    rows: int = 7
    bands: int = 48
    base: float = 1.02
    scale: float = 1 / 64
    margin: float = 0.12

    @property
    def registers(self) -> int:
        return self.rows * self.bands


CONTRACT = SketchOptions(words=3, percent=85)
SHARE = 500  # rows of one shingle that meet their partners in one place
SLICE_BYTES = 1 << 19  # text whose words and points a worker holds at a time
TOP = 2**12 - 2  # registers are truncated to 0 ... TOP + 1


def earliest_points(values: np.ndarray, owner: np.ndarray, sets: int, registers: int) -> np.ndarray:
    """Earliest point per set and register; ``owner`` names the set of each value."""
    best = np.full(sets * registers, np.inf)
    state, at, own = values, np.zeros(len(values)), owner.astype(np.int64)
    done, check = 0, 1
    while len(own):
        state = state + _GOLD
        drawn = mix(state)
        at = at - np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / registers
        register = ((mix(drawn ^ _OTHER) & _MASK) * np.uint64(registers)) >> np.uint64(32)
        np.minimum.at(best, own * registers + register.astype(np.int64), at)
        done += 1
        if done >= check:
            latest = np.zeros(sets)
            active = np.unique(own)
            latest[active] = best.reshape(sets, registers)[active].max(axis=1)
            live = at < latest[own]
            state, at, own = state[live], at[live], own[live]
            check = done + max(1, done // 6)
    return best.reshape(sets, registers)


def truncated(points: np.ndarray, options: SketchOptions) -> np.ndarray:
    """Register values: the truncated logarithm of the minima; an empty set has zeros."""
    with np.errstate(divide="ignore"):
        level = np.floor(1 - np.log(points * options.scale) / np.log(options.base))
    return np.clip(level, 0, TOP + 1).astype(np.uint16)


def merge(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(first, second)


def band_keys(registers: np.ndarray, options: SketchOptions) -> np.ndarray:
    """One key per band; the band's number is part of it."""
    cut = registers.reshape(len(registers), options.bands, options.rows).astype(np.uint64)
    keys = np.tile(np.arange(1, options.bands + 1, dtype=np.uint64) * _OTHER, (len(registers), 1))
    for j in range(options.rows):
        keys = mix(keys + cut[:, :, j] * _GOLD + np.uint64(j + 1))
    return keys


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, base: float) -> np.ndarray:
    """Joint maximum-likelihood estimate of the Jaccard similarity of pairs of register rows.

    Registers of the first set are larger, smaller or equal with probabilities that depend on
    the similarity and on the two known sizes; the likelihood of the three counts is evaluated
    on a grid.
    """
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    same = a.shape[1] - more - less
    share = (n_a / (n_a + n_b))[:, None]
    most = np.minimum(share / (1 - share), (1 - share) / share)
    grid = np.linspace(0, 1, 129)[None, :] * most

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (base - 1) / base) / np.log(base)

    up, down = chance(share - (1 - share) * grid), chance((1 - share) - share * grid)
    tiny = 1e-12
    score = more * np.log(up + tiny) + less * np.log(down + tiny) + same * np.log(np.maximum(1 - up - down, tiny))
    return np.take_along_axis(grid, score.argmax(axis=1)[:, None], axis=1)[:, 0]


def _sketcher(options: SketchOptions):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for part in slices(batch.column(1), lower=True, size=SLICE_BYTES):
                values, bounds = shingles(part, options.words)
                sizes = np.diff(bounds)
                owner = np.repeat(np.arange(len(part)), sizes)
                registers = truncated(earliest_points(values, owner, len(part), options.registers), options)
                filled = np.flatnonzero(sizes)
                keys = band_keys(registers[filled], options)
                key_bounds = np.concatenate([[0], np.cumsum(np.where(sizes > 0, options.bands, 0))])
                digest = np.zeros(len(part), dtype=np.uint64)
                if len(filled):
                    digest[filled] = np.add.reduceat(mix(values ^ _OTHER), bounds[:-1][filled])
                first = np.zeros(len(part), dtype=np.uint64)
                first[filled] = values[bounds[:-1][filled]]
                yield pa.record_batch(
                    [
                        ids.slice(part.first, len(part)),
                        pa.array(sizes, pa.int64()),
                        pa.array(digest.view(np.int64)),
                        pa.array(first.view(np.int64)),
                        list_array(keys.ravel(), key_bounds),
                        pa.array([row.tobytes() for row in registers], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "digest", "least", "keys", "registers"],
                )

    return run


def sketches(texts: DataFrame, options: SketchOptions) -> DataFrame:
    """Per document: set size, digest of the set, band keys and registers."""
    schema = "doc_id long, n_shingles long, digest long, least long, keys array<long>, registers binary"
    return texts.mapInArrow(_sketcher(options), schema)


def _setter(options: SketchOptions):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1), lower=True, size=SLICE_BYTES):
                values, bounds = shingles(part, options.words)
                yield pa.record_batch(
                    [batch.column(0).slice(part.first, len(part)), list_array(values, bounds)],
                    names=["doc_id", "shingles"],
                )

    return run


def _decider(options: SketchOptions):
    floor = options.percent / 100 - options.margin

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            a = np.stack([np.frombuffer(x, dtype=np.uint16) for x in frame["registers_a"]])
            b = np.stack([np.frombuffer(x, dtype=np.uint16) for x in frame["registers_b"]])
            sizes_a, sizes_b = frame["n_a"].to_numpy(float), frame["n_b"].to_numpy(float)
            likely = np.concatenate(
                [
                    estimate(a[i : i + 256], b[i : i + 256], sizes_a[i : i + 256], sizes_b[i : i + 256], options.base)
                    for i in range(0, len(a), 256)
                ]
            )
            linked = np.zeros(len(frame), dtype=bool)
            for i in np.flatnonzero(likely >= floor):
                x, y = frame["shingles_a"].iat[i], frame["shingles_b"].iat[i]
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked[i] = 100 * common >= options.percent * (len(x) + len(y) - common)
            yield frame.loc[linked, ["a", "b"]]

    return run


def _verified(pairs: DataFrame, full: DataFrame, options: SketchOptions) -> DataFrame:
    """Pairs ``(a, b)`` that link, decided on the full sets in ``full``."""

    def side(name: str) -> DataFrame:
        return full.select(
            F.col("doc_id").alias(name),
            F.col("n_shingles").alias(f"n_{name}"),
            F.col("registers").alias(f"registers_{name}"),
            F.col("shingles").alias(f"shingles_{name}"),
        )

    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    return both.mapInPandas(_decider(options), "a long, b long")


def _close_in_size(a: str, b: str, options: SketchOptions):
    """A pair whose sizes differ too much cannot reach the threshold."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * options.percent


def near_duplicates(
    docs: DataFrame, options: SketchOptions = CONTRACT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Words are separated by space and the bytes 9 to 13, A-Z are lowered. The component is the
    smallest ``doc_id`` that links reach; ``kept`` marks it.

    1. Documents with equal sets are one class; its smallest id stands for it.
    2. In every band bucket each member is compared with the bucket's smallest one: as many
       pairs as members, however large the bucket.
    3. Members of buckets that still hold several components meet again on their rarest
       shingles (:func:`_prefix_pairs`), so no link is lost and a group of copies is never
       expanded into all its pairs.

    Null and empty texts have no words: an empty set, linked with nothing, kept. Rows that
    repeat an id are one document and share its result. A row without an id stays, alone. An
    empty table gives no rows. Other columns of ``docs`` are not read.
    """
    texts = texts_by_id(docs, id_column, text_column)
    with Staging(texts.sparkSession) as keep:
        found = keep(sketches(texts, options), "sketches")
        classes = found.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("n_shingles", "digest", "least")
        classes = keep(classes.agg(F.min("doc_id").alias("rep")), "classes")
        members = found.where("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", "n_shingles", "digest", "least")
        members = keep(members.join(classes, ["n_shingles", "digest", "least"]).select("doc_id", "rep").distinct(), "members")
        links = keep(_links(found, members, texts, options, keep), "links")
        copies = members.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
        groups = components(links.select("a", "b").union(copies), keep)
        labelled = (
            found.select("doc_id", "n_shingles")
            .join(groups.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        )
        return stage(labelled.withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))), "near")


def _links(found: DataFrame, members: DataFrame, texts: DataFrame, options: SketchOptions, keep: Keep) -> DataFrame:
    """Links between class representatives: enough of them to connect every component."""
    reps = members.where("doc_id = rep").select("doc_id")
    rows = found.select("doc_id", "n_shingles", F.explode("keys").alias("key")).join(reps, "doc_id", "left_semi")
    shared = rows.groupBy("key").agg(F.min("doc_id").alias("centre"), F.max("doc_id").alias("last")).where("centre < last")
    buckets = keep(rows.join(shared.select("key", "centre"), "key"), "buckets")
    sizes = buckets.select("doc_id", "n_shingles").distinct()
    stars = buckets.where("doc_id <> centre").select(F.col("centre").alias("a"), F.col("doc_id").alias("b"), F.col("n_shingles").alias("n_b")).distinct()
    stars = stars.join(sizes.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("n_a")), "a")
    pairs = keep(stars.where(_close_in_size("n_a", "n_b", options)).select("a", "b"), "pairs")

    wanted = keep(sizes.select("doc_id").distinct(), "wanted")
    some = texts.join(broadcast_within(wanted, wanted.count()), "doc_id", "left_semi")
    sets = some.mapInArrow(_setter(options), "doc_id long, shingles array<long>").dropDuplicates(["doc_id"])
    kinds = found.select("doc_id", "n_shingles", "registers").join(reps, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    full = keep(sets.join(kinds, "doc_id"), "full")

    links = keep(_verified(pairs, full, options), "links")
    joined = components(links, keep)
    open_rows = (
        buckets.join(joined.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
        .withColumn("component", F.coalesce("component", "doc_id"))
    )
    split = open_rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    split = split.where("low < high").select("key")
    left_open = keep(open_rows.join(split, "key", "left_semi").select("doc_id", "component").distinct(), "open")
    rest = keep(_prefix_pairs(left_open, full, options, keep), "rest")
    return links.union(_verified(rest, full, options))


def _prefix_pairs(members: DataFrame, full: DataFrame, options: SketchOptions, keep: Keep) -> DataFrame:
    """Pairs of ``members`` in different components that can still link.

    A filter on the sets that loses no link: with shingles in one order, rarest first, two
    sets that link share one among the first ``n - ceil(t n) + 1`` of each, and at the first
    shared one enough of both sets must still follow. Edits make rare shingles, which come
    first, so the many copies of one text do not meet on its common shingles. Per shingle only
    members outside its most frequent component look for partners. A frequent shingle's rows
    are dealt into shares of about :data:`SHARE`, each of which meets every searching member.
    """
    percent = options.percent
    each = full.join(members, "doc_id").select(
        "doc_id", "component", "n_shingles", F.explode("shingles").alias("shingle")
    )
    # staged, so that joins on frequent shingles can be split
    spread = keep(each.groupBy("shingle").agg(F.count("*").alias("documents")).where("documents > 1"), "spread")
    order = Window.partitionBy("doc_id").orderBy("documents", "shingle")
    first = (
        each.join(spread, "shingle", "left")
        .withColumn("documents", F.coalesce("documents", F.lit(1)))
        .withColumn("place", F.row_number().over(order) - 1)
        .where(F.col("place") <= F.col("n_shingles") - F.ceil(F.col("n_shingles") * percent / 100))
        .where("documents > 1")
    )
    first = keep(first.drop("documents"), "prefixes")
    counts = first.groupBy("shingle", "component").agg(F.count("*").alias("rows"))
    main = counts.groupBy("shingle").agg(
        F.max_by("component", F.struct("rows", "component")).alias("main"),
        F.count("*").alias("kinds"),
        F.ceil(F.sum("rows") / SHARE).cast("int").alias("shares"),
    )
    main = keep(main.where("kinds > 1").drop("kinds"), "main")
    first = first.join(broadcast_within(main, main.count()), "shingle")
    seeking = first.where("component <> main").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    dealt = first.withColumn("share", F.pmod(F.xxhash64("doc_id"), F.col("shares")).cast("int"))
    need = (F.col("l.n_shingles") + F.col("r.n_shingles")) * percent / (100 + percent)
    follow = F.least(F.col("l.n_shingles") - F.col("l.place"), F.col("r.n_shingles") - F.col("r.place"))
    return (
        seeking.alias("l")
        .join(dealt.alias("r"), (F.col("l.shingle") == F.col("r.shingle")) & (F.col("l.share") == F.col("r.share")))
        .where("l.component <> r.component")
        .where(_close_in_size("l.n_shingles", "r.n_shingles", options))
        .where(follow + 1e-6 >= need)
        .select(F.least("l.doc_id", "r.doc_id").alias("a"), F.greatest("l.doc_id", "r.doc_id").alias("b"))
        .distinct()
    )
