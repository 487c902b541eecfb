"""Packing of tokenized documents into training windows by non-negative least squares.

Documents become pieces of at most one window. The number of pieces of every length is a
histogram of at most ``window`` bins, whatever the corpus size. Shallow combinations of lengths
that fill a window are the columns of a matrix; non-negative repeat counts that reproduce the
histogram best are found by least squares, rounded down, and what is left is packed greedily,
each greedy pattern repeated as often as its lengths allow. Pieces are then dealt to the planned
slots by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.tables import texts_by_id
from newsloom.llm.tokens import WordTokens
from newsloom.session import Staging, stage

CLOSING_ID = 2


@dataclass(frozen=True)
class PackOptions:
    """``window`` tokens a sequence; combinations of up to four pieces; ``sweeps`` of the solver."""

    window: int = 4096
    tokenizer: str = ""
    parts: int = 4
    per_length: int = 12
    sweeps: int = 30


# tokens -> pieces ------------------------------------------------------------------------
def _cutting(options: PackOptions):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens.of(options.tokenizer)
        closing = np.uint32(CLOSING_ID).tobytes()
        width = 4 * options.window
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), tokens.encode(batch.column(1).to_pylist())):
                ids += closing
                total = len(ids) // 4
                for low in range(0, len(ids), width):
                    piece = ids[low : low + width]
                    rows.append((doc_id, low // 4, len(piece) // 4, zlib.crc32(piece), total))
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)], names=names)

    return run


def pieces(texts: DataFrame, options: PackOptions) -> DataFrame:
    """Pieces of at most one window: full ones from the start, then the rest of the document."""
    return texts.mapInArrow(_cutting(options), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


# histogram -> plan -----------------------------------------------------------------------
def combinations(counts: np.ndarray, options: PackOptions) -> list[tuple[int, ...]]:
    """Shallow sets of present lengths that fill the window, or as nearly as lengths allow.

    A single full length, and for every length its repeats plus partners: the largest present
    length that fits, and some spread over the range, each completed the same way.
    """
    window = options.window
    present = np.flatnonzero(counts)
    found: set[tuple[int, ...]] = set()
    if not len(present):
        return []

    def largest(room: int) -> int:
        at = np.searchsorted(present, room, side="right") - 1
        return int(present[at]) if at >= 0 else 0

    for length in present[::-1].tolist():
        if length == window:
            found.add((window,))
            continue
        room = window - length
        fitting = present[: np.searchsorted(present, room, side="right")]
        if not len(fitting):
            continue
        picks = {int(fitting[-1])} | {int(x) for x in fitting[np.linspace(0, len(fitting) - 1, options.per_length).astype(int)]}
        for second in picks:
            chosen, left = [length, second], room - second
            while left and len(chosen) < options.parts and (more := largest(left)):
                chosen.append(more)
                left -= more
            if left <= window // 512:
                found.add(tuple(sorted(chosen, reverse=True)))
    return sorted(found, reverse=True)


def non_negative_least_squares(columns: list[tuple[int, ...]], counts: np.ndarray, sweeps: int) -> np.ndarray:
    """Repeat counts ``x >= 0`` that minimise ``|A x - counts|``, by cyclic coordinate descent."""
    rest = counts.astype(float).copy()
    x = np.zeros(len(columns))
    shapes = []
    for column in columns:
        lengths, times = np.unique(column, return_counts=True)
        shapes.append((lengths, times.astype(float), float((times**2).sum())))
    for _ in range(sweeps):
        moved = 0.0
        for j, (lengths, times, norm) in enumerate(shapes):
            step = max(-x[j], float(times @ rest[lengths]) / norm)
            if abs(step) > 1e-9:
                x[j] += step
                rest[lengths] -= step * times
                moved = max(moved, abs(step))
        if moved < 0.5:
            break
    return x


def plan(counts: np.ndarray, options: PackOptions) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how often each is used; together they use every piece exactly once."""
    columns = combinations(counts, options)
    left = counts.astype(np.int64).copy()
    patterns = []
    solved = np.floor(non_negative_least_squares(columns, counts, options.sweeps) + 1e-6).astype(np.int64)
    for j in np.argsort(-solved, kind="stable"):
        lengths, times = np.unique(columns[j], return_counts=True)
        repeat = int(min(solved[j], (left[lengths] // times).min()))
        if repeat > 0:
            left[lengths] -= repeat * times
            patterns.append((columns[j], repeat))
    while len(present := np.flatnonzero(left)):
        chosen, room, stock = [], options.window, left.copy()
        while room and len(fitting := present[: np.searchsorted(present, room, side="right")]):
            available = fitting[stock[fitting] > 0]
            if not len(available):
                break
            length = int(available[-1])
            take = int(min(stock[length], room // length))
            chosen += [length] * take
            stock[length] -= take
            room -= take * length
        lengths, times = np.unique(chosen, return_counts=True)
        repeat = int((left[lengths] // times).min())
        left[lengths] -= repeat * times
        patterns.append((tuple(chosen), repeat))
    return patterns


# plan -> pieces --------------------------------------------------------------------------
def _slots(patterns: list[tuple[tuple[int, ...], int]]) -> pd.DataFrame:
    """Per length, ranges of ranks: rank ``low + i`` goes to sequence ``sequence + i`` at ``offset``."""
    rows, taken, sequence = [], {}, 0
    for lengths, repeat in patterns:
        offset = 0
        for length in lengths:
            rows.append((length, taken.get(length, 0), sequence, offset))
            taken[length] = taken.get(length, 0) + repeat
            offset += length
        sequence += repeat
    return pd.DataFrame(rows, columns=["length", "low", "sequence", "offset"]).sort_values(["length", "low"])


def _dealing(slots: pd.DataFrame):
    stride = 1 << 40
    edges = (slots["length"] * stride + slots["low"]).to_numpy()
    low, sequence, offset = (slots[c].to_numpy() for c in ("low", "sequence", "offset"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rank = frame.pop("rank").to_numpy()
            at = np.searchsorted(edges, frame["length"].to_numpy() * stride + rank, side="right") - 1
            frame["sequence_id"] = sequence[at] + rank - low[at]
            frame["offset"] = offset[at]
            yield frame

    return run


def packed(docs: DataFrame, options: PackOptions, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every piece of every document with its sequence and offset.

    Columns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``. A document's
    ids end with :data:`CLOSING_ID`, so null and empty texts have one token. Sequences hold at
    most ``options.window`` tokens; offsets have no gaps. Repeated rows and rows without an id
    are packed like any other row. An empty table gives no rows. Other columns are not read.

    Only the histogram (at most ``window`` numbers) reaches the driver. Ranks come from counts
    per length and salt, so a length that holds a third of all pieces is ranked by many tasks.
    """
    spark = docs.sparkSession
    with Staging(spark) as keep:
        found = keep(pieces(texts_by_id(docs, id_column, text_column), options), "pieces")
        salts = max(32, int(spark.conf.get("spark.sql.shuffle.partitions")))
        found = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)))
        shares = keep(found.groupBy("length", "salt").agg(F.count("*").alias("rows")), "shares")
        counts = np.zeros(options.window + 1, dtype=np.int64)
        for length, rows in shares.groupBy("length").agg(F.sum("rows")).collect():
            counts[length] = rows
        slots = _slots(plan(counts, options))
        before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
        base = shares.select("length", "salt", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
        inside = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")
        ranked = (
            found.withColumn("place", F.row_number().over(inside) - 1)
            .join(base, ["length", "salt"])
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("place")).alias("rank"))
        )
        schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
        return stage(ranked.mapInPandas(_dealing(slots), schema), "packed")
