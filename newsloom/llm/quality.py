"""Text quality by a factorisation machine.

A text is a sparse vector: hashed words, statistics of its structure, and numeric metadata. The
machine adds a linear part and all pairwise interactions at low rank; with the sum-of-squares
identity a text is scored in time linear in its distinct words. It is trained here, on a bounded
sample of labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.words import Slice, slices

LOOKS = 12  # structure statistics
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True


@dataclass(frozen=True)
class FmOptions:
    """``sample`` bounds the labelled rows that training reads, ``bits`` the hashed words."""

    bits: int = 13
    rank: int = 4
    sample: int = 6000
    epochs: int = 12
    rate: float = 0.03
    decay: float = 1e-4
    metadata: tuple[str, ...] = ("n_chars",)

    @property
    def width(self) -> int:
        return (1 << self.bits) + LOOKS + len(self.metadata)


@dataclass
class Machine:
    """Weights of a factorisation machine over ``width`` features."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margin(self, index: np.ndarray, value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Scores of sparse rows: ``w x + (|sum v x|^2 - sum |v x|^2) / 2``."""
        parts = self.factors[index] * value[:, None]
        columns = np.concatenate([(self.linear[index] * value - 0.5 * (parts**2).sum(axis=1))[:, None], parts], axis=1)
        sums = np.add.reduceat(columns, bounds[:-1], axis=0)
        return self.bias + sums[:, 0] + 0.5 * (sums[:, 1:] ** 2).sum(axis=1)


def structure(part: Slice) -> np.ndarray:
    """Statistics of each document's bytes and words, most of them shares."""
    size = np.diff(part.offsets)
    counts = np.diff(part.bounds)

    def per_document(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return total[bounds[1:]] - total[bounds[:-1]]

    letters = per_document(_LETTER[part.data], part.offsets)
    upper = per_document(_UPPER[part.data], part.offsets)
    digits = per_document(_DIGIT[part.data], part.offsets)
    lines = per_document(part.data == 10, part.offsets)
    ends = part.ends - 1
    odd = per_document(~(_LETTER | _DIGIT)[part.data[ends]] & (part.data[ends] != 46) & (part.data[ends] != 44), part.bounds)
    symbols = per_document(~(_LETTER | _DIGIT)[part.data[part.starts]], part.bounds)
    long = per_document(part.ends - part.starts > 24, part.bounds)
    again = np.zeros(len(part.hashes), dtype=bool)
    again[1:] = part.hashes[1:] == part.hashes[:-1]
    repeats = per_document(again, part.bounds)
    owner = np.repeat(np.arange(len(part)), counts)
    order = np.lexsort((part.hashes, owner))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (part.hashes[order][1:] != part.hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    distinct = np.bincount(owner[order][fresh], minlength=len(part))
    n, chars = np.maximum(counts, 1), np.maximum(size, 1)
    return np.stack(
        [
            letters / chars,
            upper / np.maximum(letters, 1),
            digits / chars,
            np.minimum(lines / n, 1),
            odd / n,
            symbols / n,
            long / n,
            repeats / n,
            distinct / np.maximum(counts, 1) ** 0.9,
            np.log1p(counts) / 8,
            np.minimum(size / n / 16, 4),
            (counts == 0).astype(float),
        ],
        axis=1,
    )


def features(part: Slice, metadata: np.ndarray, options: FmOptions) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows: indexes, values and bounds. Word counts are damped and of unit length."""
    rows, buckets = len(part), 1 << options.bits
    owner = np.repeat(np.arange(rows), np.diff(part.bounds))
    keys = owner * buckets + (part.hashes >> np.uint64(64 - options.bits)).astype(np.int64)
    keys, times = np.unique(keys, return_counts=True)
    value = np.log1p(times)
    norm = np.sqrt(np.bincount(keys // buckets, value**2, rows))
    value = value / norm[keys // buckets]
    dense = np.concatenate([structure(part), metadata], axis=1)
    wide = options.width
    place = np.concatenate([(keys // buckets) * wide + keys % buckets, (np.arange(rows)[:, None] * wide + buckets + np.arange(dense.shape[1])).ravel()])
    value = np.concatenate([value, dense.ravel()])
    order = np.argsort(place, kind="stable")
    place = place[order]
    return place % wide, value[order], np.searchsorted(place, np.arange(rows + 1) * wide)


def train(index: np.ndarray, value: np.ndarray, bounds: np.ndarray, target: np.ndarray, options: FmOptions) -> Machine:
    """Logistic loss with Adam on small batches; the same sample gives the same machine."""
    rng = np.random.default_rng(11)
    share = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    wide = options.width
    table = np.concatenate([np.zeros((wide, 1)), rng.normal(0, 0.05, (wide, options.rank))], axis=1)
    first, second = np.zeros_like(table), np.zeros_like(table)
    bias, step = float(np.log(share / (1 - share))), 0
    for _ in range(options.epochs):
        order = rng.permutation(len(target))
        for low in range(0, len(order), 128):
            rows = order[low : low + 128]
            sizes = bounds[rows + 1] - bounds[rows]
            cut = np.concatenate([[0], np.cumsum(sizes)])
            at = np.repeat(bounds[rows] - cut[:-1], sizes) + np.arange(cut[-1])
            i, x = index[at], value[at]
            owner = np.repeat(np.arange(len(rows)), sizes)
            machine = Machine(bias, table[:, 0], table[:, 1:])
            error = 1 / (1 + np.exp(-np.clip(machine.margin(i, x, cut), -30, 30))) - target[rows]
            parts = table[i, 1:] * x[:, None]
            sums = np.add.reduceat(parts, cut[:-1], axis=0)
            slope = np.concatenate([x[:, None], x[:, None] * (sums[owner] - parts)], axis=1) * (error[owner] / len(rows))[:, None]
            used, back = np.unique(i, return_inverse=True)
            gradient = np.zeros((len(used), table.shape[1]))
            np.add.at(gradient, back, slope)
            gradient += options.decay * table[used]
            step += 1
            first[used] = 0.9 * first[used] + 0.1 * gradient
            second[used] = 0.99 * second[used] + 0.01 * gradient**2
            table[used] -= options.rate * (first[used] / (1 - 0.9**step)) / (np.sqrt(second[used] / (1 - 0.99**step)) + 1e-6)
            bias -= options.rate * float(error.mean())
    return Machine(bias, table[:, 0].copy(), table[:, 1:].copy())


def _rows(docs: DataFrame, options: FmOptions, id_column: str, text_column: str) -> DataFrame:
    metadata = [F.log1p(F.greatest(F.coalesce(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0))) / 10 for c in options.metadata]
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"), *[m.alias(f"m{i}") for i, m in enumerate(metadata)])


def _metadata(batch: pa.RecordBatch, options: FmOptions) -> np.ndarray:
    columns = [batch.column(2 + i).to_numpy(zero_copy_only=False) for i in range(len(options.metadata))]
    return np.stack(columns, axis=1) if columns else np.zeros((batch.num_rows, 0))


def fit(
    docs: DataFrame, labels: DataFrame, usable: Column, options: FmOptions, id_column: str = "doc_id", text_column: str = "text", label: str = "quality"
) -> Machine:
    """Train on at most ``options.sample`` labelled rows for which ``usable`` holds.

    Rows are taken in the order of a hash of their id. A row with several labels has the
    smallest. Without labels of both classes the machine knows only the share of ones.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull() & usable)
    known = known.groupBy(F.col(id_column).cast("long").alias("doc_id")).agg(F.min(label).cast("int").alias("target"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(options.sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            metadata = _metadata(batch, options)
            for part in slices(batch.column(1)):
                index, value, bounds = features(part, metadata[part.first : part.first + len(part)], options)
                cuts = pa.array(bounds, pa.int32())
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(part.first, len(part)),
                        batch.column("target").slice(part.first, len(part)),
                        pa.ListArray.from_arrays(cuts, pa.array(index, pa.int32())),
                        pa.ListArray.from_arrays(cuts, pa.array(value, pa.float32())),
                    ],
                    names=["doc_id", "target", "index", "value"],
                )

    rows = _rows(docs, options, id_column, text_column).join(F.broadcast(known), "doc_id")  # bounded by options.sample
    rows = rows.select("doc_id", "text", *[f"m{i}" for i in range(len(options.metadata))], "target")
    found = rows.mapInArrow(run, "doc_id long, target int, index array<int>, value array<float>").toArrow().sort_by("doc_id")
    target = found.column("target").to_numpy().astype(float)
    if len(target) == 0 or target.min() == target.max():
        share = float(np.clip(target.mean() if len(target) else 0.5, 0.01, 0.99))
        return Machine(float(np.log(share / (1 - share))), np.zeros(options.width), np.zeros((options.width, options.rank)))
    lists = found.column("index").combine_chunks()
    value = found.column("value").combine_chunks().flatten().to_numpy().astype(float)
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    return train(lists.flatten().to_numpy(), value, bounds, target, options)


def scored(docs: DataFrame, machine: Machine, options: FmOptions, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, score`` for every row of ``docs``; higher means label 1 is likelier.

    Null and empty texts are scored by their structure and metadata; null metadata counts as
    0. Rows with a null or repeated id are scored like any other. An empty table gives no rows.
    Only the id, the text and ``options.metadata`` are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            metadata = _metadata(batch, options)
            for part in slices(batch.column(1)):
                index, value, bounds = features(part, metadata[part.first : part.first + len(part)], options)
                score = 1 / (1 + np.exp(-np.clip(machine.margin(index, value, bounds), -30, 30)))
                yield pa.record_batch([batch.column(0).slice(part.first, len(part)), pa.array(score)], names=["doc_id", "score"])

    return _rows(docs, options, id_column, text_column).mapInArrow(run, "doc_id long, score double")
