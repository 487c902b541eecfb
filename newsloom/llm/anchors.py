"""Exact repeats of word windows by fixed-block anchors.

The reference side holds only non-overlapping blocks: the ones at multiples of ``block`` words
of every document. A window of ``2 * block`` words always contains a whole block of its own
document, and wherever its words appear again, a rolling window of that document equals the
block. So all rolling windows probe the blocks, hits are extended to full windows, and the
earliest place of every window decides what is removed; overlapping windows form the maximal
repeats.

Hashes travel in byte planes, one row per task slice and hash bucket. Equal hashes of a slice
are combined first: a passage in a third of all documents sends one entry per slice.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.tables import broadcast_within, texts_by_id
from newsloom.llm.words import Slice, mix, slices, window_hashes
from newsloom.session import Staging

BUCKET_BYTES = 16_000_000  # text per hash bucket: about 2 million probes, 16 MB of planes
LEAST_BUCKETS = 64
_OTHER = np.uint64(0x8EBC6AF09C88C6E3)
_PLANES = "bucket int, known boolean, ids binary, refs binary, low binary, high binary, keys binary, anchors binary"


@dataclass(frozen=True)
class RepeatOptions:
    """Windows of ``window`` words; blocks of half of that are always whole inside one."""

    window: int = 20

    @property
    def block(self) -> int:
        return (self.window + 1) // 2


@dataclass
class _Entries:
    """Places in the documents of a slice: a document's row, a word position and a key."""

    ids: np.ndarray
    refs: np.ndarray
    places: np.ndarray
    keys: np.ndarray
    anchors: np.ndarray
    buckets: np.ndarray

    def row(self, bucket: int, known: bool, chosen: np.ndarray | slice) -> tuple:
        """The chosen entries as one row; only documents that occur are listed."""
        used, refs = np.unique(self.refs[chosen], return_inverse=True)
        places = self.places[chosen].astype(np.uint32)
        return (
            bucket,
            known,
            self.ids[used].tobytes(),
            refs.astype(np.uint16).tobytes(),
            (places & 0xFFFF).astype(np.uint16).tobytes(),
            (places >> 16).astype(np.uint16).tobytes(),
            b"" if known else self.keys[chosen].tobytes(),
            b"" if known else np.packbits(self.anchors[chosen]).tobytes(),
        )


def _rows(entries: _Entries, known: np.ndarray, sent: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Known places in one row; the sent ones, which are in bucket order, in one row per bucket."""
    rows = []
    if len(known):
        rows.append(entries.row(zlib.crc32(entries.ids.tobytes()) % buckets, True, known))
    cuts = np.searchsorted(entries.buckets[sent], np.arange(buckets + 1))
    for bucket in np.flatnonzero(np.diff(cuts)):
        rows.append(entries.row(int(bucket), False, sent[cuts[bucket] : cuts[bucket + 1]]))
    kinds = [pa.int32(), pa.bool_()] + [pa.binary()] * 6
    names = [x.split()[0] for x in _PLANES.split(", ")]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds], names=names)


def _bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets from the upper half of a hash, ascending with it."""
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _owners(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Document row and position of every word of a slice."""
    counts = np.diff(part.bounds)
    owner = np.repeat(np.arange(len(part)), counts)
    return owner, np.arange(len(part.hashes)) - part.bounds[:-1][owner]


def _probing(options: RepeatOptions, buckets: int):
    """Rolling windows of one block's length, blocks marked as anchors."""
    size, window = options.block, options.window

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for part in slices(batch.column(1)):
                owner, place = _owners(part)
                rolling = window_hashes(part.hashes, size)
                counts = np.diff(part.bounds)[owner]
                inside = np.flatnonzero((place + size <= counts)[: len(rolling)] & (counts >= window)[: len(rolling)])
                order = inside[np.argsort(rolling[inside], kind="stable")]
                hashes = rolling[order]
                entries = _Entries(
                    ids[part.first : part.first + len(part)],
                    owner[order],
                    place[order],
                    (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32),
                    place[order] % size == 0,
                    _bucket_of(hashes, buckets),
                )
                fresh = np.ones(len(hashes), dtype=bool)
                fresh[1:] = hashes[1:] != hashes[:-1]
                sent = np.flatnonzero(fresh)
                runs = np.diff(np.append(sent, len(hashes)))
                if len(sent):  # a run is an anchor if any of its places is one
                    entries.anchors[sent] = np.logical_or.reduceat(entries.anchors, sent)
                yield _rows(entries, np.flatnonzero(np.repeat(runs > 1, runs)), sent, buckets)

    return run


def _unpacked(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, list[dict]]:
    """All documents' ids and, per row, its planes with document numbers of the whole group."""
    ids, parts, first = [], [], 0
    for row in rows.to_pylist():
        own = np.frombuffer(row["ids"], dtype=np.int64)
        refs = np.frombuffer(row["refs"], dtype=np.uint16).astype(np.int64) + first
        place = np.frombuffer(row["low"], dtype=np.uint16).astype(np.int64)
        place = place + (np.frombuffer(row["high"], dtype=np.uint16).astype(np.int64) << 16)
        parts.append(row | {"refs": refs, "places": place})
        ids.append(own)
        first += len(own)
    return np.concatenate(ids), np.array([p["known"] for p in parts]), parts


def _places(ids: np.ndarray, places: np.ndarray) -> pa.Table:
    """One row per document with its sorted places."""
    order = np.lexsort((places, ids))
    ids, places = ids[order], places[order]
    heads = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, dtype=np.int64)
    cuts = pa.array(np.append(heads, len(ids)), pa.int32())
    return pa.table({"doc_id": pa.array(ids[heads], pa.int64()), "places": pa.ListArray.from_arrays(cuts, pa.array(places, pa.int32()))})


def _matching(key_type: type, decide: Callable):
    """Reduce one bucket: known places pass, ``decide`` picks among the places of equal keys."""

    def run(rows: pa.Table) -> pa.Table:
        ids, known, parts = _unpacked(rows)
        found_ids = [ids[p["refs"]] for p in parts if p["known"]]
        found_places = [p["places"] for p in parts if p["known"]]
        sent = [p for p in parts if not p["known"]]
        if sent:
            keys = np.concatenate([np.frombuffer(p["keys"], dtype=key_type) for p in sent])
            docs = ids[np.concatenate([p["refs"] for p in sent])]
            places = np.concatenate([p["places"] for p in sent])
            anchors = np.concatenate([np.unpackbits(np.frombuffer(p["anchors"], dtype=np.uint8), count=len(p["places"])) for p in sent])
            order = np.argsort(keys, kind="stable")
            keys, docs, places, anchors = keys[order], docs[order], places[order], anchors[order]
            heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            chosen = decide(docs, places, anchors.astype(bool), heads, np.diff(np.append(heads, len(keys))))
            found_ids.append(docs[chosen])
            found_places.append(places[chosen])
        return _places(np.concatenate(found_ids), np.concatenate(found_places))

    return run


def _hit(docs, places, anchors, heads, runs) -> np.ndarray:
    """Places whose key occurs again and is a block somewhere."""
    return np.repeat((runs > 1) & np.logical_or.reduceat(anchors, heads), runs)


def _later(docs, places, anchors, heads, runs) -> np.ndarray:
    """Places behind the earliest one of their key."""
    group = np.repeat(np.arange(len(heads)), runs)
    order = np.lexsort((places, docs, group))
    least = order[heads]
    chosen = (docs != docs[least][group]) | (places != places[least][group])
    return chosen


def _extending(options: RepeatOptions, buckets: int):
    """Full windows around the hits of every document; the earliest of a slice goes on."""
    window, size = options.window, options.block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            hits = batch.column(2)
            for part in slices(batch.column(1)):
                owner, place = _owners(part)
                marks = np.zeros(len(part.hashes) + 1, dtype=np.int64)
                mine = hits.slice(part.first, len(part))
                rows = np.repeat(np.arange(len(part)), np.diff(mine.offsets.to_numpy()))
                spots = mine.flatten().to_numpy().astype(np.int64)
                last = np.diff(part.bounds)[rows] - window
                low, high = np.maximum(spots - (window - size), 0), np.minimum(spots, last)
                good = low <= high
                np.add.at(marks, part.bounds[rows[good]] + low[good], 1)
                np.add.at(marks, part.bounds[rows[good]] + high[good] + 1, -1)
                at = np.flatnonzero(np.cumsum(marks)[:-1] > 0)
                keys = window_hashes(part.hashes, window)[at]
                second = window_hashes(mix(part.hashes ^ _OTHER), window)[at]
                docs = ids[part.first : part.first + len(part)]
                order = np.lexsort((place[at], docs[owner[at]], keys, _bucket_of(second, buckets)))
                at, keys, second = at[order], keys[order], second[order]
                entries = _Entries(docs, owner[at], place[at], keys, np.zeros(len(at), dtype=bool), _bucket_of(second, buckets))
                fresh = np.ones(len(at), dtype=bool)
                fresh[1:] = (keys[1:] != keys[:-1]) | (entries.buckets[1:] != entries.buckets[:-1])
                sent = np.flatnonzero(fresh)
                head = np.repeat(sent, np.diff(np.append(sent, len(at))))
                same = (docs[entries.refs] == docs[entries.refs[head]]) & (entries.places == entries.places[head])
                yield _rows(entries, np.flatnonzero(~same), sent, buckets)

    return run


def _keeping(options: RepeatOptions, with_places: bool):
    """Take the covered words out; runs of them are the maximal repeats."""
    window = options.window
    span = pa.struct([("begin", pa.int32()), ("finish", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, spans, kept = [], [], []
            starts = batch.column(2).to_pylist() if with_places else itertools.repeat(None)
            for text, places in zip(batch.column(1).to_pylist(), starts):
                words = (text or "").encode().split()  # bytes.split() knows exactly the six separators
                counts.append(len(words))
                own = []
                if places:
                    marks = np.zeros(len(words) + 1, dtype=np.int64)
                    at = np.unique(np.array(places, dtype=np.int64))
                    np.add.at(marks, at, 1)
                    np.add.at(marks, at + window, -1)
                    covered = np.cumsum(marks)[:-1] > 0
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.view(np.int8), [0]])))
                    own = [{"begin": int(a), "finish": int(b)} for a, b in edges.reshape(-1, 2)]
                    words = itertools.compress(words, (~covered).tolist())
                spans.append(own)
                kept.append(b" ".join(words).decode())
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(kept, pa.string())],
                names=["doc_id", "n_words", "repeats", "text"],
            )

    return run


def _gathered(df: DataFrame) -> DataFrame:
    return df.groupBy("doc_id").agg(F.flatten(F.collect_list("places")).alias("places"))


def without_repeats(
    docs: DataFrame, options: RepeatOptions | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, n_words, repeats, text`` for every row of ``docs``.

    A window of ``options.window`` consecutive words is a repeat if the same words also start
    earlier: in a document with a smaller id, or earlier in the same one. ``repeats`` holds the
    maximal runs of words (``begin`` to ``finish``, exclusive) that repeats cover, ``text`` the
    other words joined by one space. Everything is judged on the input.

    Null and empty texts have no words and an empty text. Documents shorter than a window never
    change. Rows that repeat an id are one place: they do not count as earlier than each other.
    A row without an id is returned without removals and supports none. An empty table gives no
    rows. Other columns of ``docs`` are not read. The result reads staged tables in the folder
    named by ``spark.checkpoint.dir``.
    """
    options = options or RepeatOptions()
    texts = texts_by_id(docs, id_column, text_column)
    spark = texts.sparkSession
    keep = Staging(spark)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    out = "doc_id long, places array<int>"

    known = texts.where("doc_id IS NOT NULL")
    probes = known.mapInArrow(_probing(options, buckets), _PLANES)
    hits = keep(probes.groupBy("bucket").applyInArrow(_matching(np.uint32, _hit), out), "hits")
    touched = keep(hits.select("doc_id").distinct(), "touched")
    few = broadcast_within(touched, touched.count())
    near = keep(known.join(few, "doc_id", "left_semi").join(_gathered(hits), "doc_id"), "near")

    windows = near.mapInArrow(_extending(options, buckets), _PLANES)
    later = keep(windows.groupBy("bucket").applyInArrow(_matching(np.uint64, _later), out), "later")
    schema = "doc_id long, n_words long, repeats array<struct<begin: int, finish: int>>, text string"
    changed = near.select("doc_id", "text").join(_gathered(later), "doc_id", "left").mapInArrow(_keeping(options, True), schema)
    same = texts.join(few, "doc_id", "left_anti").mapInArrow(_keeping(options, False), schema)
    return same.union(changed)
