"""Words, shingles and their 64-bit hashes for whole Arrow batches.

Inside a task a batch of texts is one byte buffer; everything here works on that buffer with
numpy, so the cost per document is small. Work is done in slices of at most ``SLICE_BYTES``
(or one longer document), which bounds memory however large a batch is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Word separators of the contracts: space and the bytes 9 to 13.
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SLICE_BYTES = 1 << 22
SLICE_ROWS = 1 << 16  # document numbers of a slice fit 16 bits

_IS_SEPARATOR = np.zeros(256, dtype=bool)
_IS_SEPARATOR[list(SEPARATORS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)
_WORD_BASE = np.uint64(0xD6E8FEB86659FD93)
_SHINGLE_BASE = np.uint64(0xA0761D6478BD642F)
_EMPTY = np.zeros(0, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64: every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_POWERS = np.ones(1, dtype=np.uint64)


def _powers(base: np.uint64, count: int) -> np.ndarray:
    powers = np.full(max(count, 1), base, dtype=np.uint64)
    powers[0] = 1
    return np.cumprod(powers, dtype=np.uint64)


@dataclass
class Slice:
    """Some documents of a batch: ``first`` is the batch row of the first one.

    ``starts`` and ``ends`` are byte positions of the words in ``data``, ``hashes`` their
    hashes, and document ``i`` owns the words ``bounds[i]:bounds[i + 1]``.
    """

    first: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null is empty."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or offsets is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return flat[at[0] : at[-1]], at - at[0]


def slices(texts: pa.Array, lower: bool = False, hashed: bool = True, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a batch into slices of at most ``size`` bytes, or one longer document, and find their words."""
    data, offsets = buffers(texts)
    first = 0
    while first < len(offsets) - 1:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), first + SLICE_ROWS, len(offsets) - 1)
        part = data[offsets[first] : offsets[last]]
        yield _slice(first, _LOWER[part] if lower else part, offsets[first : last + 1] - offsets[first], hashed)
        first = last


def _slice(first: int, data: np.ndarray, offsets: np.ndarray, hashed: bool) -> Slice:
    gap = _IS_SEPARATOR[data]
    begins = ~gap
    begins[1:] &= gap[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = ~gap[edges]  # a word never reaches into the next document
    closes = ~gap
    closes[:-1] &= gap[1:]
    closes[edges - 1] = ~gap[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    bounds = np.searchsorted(starts, offsets)
    hashes = _word_hashes(data, gap, starts, ends) if hashed else _EMPTY
    return Slice(first, data, offsets, starts, ends, bounds, hashes)


def _word_hashes(data: np.ndarray, gap: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return _EMPTY
    place = np.arange(len(data), dtype=np.int64)
    place[: starts[0]] = 0
    place[starts[0] :] -= np.repeat(starts, np.diff(np.append(starts, len(data))))
    place[gap] = 0
    lengths = ends - starts
    values = _BYTE_CODE[data]
    values *= _powers(_WORD_BASE, int(lengths.max()))[place]
    values[gap] = 0
    return mix(np.add.reduceat(values, starts) + lengths.astype(np.uint64) * _STEP)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` hashes; run ``i`` begins at ``i``."""
    count = len(hashes) - size + 1
    if count <= 0:
        return _EMPTY
    total = np.zeros(count, dtype=np.uint64)
    for j, power in enumerate(_powers(_SHINGLE_BASE, size)):
        total += hashes[j : j + count] * power
    return mix(total + np.full(1, size, dtype=np.uint64) * _STEP)


def shingles(part: Slice, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted ``size``-word shingles per document, and their bounds.

    A document with fewer words has its whole sequence as one shingle, one without words none.
    """
    every = window_hashes(part.hashes, size)
    found = []
    for i in range(len(part)):
        low, high = int(part.bounds[i]), int(part.bounds[i + 1])
        if high - low >= size:
            found.append(np.unique(every[low : high - size + 1]))
        elif high > low:
            found.append(window_hashes(part.hashes[low:high], high - low))
        else:
            found.append(_EMPTY)
    bounds = np.zeros(len(part) + 1, dtype=np.int64)
    np.cumsum([len(x) for x in found], out=bounds[1:])
    return np.concatenate(found) if found else _EMPTY, bounds


def list_array(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    """An Arrow ``list<int64>`` column from flat unsigned values."""
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64)))
