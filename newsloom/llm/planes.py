"""Token ids in files of bit or byte planes.

A file holds blocks of ``block`` ids. The ids of a block are transposed into planes, the first
bytes of all ids, then the second ones and so on (or single bits), and every plane is compressed
by itself with zstandard. Behind the blocks lies the index: where each block's planes begin and
how many ids it has, and for every document its id and number of ids. Ids of a document follow
each other, also across blocks; a reader that wants some ids only touches their blocks.

    magic | planes of block 0 | planes of block 1 | ... | index (zstandard) | its length | magic

A task writes one file per partition under a name of its own and reports it as a row. Rows of
failed or repeated attempts never reach the manifest, so their files are not read.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.tables import texts_by_id
from newsloom.session import Staging

MAGIC = b"IDPLANE1"
MEMORY = 1_200_000  # pre-tokens whose ids a worker remembers, about 250 MB; then it begins anew
_TOGETHER = 1 << 20  # characters of texts whose pre-tokens are looked up together
_MANIFEST = "part int, path string, n_ids long, n_docs long, n_bytes long"
_SUMMARY = "part int, doc_id long, start long, n_tokens long, ids_crc32 long"

# Pre-tokens of the byte-level tokenizer within Latin-1, where letters and numbers are known.
_LETTERS = "A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff"
_NUMBERS = "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe"
_PLAIN = re.compile("[\\t\\n\\r\\x20-\\x7e\\xa1-\\xff]*")
_PIECES = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^\\s{_LETTERS}{_NUMBERS}]+|\\s+(?!\\S)|\\s+")


@dataclass(frozen=True)
class PlaneOptions:
    """``planes`` is ``byte`` (4 planes) or ``bit`` (32); ``end_id`` closes every document."""

    tokenizer: str
    end_id: int = 2
    block: int = 65536
    planes: str = "byte"
    level: int = 3


class PieceTokens:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    Pre-tokens repeat and merges never reach across them, so the ids of a bounded number of them
    are remembered. New words that begin with a blank are encoded side by side as one text: each
    is a pre-token of it, and its first id is the only one that begins with a blank. Texts beyond
    Latin-1 or with a special token's opening go through as a whole.
    """

    _loaded: dict[str, PieceTokens] = {}

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._known: dict[str, bytes] = {}
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._blank = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._blank[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True

    @classmethod
    def of(cls, path: str) -> PieceTokens:
        """The worker's instance for a tokenizer file."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, fresh: set[str]) -> None:
        words = [p for p in fresh if p[0] == " " and p[1:].isalpha()]
        raw = self._ids(["".join(words)])[0]
        heads = np.flatnonzero(self._blank[np.frombuffer(raw, dtype=np.uint32)])
        if len(heads) == len(words):
            cuts = [*(4 * heads).tolist(), len(raw)]
            self._known.update(zip(words, [raw[low:high] for low, high in zip(cuts, cuts[1:])], strict=True))
        others = [p for p in fresh if p not in self._known]
        self._known.update(zip(others, self._ids(others), strict=True))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts; null is empty."""
        out: list[bytes] = []
        low = 0
        while low < len(texts):
            high, size = low, 0
            while high < len(texts) and (high == low or size < _TOGETHER):
                size += len(texts[high] or "")
                high += 1
            out += self._encode(["" if t is None else t for t in texts[low:high]])
            low = high
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        split = [_PIECES.findall(t) if "<|" not in t and _PLAIN.fullmatch(t) else None for t in texts]
        fresh = set().union(*[p for p in split if p]).difference(self._known)
        if len(self._known) + len(fresh) > MEMORY:
            self._known.clear()
            fresh = set().union(*[p for p in split if p])
        if fresh:
            self._learn(fresh)
        known = self._known
        return [self._ids([t])[0] if p is None else b"".join(map(known.__getitem__, p)) for t, p in zip(texts, split, strict=True)]


def split_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of a block of unsigned 32-bit ids, lowest first."""
    octets = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if kind == "byte":
        return [plane.tobytes() for plane in octets]
    return [np.packbits((octet >> bit) & 1).tobytes() for octet in octets for bit in range(8)]


def join_planes(planes: list[bytes], count: int) -> np.ndarray:
    """The ids that :func:`split_planes` took apart; 32 planes are bits, 4 are bytes."""
    octets = np.zeros((4, count), dtype=np.uint8)
    for i, plane in enumerate(planes):
        if len(planes) == 4:
            octets[i] = np.frombuffer(plane, dtype=np.uint8)
        else:
            octets[i // 8] |= np.unpackbits(np.frombuffer(plane, dtype=np.uint8), count=count) << (i % 8)
    return np.ascontiguousarray(octets.T).view("<u4").ravel()


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith(("file:", "/")) else (fs.LocalFileSystem(), path)


class PlaneWriter:
    """One file; holds at most a block of ids and the index."""

    def __init__(self, path: str, options: PlaneOptions) -> None:
        import zstandard

        system, name = _place(path)
        system.create_dir(os.path.dirname(name), recursive=True)
        self._out = system.open_output_stream(name)
        self._out.write(MAGIC)
        self._options, self._compressor = options, zstandard.ZstdCompressor(level=options.level)
        self._pending, self._pending_ids = [], 0
        self._docs, self._missing, self._counts = array("q"), array("b"), array("q")
        self._blocks, self._lengths = array("q"), array("q")  # ids of each block; bytes of each plane
        self.n_ids, self.n_docs, self.n_bytes = 0, 0, 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._docs.append(doc_id or 0)
        self._missing.append(doc_id is None)
        self._counts.append(len(ids) // 4)
        self.n_docs += 1
        self.n_ids += len(ids) // 4
        self._pending.append(ids)
        self._pending_ids += len(ids) // 4
        if self._pending_ids >= self._options.block:
            self._flush(self._options.block)

    def _flush(self, least: int) -> None:
        """Write whole blocks while at least ``least`` ids wait."""
        flat, low = np.frombuffer(b"".join(self._pending), dtype="<u4"), 0
        while len(flat) - low >= max(least, 1):
            block = flat[low : low + self._options.block]
            low += len(block)
            self._blocks.append(len(block))
            for plane in split_planes(block, self._options.planes):
                packed = self._compressor.compress(plane)
                self._lengths.append(len(packed))
                self._out.write(packed)
        self._pending, self._pending_ids = [flat[low:].tobytes()], len(flat) - low

    def close(self) -> None:
        self._flush(1)
        parts = [a.tobytes() for a in (self._blocks, self._lengths, self._docs, self._missing, self._counts)]
        index = self._compressor.compress(b"".join(struct.pack("<q", len(p)) + p for p in parts))
        self._out.write(index + struct.pack("<q", len(index)) + MAGIC)
        self.n_bytes = self._out.tell()
        self._out.close()


class PlaneReader:
    """One file; the index is read at once, blocks on demand."""

    def __init__(self, path: str) -> None:
        import zstandard

        system, name = _place(path)
        self._file = system.open_input_file(name)
        size, tail = self._file.size(), 8 + len(MAGIC)
        self._unpack = zstandard.ZstdDecompressor().decompress
        end = self._file.read_at(tail, size - tail)
        if end[8:] != MAGIC or self._file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"not a complete file of planes: {path}")
        length = struct.unpack("<q", end[:8])[0]
        index, parts, low = self._unpack(self._file.read_at(length, size - tail - length)), [], 0
        while low < len(index):
            count = struct.unpack_from("<q", index, low)[0]
            parts.append(index[low + 8 : low + 8 + count])
            low += 8 + count
        blocks, lengths, docs, missing, counts = parts
        self.blocks = np.frombuffer(blocks, dtype="<i8")
        self._planes = len(lengths) // len(blocks) if len(blocks) else 4
        self._lengths = np.frombuffer(lengths, dtype="<i8").reshape(-1, self._planes)
        self._offsets = len(MAGIC) + np.append(0, np.cumsum(self._lengths.sum(axis=1)))
        self._firsts = np.append(0, np.cumsum(self.blocks))
        self.docs, self.missing = np.frombuffer(docs, dtype="<i8"), np.frombuffer(missing, dtype=np.int8) != 0
        self.counts = np.frombuffer(counts, dtype="<i8")
        self.starts = np.append(0, np.cumsum(self.counts))

    def block(self, number: int) -> np.ndarray:
        at, lengths = 0, self._lengths[number]
        content = self._file.read_at(int(lengths.sum()), int(self._offsets[number]))
        planes = []
        for length in lengths.tolist():
            planes.append(self._unpack(content[at : at + length]))
            at += length
        return join_planes(planes, int(self.blocks[number]))

    def ids(self, start: int, count: int) -> Iterator[np.ndarray]:
        """The ids from ``start`` on, block by block."""
        number = int(np.searchsorted(self._firsts, start, side="right")) - 1
        while count > 0:
            low = start - int(self._firsts[number])
            part = self.block(number)[low : low + count]
            yield part
            start, count, number = start + len(part), count - len(part), number + 1

    def documents(self) -> Iterator[tuple[int | None, int, Iterator[np.ndarray]]]:
        """Every document's id, its first id's place in the file, and its ids in pieces.

        Pieces have to be read before the next document is asked for; each block is read once.
        """
        number, block, low = -1, np.zeros(0, dtype="<u4"), 0

        def pieces(count: int) -> Iterator[np.ndarray]:
            nonlocal number, block, low
            while count > 0:
                if low == len(block):
                    number, low = number + 1, 0
                    block = self.block(number)
                part = block[low : low + count]
                low, count = low + len(part), count - len(part)
                yield part

        for doc, missing, start, count in zip(self.docs.tolist(), self.missing.tolist(), self.starts.tolist(), self.counts.tolist()):
            yield None if missing else doc, start, pieces(count)


def _writing(root: str, options: PlaneOptions):
    end = struct.pack("<I", options.end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part, writer, path = PieceTokens.of(options.tokenizer), TaskContext.get().partitionId(), None, ""
        for batch in batches:
            if writer is None:
                path = f"{root}/ids-{part:06d}-{uuid.uuid4().hex}.planes"
                writer = PlaneWriter(path, options)
            for doc_id, ids in zip(batch.column(0).to_pylist(), tokens.encode(batch.column(1).to_pylist()), strict=True):
                writer.add(doc_id, ids + end)
        if writer:
            writer.close()
            row = [part, path, writer.n_ids, writer.n_docs, writer.n_bytes]
            yield pa.record_batch([pa.array([x]) for x in row], names=["part", "path", "n_ids", "n_docs", "n_bytes"]).cast(
                pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_ids", pa.int64()), ("n_docs", pa.int64()), ("n_bytes", pa.int64())])
            )

    return run


def write_planes(docs: DataFrame, root: str, options: PlaneOptions, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encode all texts and write them in ascending order of their ids; returns the manifest.

    ``part, path, n_ids, n_docs, n_bytes`` has one row per file, ordered by ``part``; it is
    itself written below ``root``. Null and empty texts have only the end id. Rows without an id
    come first; rows that repeat an id follow each other in any order, and may lie in several
    files. An empty table writes no file. Other columns are not read. Files are as many as the
    shuffle has partitions, so ``spark.sql.shuffle.partitions`` decides their size.
    """
    texts = texts_by_id(docs, id_column, text_column).withColumn("row", F.monotonically_increasing_id())
    ordered = texts.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "text")
    manifest = ordered.mapInArrow(_writing(root, options), _MANIFEST)
    manifest.write.parquet(f"{root}/manifest")
    return docs.sparkSession.read.schema(_MANIFEST).parquet(f"{root}/manifest")


def _summing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int32()] + [pa.int64()] * 4
    names = ["part", "doc_id", "start", "n_tokens", "ids_crc32"]
    for batch in batches:
        for part, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows = []
            for doc_id, start, pieces in PlaneReader(path).documents():
                crc, count = 0, 0
                for ids in pieces:
                    crc, count = zlib.crc32(ids.tobytes(), crc), count + len(ids)
                rows.append((part, doc_id, start, count, crc))
                if len(rows) == 8192:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)
                    rows = []
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)


def read_summaries(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the files.

    ``start`` counts the ids of all documents before it. One task reads one file, block by block;
    only the files' numbers of ids (one row per writing task) pass through the driver.
    """
    spark, base, rows = manifest.sparkSession, 0, []
    for row in sorted(manifest.select("part", "n_ids").collect()):
        rows.append((row.part, base))
        base += row.n_ids
    files = manifest.select("part", "path").repartitionByRange(max(1, len(rows)), "part")
    found = files.mapInArrow(_summing, _SUMMARY)
    bases = spark.createDataFrame(rows, "part int, base long")
    return found.join(F.broadcast(bases), "part").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, options: PlaneOptions) -> DataFrame:
    """Write ``docs`` to the shared folder named by ``spark.checkpoint.dir`` and read them back."""
    keep = Staging(docs.sparkSession)
    return read_summaries(write_planes(docs, f"{keep.path}/planes", options))
