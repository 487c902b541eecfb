"""Document fingerprints by quartiles of byte-triplet counts.

Triplets taken from a sliding window of five bytes are hashed into buckets. The fingerprint
keeps, per bucket, the quartile of its count, and a header with a check byte, the logarithm of
the length and the ratios of the quartiles. Two fingerprints are compared by a bounded
difference score.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.tables import texts_by_id
from newsloom.session import Staging

BUCKETS = 256
# Offsets of the second and third byte of a triplet behind the first one.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
BODY_LIMIT = 1.5  # mean quartile distance per bucket at which the body counts as unlike
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646C], dtype=np.uint32)


def digest(data: bytes) -> str:
    """The fingerprint: eight header digits and two bits a bucket, in hexadecimal."""
    b = np.frombuffer(data, dtype=np.uint8).astype(np.uint32)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for k, (second, third) in enumerate(TRIPLETS):
        if len(b) > third:
            n = len(b) - third
            code = (b[:n] | b[second : second + n] << np.uint32(8) | b[third : third + n] << np.uint32(16)) + np.uint32(k + 1) * np.uint32(0x01000193)
            code = (code ^ (code >> np.uint32(15))) * _FACTORS[k]
            counts += np.bincount(code >> np.uint32(24), minlength=BUCKETS)
    q1, q2, q3 = (int(x) for x in np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]])
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    body = codes.reshape(-1, 4) @ np.array([64, 16, 4, 1], dtype=np.uint8)
    length = min(255, int(round(np.log2(len(data) + 1) * 10)))
    ratios = [(min(15, 16 * a // max(q3, 1))) for a in (q1, q2)]
    header = bytes([hashlib.blake2b(data, digest_size=1).digest()[0], length, ratios[0] << 4 | ratios[1], min(255, q3.bit_length())])
    return (header + body.astype(np.uint8).tobytes()).hex()


def likeness(first: str, second: str) -> float:
    """1 for equal fingerprints down to 0: the difference score is bounded.

    Most of it is the distance of the quartile codes, the rest the header's lengths and ratios.
    """
    if first == second:
        return 1.0
    a, b = (np.frombuffer(bytes.fromhex(x), dtype=np.uint8) for x in (first, second))
    split = [np.stack([x[4:] >> s & 3 for s in (6, 4, 2, 0)]).astype(np.int64) for x in (a, b)]
    body = np.abs(split[0] - split[1])
    body = min(1.0, float((body + (body == 3)).mean()) / BODY_LIMIT)
    size = min(1.0, abs(int(a[1]) - int(b[1])) / 40)
    ratio = (abs(int(a[2] >> 4) - int(b[2] >> 4)) + abs(int(a[2] & 15) - int(b[2] & 15))) / 30
    return max(0.0, 1 - (0.85 * body + 0.1 * size + 0.04 * ratio + 0.01))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` for every row; null and empty texts share one fingerprint."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame.pop("text")
            yield frame.assign(fingerprint=[digest((t or "").encode()) for t in texts])

    return texts_by_id(docs, id_column, text_column).mapInPandas(run, "doc_id long, fingerprint string")


def with_next(docs: DataFrame, run: Callable, schema: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Map over documents in ascending id, each together with its successor's text.

    ``run`` gets ``(doc_id, text, next text)`` triples and gives frames of ``schema``. Spark deals
    the rows into ranges of ids, and every text moves once. A range's task reads its rows in
    order; its first and its last text are written beside its results, and the last text of a
    range meets the first one of the next range (of the first range, at the end) by a join on
    the ranges' numbers.
    """
    texts = texts_by_id(docs, id_column, text_column).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keep = Staging(texts.sparkSession)
    order = ["doc_id", "tie", "row"]
    keyed = texts.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def within(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ends: list[tuple] = []

        def triples():
            held = None
            for frame in frames:
                for doc_id, text in zip(frame["doc_id"], frame["text"]):
                    if held is None:
                        ends.append((None, text))
                    else:
                        yield *held, text
                    held = None if pd.isna(doc_id) else int(doc_id), text
            if held is not None:
                ends.append(held)

        for found in run(triples()):
            yield found.assign(part=pd.array([None] * len(found), dtype="Int32"), head=None, tail=None)
        if ends:
            part, (_, head), (doc_id, tail) = TaskContext.get().partitionId(), *ends
            names = [x.split()[0] for x in schema.split(", ")]
            edge = pd.DataFrame({name: [None] for name in names} | {"part": [part], "head": [head], "tail": [tail]})
            yield edge.assign(doc_id=pd.array([doc_id], dtype="Int64"))

    mapped = keep(ordered.mapInPandas(within, f"{schema}, part int, head string, tail string"), "ranges")
    inner = mapped.where("part IS NULL").drop("part", "head", "tail")
    edges = mapped.where("part IS NOT NULL").select("part", "doc_id", "head", "tail")
    number = Window.orderBy("part")  # one narrow row a range
    links = edges.select("part", F.coalesce(F.lead("part").over(number), F.first("part").over(number)).alias("following"))
    heads = edges.select(F.col("part").alias("following"), F.col("head").alias("next_text"))
    met = edges.select("part", "doc_id", F.col("tail").alias("text")).join(links, "part").join(heads, "following")

    def between(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield from run((None if pd.isna(i) else int(i), t, n) for i, t, n in zip(frame["doc_id"], frame["text"], frame["next_text"]))

    return inner.unionByName(met.select("doc_id", "text", "next_text").mapInPandas(between, schema))


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compared(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of all texts and their edited forms, and how alike they are.

    Columns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. The edited text has its last ``floor(n / 2)`` code points replaced by the first
    ones of the next document by ascending id, the first one after the last. Null texts are
    empty. Rows without an id come first, rows that repeat an id are ordered by a hash of their
    text. A single row follows itself; an empty table gives no rows. Other columns are not read.
    """

    def run(triples) -> Iterator[pd.DataFrame]:
        rows = []
        known: tuple[str, str] | None = None  # the successor's fingerprint is the next row's own
        for doc_id, text, following in triples:
            own = known[1] if known and known[0] is text else digest(text.encode())
            after = digest(following.encode())
            known = (following, after)
            changed = edited(text, following).encode()
            mark = digest(changed)
            rows.append((doc_id, len(text), hashlib.sha256(changed).hexdigest(), own, mark, likeness(own, mark), likeness(own, after)))
            if len(rows) >= 500:
                yield _frame(rows)
                rows = []
        yield _frame(rows)

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs, run, schema, id_column, text_column)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    return frame
