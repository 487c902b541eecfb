"""Phrase collocations by dynamic itemset counting.

Texts are dealt into shards that are scanned in a cycle. Words are counted from the first
shard on. A longer phrase becomes active as soon as both phrases that lack one of its end words
have reached the threshold in what was counted so far, so lengths interleave: two-word phrases
are counted while words still are. Every phrase is counted over one full cycle of shards from
its activation and then is complete.

Which phrases have reached the threshold is known to the scanning tasks as a bit filter of fixed
size that only grows. A phrase is counted in step ``t`` if the filter of step ``t`` knows both
of its shorter phrases and the one of a cycle before did not. That is exactly one cycle from the
first step at which the filter knew them. A chance hit of the filter therefore makes a phrase be
counted that need not be, over a full cycle too; it never changes a count.

While the cycles run, a phrase is the 64-bit hash of its language and words, so that open
counts stay narrow. Phrases that share a hash can only look more frequent than they are. A last
scan counts the phrases themselves whose hash is frequent, and its counts are the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.words import Slice, buffers, mix, slices
from newsloom.session import Staging, spread

_BREAKS = ".,;:!?\n\x0b\x0c\r"
UNKNOWN = "und"
LONGEST = 4
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 29  # the filter takes 128 kB to 64 MB
_BLOCK = 1 << 19  # bits of the filter in one row on their way to the driver
_COUNTS = "lang string, phrase string, n_words int, n long"
_SALTS = 64
_SPELLED = 64 << 20  # bytes of text that a task of the last scan reads at least
_NO_SIZE, _STEP = np.uint64(0xFFFFFFFFFFFFFFFC), np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class PhraseOptions:
    """Phrases of 2 to 4 words that occur ``least`` times; ``top`` of each language.

    A phrase goes if a longer one around it has at least ``share`` percent of its occurrences.
    ``scale`` turns scores into integers. ``shards`` is the number of scans in a cycle.
    """

    least: int = 30
    share: int = 80
    scale: int = 2_000_000
    top: int = 2000
    shards: int = 2


class _Filter:
    """A fixed number of bits over phrase hashes; bits are only ever set."""

    def __init__(self, bits: int, packed: np.ndarray | None = None) -> None:
        self.bits = bits
        self.packed = np.zeros(bits // 8, dtype=np.uint8) if packed is None else packed

    def knows(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(self.bits - 1)
        return (self.packed[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def with_blocks(self, blocks: list[tuple[int, bytes]]) -> _Filter:
        packed = self.packed.copy()
        for block, content in blocks:
            part = packed[block * (_BLOCK // 8) :][: _BLOCK // 8]
            part |= np.frombuffer(content, dtype=np.uint8)[: len(part)]
        return _Filter(self.bits, packed)


# Letters in lower case, whatever ends a piece as a line break, tabs as blanks.
_TABLE = np.arange(256, dtype=np.uint8)
_TABLE[65:91] += 32
_TABLE[[ord(c) for c in _BREAKS]] = 10
_TABLE[9] = 32


def _canonical(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words joined by one blank within a piece, pieces and the ends of a text by line breaks.

    All characters concerned are single bytes, which no other character's bytes contain.
    """
    for batch in batches:
        data, offsets = buffers(batch.column(1))
        data = _TABLE[data]
        gap = (data == 32) | (data == 10)
        first = gap.copy()
        first[1:] &= ~gap[:-1]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        first[edges] = gap[edges]  # a gap never reaches into the next text
        heads = np.flatnonzero(first)
        if len(heads):
            broken = np.logical_or.reduceat((data == 10) & gap, heads)
            ends = np.zeros(len(data) + 1, dtype=bool)
            ends[offsets] = True
            after = np.append(heads[1:], len(data))
            width = np.minimum(np.add.reduceat(gap.astype(np.int64), heads), after - heads)
            broken |= ends[heads] | ends[heads + width]
            data[heads] = np.where(broken, 10, 32)
        kept = ~gap | first
        place = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(kept, out=place[1:])
        texts = pa.LargeStringArray.from_buffers(batch.num_rows, pa.py_buffer(place[offsets].tobytes()), pa.py_buffer(data[kept].tobytes()))
        yield pa.record_batch([batch.column(0), texts.cast(pa.string())], names=["lang", "text"])


def _language_codes(languages: pa.Array) -> np.ndarray:
    """A hash of each row's language, folded from its bytes' word hash."""
    found = languages.dictionary_encode()
    codes = np.zeros(max(len(found.dictionary), 1), dtype=np.uint64)
    for i, name in enumerate(found.dictionary.to_pylist()):
        content = np.frombuffer(name.encode() + b"\x00", dtype=np.uint8).astype(np.uint64)
        value = np.zeros(1, dtype=np.uint64)
        for byte in content:
            value = mix(value + np.uint64(byte) + np.uint64(1))
        codes[i] = value[0]
    return codes[found.indices.to_numpy(zero_copy_only=False)]


def _cut(part: Slice, at: np.ndarray, size: int) -> pa.Array:
    """The text of the ``size``-word phrases that begin at the words ``at``."""
    starts = part.starts[at]
    lengths = part.ends[at + size - 1] - starts
    offsets = np.zeros(len(at) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    data = part.data[np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])]
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data.tobytes()))


def _joined(part: Slice) -> np.ndarray:
    """Whether a word and the next one lie in the same piece (and document)."""
    same = np.zeros(len(part.starts), dtype=bool)
    same[:-1] = (part.starts[1:] - part.ends[:-1] == 1) & (part.data[part.starts[1:] - 1] == 0x20)
    return same


def _windows(part: Slice, own: np.ndarray, known: _Filter, earlier: _Filter | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``size, keys, places`` of the phrases of a slice whose shorter phrases are all known.

    Words count as active. With ``earlier``, phrases whose shorter phrases it knows are left out.
    A key is the hash of a phrase and its language, with the number of words in its last two bits.
    Longer phrases are hashed only where they can be active.
    """
    keys = mix(part.hashes ^ own) & _NO_SIZE
    yield 1, keys, np.arange(len(keys))
    reached = known.knows(keys)
    before = earlier.knows(keys) if earlier else None
    joined = _joined(part)[:-1]
    for size in range(2, LONGEST + 1):
        both = reached[:-1] & reached[1:]
        at = np.flatnonzero(both & joined if size == 2 else both)
        if not len(at):
            return
        longer = (mix(keys[at] * _STEP + part.hashes[at + size - 1]) & _NO_SIZE) | np.uint64(size - 1)
        old = before[at] & before[at + 1] if earlier else np.zeros(len(at), dtype=bool)
        yield size, longer[~old], at[~old]
        if size < LONGEST:
            reached = np.zeros(len(keys), dtype=bool)
            reached[at] = known.knows(longer)
            keys = keys.copy()
            keys[at] = longer
            if earlier:  # known then, like known now, means that its parts were too
                before = np.zeros(len(keys), dtype=bool)
                before[at] = old & earlier.knows(longer)


def _counting(words_too: bool, now, before):
    """Occurrences of the active phrases in one shard, added up per slice (4 MB of text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, earlier = now.value, before.value if before else None
        for batch in batches:
            codes = _language_codes(batch.column(0))
            for part in slices(batch.column(1)):
                own = np.repeat(codes[part.first : part.first + len(part)], np.diff(part.bounds))
                if not len(own):
                    continue
                for size, keys, _ in _windows(part, own, known, earlier):
                    if len(keys) and (size > 1 or words_too):
                        keys, counts = np.unique(keys, return_counts=True)
                        yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(counts, pa.int64())], names=["key", "n"])

    return run


def _spelling(final):
    """Occurrences of the phrases with a frequent hash, by their words; the empty phrase counts all words.

    Equal phrases of a slice are found by their hashes; across slices Spark groups by the words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: _Filter = final.value
        for batch in batches:
            languages, codes = batch.column(0), _language_codes(batch.column(0))
            for part in slices(batch.column(1)):
                owner = np.repeat(np.arange(len(part)), np.diff(part.bounds)) + part.first
                if not len(owner):
                    continue
                rows, total = np.unique(owner, return_counts=True)
                yield _rows(languages.take(pa.array(rows)), pa.array([""] * len(rows)), 0, total)
                for size, keys, at in _windows(part, codes[owner], known, None):
                    frequent = known.knows(keys)
                    _, first, counts = np.unique(keys[frequent], return_index=True, return_counts=True)
                    if len(first):
                        first = at[frequent][first]
                        yield _rows(languages.take(pa.array(owner[first])), _cut(part, first, size), size, counts)

    return run


def _rows(languages: pa.Array, phrases: pa.Array, size: int, counts: np.ndarray) -> pa.RecordBatch:
    sizes = pa.array(np.full(len(counts), size, dtype=np.int32))
    return pa.record_batch([languages.cast(pa.string()), phrases.cast(pa.string()), sizes, pa.array(counts, pa.int64())], names=["lang", "phrase", "n_words", "n"])


def _packing(rows: pa.Table) -> pa.Table:
    marks = np.zeros(_BLOCK, dtype=np.uint8)
    marks[rows.column("place").to_numpy()] = 1
    content = np.packbits(marks, bitorder="little").tobytes()
    return pa.table({"block": rows.column("block").slice(0, 1), "content": pa.array([content], pa.binary())})


def _extended(known: _Filter, keys: DataFrame) -> _Filter:
    """``known`` with the bits of ``keys``; what reaches the driver is at most the filter."""
    at = F.col("key").bitwiseAND(F.lit(known.bits - 1))
    places = keys.select(F.floor(at / _BLOCK).cast("int").alias("block"), (at % _BLOCK).cast("int").alias("place")).distinct()
    blocks = places.groupBy("block").applyInArrow(_packing, "block int, content binary")
    return known.with_blocks([(row.block, row.content) for row in blocks.toLocalIterator()])


def frequent_phrases(docs: DataFrame, options: PhraseOptions, keep: Staging) -> DataFrame:
    """``lang, phrase, n_words, total`` of all phrases of up to 4 words with ``options.least`` occurrences.

    The empty phrase holds the number of words of a language. ``docs`` has ``lang, text``, none
    null. One step scans one shard, adds its counts to the phrases still open and keeps those
    that are frequent or not yet complete.
    """
    spark, shards, least = docs.sparkSession, options.shards, options.least
    clean = docs.mapInArrow(_canonical, "lang string, text string")
    path = f"{keep.path}/shards"
    clean.withColumn("shard", (F.monotonically_increasing_id() % shards).cast("int")).write.partitionBy("shard").parquet(path)
    shard = spark.read.schema("lang string, text string, shard int").parquet(path)
    size = shard.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(max(LEAST_BITS, 1 << (size // 32).bit_length()), MOST_BITS)

    n_words = F.col("key").bitwiseAND(F.lit(3)) + 1
    filters, changed, state, folder, step = [_Filter(bits)], [True] * shards, None, None, 0
    while any(changed[-shards:]):
        now = spark.sparkContext.broadcast(filters[-1])
        before = spark.sparkContext.broadcast(filters[0]) if step >= shards else None
        scan = shard.where(F.col("shard") == step % shards).select("lang", "text")
        scan = spread(scan) if size else scan
        found = scan.mapInArrow(_counting(step < shards, now, before), "key long, n long").withColumn("since", F.lit(step))
        if state is not None:
            still = state.where((F.col("total") >= least) | (F.col("since") > step - shards))
            found = found.union(still.select("key", F.col("total").alias("n"), "since"))
        sums = found.groupBy("key").agg(F.sum("n").alias("total"), F.min("since").alias("since"))
        old, folder = folder, Staging(spark)
        state = folder(sums, f"step{step}")
        if old:
            old.remove()
        known = _extended(filters[-1], state.where((F.col("total") >= least) & (n_words < LONGEST)))
        changed.append(not np.array_equal(known.packed, filters[-1].packed))
        filters = [*filters, known][-shards - 1 :]
        now.unpersist()
        if before:
            before.unpersist()
        step += 1
    final = spark.sparkContext.broadcast(_extended(filters[-1], state.where((F.col("total") >= least) & (n_words == LONGEST))))
    tasks = max(spark.sparkContext.defaultParallelism, 1, size // _SPELLED)  # larger tasks add up more before the shuffle
    texts = spread(shard.select("lang", "text")) if size else shard.select("lang", "text")
    counted = texts.coalesce(tasks).mapInArrow(_spelling(final), _COUNTS)
    totals = counted.groupBy("lang", "phrase", "n_words").agg(F.sum("n").alias("total"))
    out = keep(totals.where((F.col("total") >= least) | (F.col("n_words") == 0)), "frequent")
    final.unpersist()
    folder.remove()
    return out


def _words(count: Column) -> Column:
    """The first ``count`` words of ``phrase``, or the last ones if negative."""
    return F.call_function("substring_index", F.col("phrase"), F.lit(" "), count)


def _superseded(state: DataFrame) -> DataFrame:
    """``lang, phrase, around``: the most occurrences of a phrase one word longer.

    Any longer phrase contains one of these that is at least as frequent, so they decide alone.
    """
    longer = state.where("n_words > 2")
    inner = F.explode(F.array(_words(F.col("n_words") - 1), _words(1 - F.col("n_words"))))
    return longer.select("lang", inner.alias("phrase"), "total").groupBy("lang", "phrase").agg(F.max("total").alias("around"))


def _scored(state: DataFrame, options: PhraseOptions) -> DataFrame:
    """``lang, phrase, a, l, r, score`` by the lowest-scoring cut of every phrase that stays."""
    around = _superseded(state)
    phrases = state.where("n_words > 1").join(around, ["lang", "phrase"], "left")
    phrases = phrases.where(F.col("around").isNull() | (100 * F.col("around") < options.share * F.col("total")))
    cuts = phrases.select(
        "lang", "phrase", "n_words", F.col("total").alias("a"), F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k")
    ).withColumns({"first": _words(F.col("k")), "rest": _words(F.col("k") - F.col("n_words"))})
    parts = state.where(F.col("n_words").between(1, LONGEST - 1))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("total").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("total").alias("r")), ["lang", "rest"])
    exact = F.expr(f"cast(cast({options.scale} AS decimal(10,0)) * cast(a AS decimal(19,0)) div (cast(l AS decimal(19,0)) + r) AS long)")
    best = F.min(F.struct(exact.alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame, options: PhraseOptions | None = None, lang_column: str = "lang", text_column: str = "text"
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of every language.

    Texts are lower-cased (A to Z), cut into pieces at ``.,;:!?`` and line breaks, and pieces
    into words at blanks and tabs. ``a`` counts all occurrences of a phrase within pieces, ``l``
    and ``r`` those of the two parts of its lowest-scoring cut, ``n`` all words of the language.

    Null and empty texts have no words; rows without a language belong to ``und``. Repeated rows
    count each. Ties in score go to the more frequent phrase, then by UTF-8 bytes. A language
    without phrases that are frequent enough, and an empty table, give no rows. Other columns of
    ``docs`` are not read.
    """
    options = options or PhraseOptions()
    named = docs.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).cast("string").alias("text"))
    prepared = named.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    keep = Staging(docs.sparkSession)
    state = frequent_phrases(prepared.where("text <> ''"), options, keep)
    scored = keep(_scored(state, options), "scored")

    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    rank = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    first = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))).withColumn("rank", rank).where(F.col("rank") <= options.top)
    last = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    best = first.drop("rank", "salt").withColumn("rank", last).where(F.col("rank") <= options.top)
    words = state.where("n_words = 0").select("lang", F.col("total").alias("n"))
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle(options: PhraseOptions | None = None) -> str:
    """The same phrases as DuckDB SQL over ``documents``, by counting everything."""
    o = options or PhraseOptions()
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, list_filter(string_split_regex(part, '[\x20\x09]'), lambda w: w <> '') AS w
  FROM (SELECT lang, unnest(string_split_regex(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS part
        FROM documents)
), words AS (SELECT lang, piece, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM pieces),
runs AS (
  SELECT lang, w AS w1, w || ' ' || lead(w) OVER p AS w2, w || ' ' || lead(w) OVER p || ' ' || lead(w, 2) OVER p AS w3,
    w || ' ' || lead(w) OVER p || ' ' || lead(w, 2) OVER p || ' ' || lead(w, 3) OVER p AS w4
  FROM words WINDOW p AS (PARTITION BY piece ORDER BY i)
), grams AS (
  SELECT lang, 1 AS size, w1 AS phrase, count(*) AS f FROM runs GROUP BY ALL
  UNION ALL SELECT lang, 2, w2, count(*) FROM runs WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w3, count(*) FROM runs WHERE w3 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 4, w4, count(*) FROM runs WHERE w4 IS NOT NULL GROUP BY ALL
), totals AS (SELECT lang, sum(f) AS n FROM grams WHERE size = 1 GROUP BY lang),
frequent AS MATERIALIZED (SELECT lang, size, phrase, f FROM grams WHERE f >= {o.least}),
candidates AS MATERIALIZED (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM frequent WHERE size > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, {o.scale}::HUGEINT * c.a // (x.f + y.f) AS score
  FROM (SELECT *, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
        FROM (SELECT *, unnest(generate_series(1, size - 1)) AS k FROM candidates)) AS c
  JOIN frequent AS x ON x.lang = c.lang AND x.phrase = c.head
  JOIN frequent AS y ON y.lang = c.lang AND y.phrase = c.tail
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_phrases AS (
  SELECT lang, array_to_string(w[i:j], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(generate_series(i + 1, size)) AS j FROM (SELECT *, unnest(generate_series(1, size)) AS i FROM candidates))
  WHERE j - i + 1 < size GROUP BY ALL
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(b.phrase)) AS rank,
  b.phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM best AS b JOIN totals USING (lang) LEFT JOIN inner_phrases AS i ON i.lang = b.lang AND i.phrase = b.phrase
WHERE longer IS NULL OR 100 * longer < {o.share} * a
QUALIFY rank <= {o.top}
"""
