"""Mentions of known names in articles: an alias table against the n-grams of the text.

Texts are folded (lower case, no accents) without changing their length, cut into words, and
every run of words that could be an alias is joined with the alias table on its folded form.
Where matches overlap, the one that begins first wins, the longest of those that begin together.
A name of several entities goes to the one whose state fits best.

The alias table is broadcast below a byte bound only. Beyond it, n-grams are shuffled to the
aliases under a salted key, so a name that a third of all articles carry is spread too.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import ACCENTED, PLAIN, fold
from newsloom.session import Staging

# A word: letters and digits, with the marks that follow a letter as characters of their own.
_MARKS = "\u0300-\u036f"
_WORD = re.compile(f"[^\\W_](?:[^\\W_]+|[{_MARKS}]+)*")
_ASCII_WORD = re.compile("[A-Za-z0-9]+")
_WORD_SQL = f"[\\p{{L}}\\p{{N}}][\\p{{L}}\\p{{N}}{_MARKS}]*"
# What may stand between the words of one name.
_JOINT = re.compile("[ \\t\u00a0'\u2019-]+")
# A state named behind a mention: "Name (SP)", "Name/SP", "Name - SP", "Name, SP".
_STATE = re.compile(r"[ \t]?(?:[-/,\u2013][ \t]?|\()([A-Z]{2})(?![^\W_])")
_FOLD = {ord(a): b for a, b in zip(ACCENTED, PLAIN)}
_BITS = 1 << 20
_GRAMS = "article_id string, own_uf string, start int, finish int, key string, said_uf string"


@dataclass(frozen=True)
class MentionOptions:
    """``broadcast_bytes`` bounds the folded alias texts that are broadcast; ``salts`` spreads a
    frequent name over that many tasks otherwise."""

    broadcast_bytes: int = 16 << 20
    salts: int = 32


def alias_key(name: Column) -> Column:
    """The folded words of a name, one blank between them; empty if it has none."""
    words = F.regexp_extract_all(fold(name), F.lit(f"({_WORD_SQL})"), F.lit(1))
    return F.regexp_replace(F.array_join(words, " "), f"[{_MARKS}]", "")


def _folded(word: str) -> str:
    if word.isascii():
        return word.lower()
    key = word.translate(_FOLD).lower()
    return key if key.isascii() else re.sub(f"[{_MARKS}]", "", key)


def folded_words(text: str) -> list[tuple[int, int, str]]:
    """``(start, finish, key)`` of every word, places in code points of ``text``."""
    return [(m.start(), m.end(), _folded(m[0])) for m in _WORD.finditer(text)]


def _grams(longest: int, marked: bytes):
    """All runs of up to ``longest`` words that may be an alias by the bits of :func:`_beginnings`.

    A word is folded and looked up once per worker, not where it occurs; the words behind it are
    looked at as long as an alias may begin like that.
    """
    bits = np.unpackbits(np.frombuffer(marked, dtype=np.uint8), bitorder="little").tobytes()

    def begins(key: str) -> int:
        return bits[zlib.crc32(key.encode()) % _BITS]

    def whole(key: str) -> int:
        return bits[_BITS + zlib.crc32(key.encode()) % _BITS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _GRAMS.split(", ")]
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]
        known: dict[str, str] = {}  # the folded word, or nothing if no alias begins with it
        for batch in batches:
            rows = []
            for article_id, text, own in zip(*(column.to_pylist() for column in batch.columns)):
                text = text or ""
                word = _ASCII_WORD if text.isascii() else _WORD
                for m in word.finditer(text):
                    key = known.get(m[0])
                    if key is None:
                        if len(known) >= 250_000:
                            known.clear()
                        key = _folded(m[0])
                        key = known[m[0]] = key if begins(key) else ""
                    if not key:
                        continue
                    start, left = m.start(), longest
                    while True:
                        if whole(key):
                            state = _STATE.match(text, m.end())
                            rows.append((article_id, own, start, m.end(), key, state[1] if state else None))
                        left -= 1
                        joint = _JOINT.match(text, m.end()) if left else None
                        m = word.match(text, joint.end()) if joint else None
                        if m is None:
                            break
                        key = f"{key} {_folded(m[0])}"
                        if not begins(key):
                            break
                if len(rows) >= 50_000:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)
                    rows = []
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)

    return run


def _disjoint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the matches of every article those that stay, from left to right.

    Rows come article by article, sorted by place; an article may reach over batches.
    """
    article, end = None, -1
    for batch in batches:
        kept = []
        columns = (batch.column(name).to_pylist() for name in ("article_id", "start", "finish"))
        for i, (article_id, start, finish) in enumerate(zip(*columns)):
            if article_id != article:
                article, end = article_id, -1
            if start >= end:
                kept.append(i)
                end = finish
        yield batch.take(pa.array(kept, pa.int64()))


def _beginnings(keys: DataFrame) -> bytes:
    """A fixed number of bits, set for what aliases begin with (one word, two, ...), and as many for
    whole aliases; that is all that is collected."""
    begun = F.explode(F.expr("transform(sequence(1, size(split(key, ' '))), n -> substring_index(key, ' ', n))"))
    place = lambda text: F.pmod(F.crc32(text), F.lit(_BITS)).cast("int")
    places = keys.select(begun.alias("begun")).select(place("begun").alias("place")).union(keys.select(place("key") + _BITS))
    bits = np.zeros(2 * _BITS, dtype=np.uint8)
    for row in places.distinct().toLocalIterator():
        bits[row.place] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def _looked_up(grams: DataFrame, table: DataFrame, small: bool, salts: int) -> DataFrame:
    """``grams`` joined with a table on ``key``: broadcast if small, else salted."""
    if small:
        return grams.join(F.broadcast(table), "key")
    salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salt = F.pmod(F.xxhash64("article_id", "start"), F.lit(salts)).cast("int")
    return grams.withColumn("salt", salt).join(salted, ["key", "salt"]).drop("salt")


def find_mentions(articles: DataFrame, aliases: DataFrame, options: MentionOptions | None = None) -> DataFrame:
    """``article_id, start, finish, entity_id, uf`` for every mention.

    ``articles`` has ``article_id, text`` and may have ``uf``, the state the article is about.
    ``aliases`` has ``entity_id, alias, uf, weight``, a row for every name of an entity. Accents
    and case do not matter, words are whole, and between the words of a name only blanks, hyphens
    and apostrophes may stand. ``start`` and ``finish`` are code points of ``text``.

    An ambiguous name goes to the entity whose state is named right behind it, then to one in the
    article's own state, then to the state that most unambiguous mentions of the article lie in,
    then to the one with the largest ``weight``, then the smallest id.

    Null and empty texts have no mentions, names without a word match nothing. Rows that repeat
    an article id are one article: the same place counts once. Other columns are not read.
    """
    options = options or MentionOptions()
    keep = Staging(articles.sparkSession)
    own = F.col("uf") if "uf" in articles.columns else F.lit(None)
    texts = articles.select(F.col("article_id").cast("string"), F.col("text").cast("string"), own.cast("string").alias("uf"))
    texts = texts.where("article_id IS NOT NULL AND text <> ''")
    named = aliases.select("entity_id", alias_key(F.col("alias")).alias("key"), F.col("uf").cast("string").alias("uf"), F.col("weight").cast("long").alias("weight"))
    named = named.where("key <> '' AND entity_id IS NOT NULL").groupBy("key", "entity_id").agg(F.min("uf").alias("uf"), F.max("weight").alias("weight"))
    named = keep(named, "aliases")
    keys = keep(named.groupBy("key").agg(F.count("*").alias("n_entities"), F.min("uf").alias("only_uf")), "keys")
    size = keys.agg(F.sum(F.octet_length("key") + 64).alias("bytes"), F.max(F.size(F.split("key", " "))).alias("longest")).first()
    all_rows = named.agg(F.sum(F.octet_length("key") + 96)).first()[0] or 0
    if not size.longest:
        return articles.sparkSession.createDataFrame([], f"article_id string, start int, finish int, entity_id {aliases.schema['entity_id'].dataType.simpleString()}, uf string")

    grams = texts.mapInArrow(_grams(size.longest, _beginnings(keys)), _GRAMS)
    hits = _looked_up(grams, keys, size.bytes <= options.broadcast_bytes, options.salts)
    shape = f"{_GRAMS}, n_entities long, only_uf string"
    hits = hits.select(*[x.split()[0] for x in shape.split(", ")])
    place = ("article_id", "start", F.desc("finish"), "own_uf", "said_uf")
    kept = keep(hits.repartition("article_id").sortWithinPartitions(*place).mapInArrow(_disjoint, shape), "kept")

    around = kept.where("n_entities = 1 AND only_uf IS NOT NULL").groupBy("article_id", F.col("only_uf").alias("uf")).agg(F.count("*").alias("around"))
    found = _looked_up(kept.drop("n_entities", "only_uf"), named, all_rows <= options.broadcast_bytes, options.salts)
    found = found.join(around, ["article_id", "uf"], "left")
    fits = lambda column: F.coalesce(F.col(column) == F.col("uf"), F.lit(False))
    rank = F.struct(~fits("said_uf"), ~fits("own_uf"), -F.coalesce("around", F.lit(0)), -F.coalesce("weight", F.lit(0)), "entity_id")
    return found.groupBy("article_id", "start", "finish").agg(F.min(F.struct(rank.alias("rank"), "entity_id", "uf")).alias("best")).select(
        "article_id", "start", "finish", "best.entity_id", "best.uf"
    )


def mentions_by_entity(found: DataFrame) -> DataFrame:
    """One row per article and entity: ``n_mentions``, the first place and all ``places``."""
    grouped = found.groupBy("article_id", "entity_id", "uf").agg(F.sort_array(F.collect_list(F.struct("start", "finish"))).alias("places"))
    return grouped.select("article_id", "entity_id", "uf", F.size("places").alias("n_mentions"), F.col("places")[0]["start"].alias("first_start"), "places")
