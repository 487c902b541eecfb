"""Phrase mining, plane files and centroids against brute force, with the odd cases of a contract."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newsloom.llm import centroids, phrases, planes
from newsloom.session import Staging

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, phrase string, n long, total long"


# phrases ---------------------------------------------------------------------------------
def brute_phrases(rows, o):
    counts, words = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for size in range(1, 5):
                counts.setdefault(lang, Counter()).update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= o.least}
        around = Counter()
        for p, a in candidates.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        around[p[i:j]] = max(around[p[i:j]], a)
        found = []
        for p, a in candidates.items():
            if around[p] and 100 * around[p] >= o.share * a:
                continue
            cuts = [(o.scale * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[: o.top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, words[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("least,share,top,shards", [(4, 80, 2000, 4), (3, 50, 5, 2), (6, 101, 40, 3)])
def test_phrases_equal_brute_force(spark, least, share, top, shards):
    rng = random.Random(least)
    pool = ["The", "of", "New", "york", "CITY", "é", "ÉTÉ", "x-y", "a'b", " z", "<|x|>"]
    rows = []
    for i in range(300):
        parts = [rng.choice(["new York city", " ", "\t", ". ", ",\n", " ! ", "  "] + pool * 2) + rng.choice([" ", "  ", "\t"]) for _ in range(rng.randrange(0, 60))]
        rows.append(("".join(parts), rng.choice(["en", "en", "en", "de", None, ""])))
    rows += [(None, "en"), ("", "de"), (" \t\n.", None), ("a a a a a a a a a", "fr"), ("x" * 10_000, "fr")] + [("same old text here", "es")] * 50
    o = phrases.PhraseOptions(least=least, share=share, top=top, shards=shards)
    docs = spark.createDataFrame([(i, t, x, "p", 1, 2) for i, (t, x) in enumerate(rows)], SCHEMA).repartition(5)
    got = phrases.collocations(docs, o)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, o)


def test_phrases_of_an_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    none = spark.createDataFrame([(1, None, "en", "p", 1, 2)], SCHEMA)
    assert phrases.collocations(none).collect() == []


def test_chance_hits_of_the_filter_change_no_count(spark, monkeypatch):
    """A filter so small that most of its bits are set counts too much, never wrongly."""
    rng = random.Random(1)
    rows = [(" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("xyz") for _ in range(40)), "en") for _ in range(200)]
    monkeypatch.setattr(phrases, "LEAST_BITS", 64)
    monkeypatch.setattr(phrases, "MOST_BITS", 64)
    o = phrases.PhraseOptions(least=3)
    docs = spark.createDataFrame([(i, t, x, "p", 1, 2) for i, (t, x) in enumerate(rows)], SCHEMA)
    assert sorted(map(tuple, phrases.collocations(docs, o).collect())) == brute_phrases(rows, o)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 4 * 10**18
    state = spark.createDataFrame([("en", "a b", 2, big), ("en", "a", 1, big + 1), ("en", "b", 1, big + 2)], "lang string, phrase string, n_words int, total long")
    row = phrases._scored(state, phrases.PhraseOptions()).first()
    assert row.score == 2_000_000 * big // (2 * big + 3)


# plane files -----------------------------------------------------------------------------
OPTIONS = planes.PlaneOptions(tokenizer=public_tokenizers.path("byte_bpe_50k.json"), block=100)


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("count", [0, 1, 7, 8, 1000])
def test_planes_round_trip(kind, count):
    ids = np.random.default_rng(count).integers(0, 2**32, count, dtype=np.uint32)
    parts = planes.split_planes(ids, kind)
    assert len(parts) == (4 if kind == "byte" else 32)
    assert np.array_equal(planes.join_planes(parts, count), ids)


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_files_give_back_ranges_and_documents(tmp_path, kind):
    rng, o = random.Random(4), planes.PlaneOptions("", block=64, planes=kind)
    docs = [(i if i % 5 else None, np.array([rng.randrange(2**20) for _ in range(rng.choice([0, 1, 63, 64, 65, 500]))], dtype="<u4")) for i in range(40)]
    writer = planes.PlaneWriter(str(tmp_path / "deep" / "x.planes"), o)
    for i, ids in docs:
        writer.add(i, ids.tobytes())
    writer.close()
    reader, flat = planes.PlaneReader(str(tmp_path / "deep" / "x.planes")), np.concatenate([ids for _, ids in docs])
    assert (writer.n_ids, writer.n_docs) == (len(flat), 40) and max(reader.blocks) == 64
    for _ in range(50):
        low = rng.randrange(len(flat))
        count = rng.randrange(0, len(flat) - low + 1)
        assert np.array_equal(np.concatenate([*reader.ids(low, count), np.zeros(0, "<u4")]), flat[low : low + count])
    read = [(i, start, np.concatenate([*p, np.zeros(0, "<u4")]).tolist()) for i, start, p in reader.documents()]
    assert [(i, x) for i, _, x in read] == [(i, ids.tolist()) for i, ids in docs]
    assert [s for _, s, _ in read] == [0, *np.cumsum([len(ids) for _, ids in docs]).tolist()][:-1]


def test_damaged_files_are_refused(tmp_path):
    writer = planes.PlaneWriter(str(tmp_path / "x.planes"), OPTIONS)
    writer.add(1, struct.pack("<2I", 5, 2))
    writer.close()
    content = (tmp_path / "x.planes").read_bytes()
    (tmp_path / "y.planes").write_bytes(content[:-3])
    with pytest.raises(ValueError, match="not a complete file"):
        planes.PlaneReader(str(tmp_path / "y.planes"))


def test_remembered_pieces_equal_the_tokenizer():
    rng, plain = random.Random(6), Tokenizer.from_file(OPTIONS.tokenizer)
    tokens = planes.PieceTokens.of(OPTIONS.tokenizer)
    letters = "ab I'll've 12.,'\n\t\r  éß²½ª·×÷ \u0085\x1c\x0b中<|>"
    texts = [None, ""]
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 40)))
        texts.append(text + rng.choice(["", "<|endoftext|>", "  ", " don't  ", "\n\n x", " été ß ª", " a"]))
    expected = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert tokens.encode(texts) == [struct.pack(f"<{len(x)}I", *x) for x in expected]


def test_a_full_memory_begins_anew(monkeypatch):
    monkeypatch.setattr(planes, "MEMORY", 40)
    monkeypatch.setattr(planes, "_TOGETHER", 60)
    rng, plain, tokens = random.Random(2), Tokenizer.from_file(OPTIONS.tokenizer), planes.PieceTokens(OPTIONS.tokenizer)
    texts = [" ".join("".join(rng.choice("abcdé") for _ in range(3)) for _ in range(12)) for _ in range(60)]
    assert tokens.encode(texts) == [struct.pack(f"<{len(x)}I", *x) for x in (plain.encode(t, add_special_tokens=False).ids for t in texts)]


@pytest.mark.parametrize("ids", ["spread", "repeated"])
def test_documents_come_back_from_files(spark, ids):
    rng, plain = random.Random(9), Tokenizer.from_file(OPTIONS.tokenizer)
    texts = [" ".join(rng.choice(["word", "été", "中文", "12", "I'll"]) for _ in range(rng.choice([0, 1, 30, 400]))) for _ in range(60)] + [None, ""]
    keys = [7 * k - 50 for k in range(62)] if ids == "spread" else [None if k % 10 == 0 else k // 20 for k in range(62)]
    rows = list(zip(keys, texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "en", "p", 1, 2) for i, t in rows], SCHEMA).repartition(4)
    got = [tuple(r) for r in planes.round_trip(docs, OPTIONS).collect()]
    encoded = {t: plain.encode(t or "", add_special_tokens=False).ids + [2] for t in texts}
    value = lambda t: (len(encoded[t]), zlib.crc32(struct.pack(f"<{len(encoded[t])}I", *encoded[t])))
    got.sort(key=lambda r: r[1])
    assert Counter((r[0], *r[2:]) for r in got) == Counter((i, *value(t)) for i, t in rows)
    order = [-1000 if r[0] is None else r[0] for r in got]
    assert order == sorted(order)
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got]).tolist()][:-1]


def test_files_of_an_empty_table(spark):
    assert planes.round_trip(spark.createDataFrame([], SCHEMA), OPTIONS).collect() == []


def test_unlisted_files_are_not_read(spark):
    """A failed attempt leaves a file; only the manifest counts."""
    root = f"{Staging(spark).path}/planes"
    manifest = planes.write_planes(spark.createDataFrame([(1, "some text", "", "", 0, 0)], SCHEMA), root, OPTIONS)
    planes.PlaneWriter(f"{root}/ids-000000-left.planes", OPTIONS).close()
    assert [r.doc_id for r in planes.read_summaries(manifest).collect()] == [1]


# centroids -------------------------------------------------------------------------------
def brute_clusters(rows, o):
    kept = [(i, [int(np.floor(np.float64(x) * o.scale)) for x in v]) for i, v in rows if v is not None and len(v) == o.dims and all(x is not None and np.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centers = [v for _, v in named[: o.clusters]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for step in range(o.rounds + 1):
        found = [min((far(v, c), k) for k, c in enumerate(centers)) for _, v in kept]
        if step < o.rounds:
            for k in range(len(centers)):
                mine = [v for (_, v), (_, m) in zip(kept, found) if m == k]
                if mine:
                    centers[k] = [sum(x) // len(mine) for x in zip(*mine)]
    total, each = sum(d for d, _ in found), Counter()
    for d, k in found:
        each[k] += d
    return Counter((i, k, d, each[k], total, tuple(centers[k])) for (i, _), (d, k) in zip(kept, found))


@pytest.mark.parametrize("block,chunk", [(2, 50), (3, 7), (64, 1000)])
def test_clusters_equal_brute_force(spark, block, chunk):
    rng = random.Random(block)
    o = centroids.CentroidOptions(clusters=5, dims=8, block=block, chunk=chunk)
    rows = [(i, [rng.choice([-3.0, -0.011, 0.0, 0.2, 1.0, rng.uniform(-2, 2)]) for _ in range(8)]) for i in range(150)]
    rows += [(900, [0.5] * 8)] * 60 + [(None, [0.25] * 8), (1, None), (2, []), (3, [0.1] * 7), (4, [None] + [0.1] * 7)]
    rows += [(5, [float("nan")] + [0.1] * 7), (6, [float("inf")] * 8), (7, [0.1] * 9), (8, [1e6] * 8)]
    frame = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, cluster int, distance int").repartition(4)
    rounded = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = Counter((*r[:5], tuple(r.centroid)) for r in centroids.clustered(frame, o).collect())
    assert got == brute_clusters(rounded, o)


def test_few_no_and_too_large_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    o = centroids.CentroidOptions(dims=2)
    assert centroids.clustered(spark.createDataFrame([], schema), o).collect() == []
    few = centroids.clustered(spark.createDataFrame([(1, [0.5, 1.0]), (2, [0.5, 1.0])], schema), o).collect()
    assert [(r.cluster, r.distance, r.inertia) for r in few] == [(0, 0, 0)] * 2
    with pytest.raises(Exception, match="would not fit 64 bits"):
        centroids.clustered(spark.createDataFrame([(1, [1e300, 1.0])], schema), o).collect()


def test_a_hot_vector_is_one_code(spark):
    """A vector in a third of all rows is one entry of each dictionary of its chunk."""
    rows = spark.range(3000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, F.array_repeat(F.lit(0.5), 64)).otherwise(F.transform(F.sequence(F.lit(1), F.lit(64)), lambda d: (F.pmod(F.hash("id", d), F.lit(40)) / 64.0))).alias("embedding"))
    found = centroids.clustered(rows)
    assert found.count() == 3000
    assert found.where("vec_id % 3 = 0").select("cluster", "distance").distinct().count() == 1
