"""Each operator against a brute-force version on small tables, with the odd cases of a contract."""

import hashlib
import math
import random
import re
import textwrap
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsloom.llm import anchors, boosting, decontamination, language, licences, packing, personal, quality, quartiles, setsketch, token_counts, tokens
from newsloom.llm.tables import sampled
from newsloom.operators.components import components
from newsloom.session import stage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, key string, places int, component string"


def words(rng, n, size=400):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def edited(rng, text, changes):
    parts = text.split(" ")
    for _ in range(changes):
        parts[rng.randrange(len(parts))] = f"x{rng.randrange(10**6)}"
    return " ".join(parts)


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies, shared passages, short, odd, empty and null texts."""
    rng = random.Random(5)
    base, shared = words(rng, 120), words(rng, 60, 10**6)
    rows = [words(rng, rng.randrange(30, 200)) for _ in range(25)]
    rows += [base] * 4 + [edited(rng, base, k % 6) for k in range(30)]
    rows += [words(rng, 20) + "\n" + shared + "\t" + words(rng, 15) for _ in range(6)]
    rows += [shared + " " + shared, "", None, " \n\t ", "one", "One", "one two", "a b a b", "ÉtÉ a b c", words(rng, 21), "z " * 3000]
    return rows


def frame(spark, texts, ids=None):
    ids = ids or [3 * i - 7 for i in range(len(texts))]
    return spark.createDataFrame([(i, t, "k", 1, "c") for i, t in zip(ids, texts)], SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# near duplicates -------------------------------------------------------------------------
def brute_components(texts, ids, size, percent):
    sets = {}
    for i, t in zip(ids, texts):
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    label = {i: i for i in ids}
    changed = True
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if (label[a], label[b]) != (low, low):
                label[a] = label[b] = low
                changed = True
    return sets, label


@pytest.mark.parametrize("options", [setsketch.CONTRACT, setsketch.SketchOptions()])
def test_near_duplicates(spark, texts, options):
    ids = [3 * i - 7 for i in range(len(texts))]
    got = rows_of(setsketch.near_duplicates(frame(spark, texts), options))
    sets, label = brute_components(texts, ids, options.words, options.percent)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(sets[i]), label[i], label[i] == i) for i in ids}


def test_near_duplicates_odd_tables(spark):
    assert setsketch.near_duplicates(empty(spark)).collect() == []
    rows = spark.createDataFrame([(None, "a b c d", "", 1, ""), (2, "a b c d", "", 1, ""), (2, "a b c d", "", 1, ""), (1, "a b c d", "", 1, "")], SCHEMA)
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in setsketch.near_duplicates(rows).collect())
    assert got == [(0, 0, True), (1, 1, True), (2, 1, False), (2, 1, False)]


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    options = setsketch.SketchOptions()
    a, b = rng.integers(0, 2**63, 900).astype(np.uint64), rng.integers(0, 2**63, 900).astype(np.uint64)
    b[:700] = a[:700]

    def registers(values):
        return setsketch.truncated(setsketch.earliest_points(values, np.zeros(len(values)), 1, options.registers), options)

    both = registers(np.union1d(a, b))
    assert (setsketch.merge(registers(a), registers(b)) == both).all()
    size = np.array([900.0])
    assert abs(setsketch.estimate(registers(a), registers(b), size, size, options.base)[0] - 700 / 1100) < 0.12
    assert setsketch.estimate(registers(a), registers(a), size, size, options.base)[0] > 0.97


def test_components_of_paths_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    edges = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in edges]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), stage).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200, 202: 200}


# repeats ---------------------------------------------------------------------------------
def brute_repeats(texts, ids, window):
    seen, out = set(), {}
    for i, t in sorted(zip(ids, texts)):
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            if k in seen:
                gone[s : s + window] = [True] * window
            seen.add(k)
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))
    return out


@pytest.mark.parametrize("window", [20, 7])
def test_repeats(spark, texts, window):
    ids = [3 * i - 7 for i in range(len(texts))]
    got = rows_of(anchors.without_repeats(frame(spark, texts), anchors.RepeatOptions(window)))
    expected = brute_repeats(texts, ids, window)
    assert {i: (r.n_words, sum(x.finish - x.begin for x in r.repeats), r.text) for i, r in got.items()} == expected
    for r in got.values():
        assert all(a.finish < b.begin for a, b in zip(r.repeats, r.repeats[1:]))


def test_repeats_odd_tables(spark):
    assert anchors.without_repeats(empty(spark)).collect() == []
    text = " ".join(map(str, range(30)))
    rows = spark.createDataFrame([(None, text, "", 1, ""), (2, text, "", 1, ""), (2, text, "", 1, ""), (5, text, "", 1, "")], SCHEMA)
    got = sorted((r.doc_id or 0, r.text) for r in anchors.without_repeats(rows).collect())
    assert got == [(0, text), (2, text), (2, text), (5, "")]


def test_repeats_with_very_many_documents_in_one_batch(spark):
    """More documents in a batch than a 16-bit number counts."""
    n, again = 80_000, 9_000
    number = F.when(F.col("id") >= n - again, F.col("id") - (n - again)).otherwise(F.col("id"))
    text = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(20)), lambda i: F.concat(F.lit("w"), F.hash(number, i).cast("string"))), " ")
    docs = spark.range(n).select(F.col("id").alias("doc_id"), text.alias("text")).coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100000")
    try:
        found = anchors.without_repeats(docs).where("size(repeats) > 0").agg(F.count("*"), F.min("doc_id")).first()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert tuple(found) == (again, n - again)



# packing ---------------------------------------------------------------------------------
@pytest.mark.parametrize("window", [4096, 64])
def test_packing(spark, texts, window):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = [*texts, "Straße İx ΣΣ é", "don't WE'LL 12 ²½_a--b", "<|endoftext|> x", "a\x1cb"]
    got = packing.packed(frame(spark, texts), packing.PackOptions(window=window, tokenizer=path)).toPandas()
    tokenizer = Tokenizer.from_file(path)
    ids = {3 * i - 7: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    for doc_id, own in got.sort_values("start").groupby("doc_id"):
        assert own.start.tolist() == [0, *own.length.cumsum()[:-1]] and own.length.sum() == len(ids[doc_id])
    for r in got.itertuples():
        piece = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4").tobytes()
        assert (r.ids_crc32, r.doc_tokens) == (zlib.crc32(piece), len(ids[r.doc_id]))
    assert set(got.doc_id) == set(ids)
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *own.length.cumsum()[:-1]] and own.length.sum() <= window
    assert sorted(set(got.sequence_id)) == list(range(got.sequence_id.nunique()))
    assert got.sequence_id.nunique() <= -(-got.length.sum() // window) * 1.1 + 1


def test_word_memory_is_bounded_by_bytes(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(4)
    word = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz\u00e9", k=n))
    texts = [" ".join(word(9) for _ in range(2000)) for _ in range(50)]
    texts += [" ".join(word(rng.choice([1, 3, 3000])) for _ in range(300)), "x" * 9000, "a\n\t b" * 3000, "it's 12% \u00b2 DON'T " * 900, "", None]
    monkeypatch.setattr(tokens, "MEMORY", 2 << 20)
    monkeypatch.setattr(tokens, "SLICE", 4000, raising=False)
    encoder = tokens.WordTokens(path)
    sums = []
    tracemalloc.start()
    try:
        for ids in encoder.encode(texts):
            sums.append(zlib.crc32(ids))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 12 << 20
    tokenizer = Tokenizer.from_file(path)
    assert sums == [zlib.crc32(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids, dtype="<u4").tobytes()) for t in texts]


def test_only_fresh_and_odd_words_reach_the_tokenizer(monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=8))
    common = [word() for _ in range(300)]
    odd = ["\u201cquoted\u201d", "\u03a3\u0391\u03a3", "\u4e2d\u6587", "e\u0301t\u00e9\u0307\u0323", "a\u00a0b\u2028c", "x\x0by", "\u0130I", "<|endoftext|>", "it's"]
    texts = [" ".join(rng.sample(common, 300) + [word() for _ in range(300)] + odd[k % 9 :]) for k in range(60)]
    monkeypatch.setattr(tokens, "MEMORY", 1 << 20)  # of over 3 MB
    monkeypatch.setattr(tokens, "SLICE", 1 << 14)
    encoder = tokens.WordTokens(path)
    met = Counter()
    for name in ("_ids", "_of_words", "_of_pieces"):
        if read := getattr(encoder, name, None):
            monkeypatch.setattr(encoder, name, lambda words, read=read: met.update(" ".join(words).split(" ")) or read(words))
    got = [zlib.crc32(ids) for ids in encoder.encode(texts)]
    assert max(met[w] for w in common) == 1  # in spite of texts with odd words, and of a full memory
    tokenizer = Tokenizer.from_file(path)
    assert got == [zlib.crc32(np.array(tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()) for t in texts]


def test_packing_odd_tables(spark):
    options = packing.PackOptions(tokenizer=public_tokenizers.path("word_bpe_49k.json"))
    assert packing.packed(empty(spark), options).collect() == []
    rows = spark.createDataFrame([(None, None, "", 1, ""), (2, "a", "", 1, ""), (2, "a", "", 1, "")], SCHEMA)
    got = packing.packed(rows, options).collect()
    assert sorted((r.doc_id or 0, r.length) for r in got) == [(0, 1), (2, 2), (2, 2)]
    assert len({(r.sequence_id, r.offset) for r in got}) == 3


def test_least_squares_reaches_a_known_solution():
    counts = np.zeros(101, dtype=np.int64)
    counts[[60, 40, 50, 25]] = [30, 30, 20, 40]
    columns = [(60, 40), (50, 50), (25, 25, 25, 25), (50, 25, 25)]
    x = packing.non_negative_least_squares(columns, counts, 200)
    assert (x >= 0).all() and abs(x[0] - 30) < 0.1
    patterns = packing.plan(counts, packing.PackOptions(window=100))
    used = Counter()
    for lengths, repeat in patterns:
        assert sum(lengths) <= 100
        for n in lengths:
            used[n] += repeat
    assert used == {60: 30, 40: 30, 50: 20, 25: 40} and sum(r for _, r in patterns) == 50


# decontamination -------------------------------------------------------------------------
def test_contamination_equals_all_windows(spark):
    rng = random.Random(9)
    items = {i: words(rng, n, 3000) for i, n in enumerate([12, 40, 70, 40, 3, 5])}
    items[6], items[7], items[8] = items[1], "", None
    docs = []
    for k in range(60):
        body = words(rng, rng.randrange(0, 120), 3000)
        item = items[rng.randrange(6)]
        passage = edited(rng, item, rng.randrange(0, 3)).replace(" ", rng.choice([" ", ", ", "\n"])) if k % 3 else ""
        if passage and k % 5 == 0:
            passage = passage.split(" ", 1)[-1]
        docs.append(f"{body} {passage.upper() if k % 2 else passage} {words(rng, 10, 3000)}".strip())
    docs += ["", None, items[4], "w1 w2"]

    def runs(t):
        w = [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else ([tuple(w)] if w else [])

    expected = {}
    for i, t in enumerate(docs):
        s, found = runs(t), {}
        for k, item in items.items():
            want = runs(item)
            best = 0.0
            for a in range(max(1, len(s) - len(want) + 1)):
                win = s[a : a + len(want)]
                common = sum((Counter(win) & Counter(want)).values())
                best = max(best, common / max(1, len(win) + len(want) - common))
            if best >= 0.8:
                found[k] = best
        expected[i] = (bool(found), len(found), round(max(found.values(), default=0.0), 9))
    bench = spark.createDataFrame([(k, t, 1) for k, t in items.items()], "item_id long, text string, place int")
    got = rows_of(decontamination.contamination(frame(spark, docs, list(range(len(docs)))), bench))
    assert {i: (r.contaminated, r.n_items, round(r.similarity, 9)) for i, r in got.items()} == expected
    assert sum(e[0] for e in expected.values()) > 10


def best_windows(text, items):
    def runs(t):
        w = t.lower().split()
        return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else ([tuple(w)] if w else [])

    s, found = runs(text), {}
    for k, want in ((k, runs(t)) for k, t in items):
        for a in range(max(1, len(s) - len(want) + 1)):
            win = s[a : a + len(want)]
            common = sum((Counter(win) & Counter(want)).values())
            found[k] = max(found.get(k, 0.0), common / max(1, len(win) + len(want) - common))
    return {k: v for k, v in found.items() if v >= 0.8}


def test_contamination_of_passages_edited_in_many_places(spark):
    rng = random.Random(21)
    items = [(0, words(rng, 104, 10**6)), (1, words(rng, 150, 10**6)), (2, words(rng, 60, 3)), (3, words(rng, 30, 10**6) + " " + "a b c " * 20)]
    items += [(4, words(rng, 90, 10**6)), (4, words(rng, 110, 10**6)), (5, "z " * 40)]
    parts = items[0][1].split()
    parts[2], parts[-3] = "changed", "changed"
    between = [*parts[:52], *"six words put in the middle".split(), *parts[52:]]
    docs = [words(rng, 40, 10**6) + " " + " ".join(between) + " " + words(rng, 40, 10**6)]
    for k in range(150):
        parts = rng.choice(items)[1].split()
        for _ in range(rng.randrange(0, 5)):
            at, n = rng.choice([rng.randrange(len(parts)), rng.randrange(4), len(parts) - 1 - rng.randrange(4)]), rng.randrange(0, 5)
            parts[at : at + rng.choice([0, 0, 1, n])] = words(rng, rng.choice([0, 1, n]), rng.choice([3, 10**6])).split()
        docs.append(" ".join([*words(rng, rng.randrange(30), 3).split(), *parts, *words(rng, rng.randrange(30), rng.choice([3, 10**6])).split()]))
    ids = [i if i % 20 else 0 for i in range(len(docs))]
    expected = {}
    for i, t in zip(ids, docs):
        for k, v in best_windows(t, items).items():
            expected.setdefault(i, {})[k] = max(v, expected.get(i, {}).get(k, 0.0))
    bench = spark.createDataFrame(items, "item_id long, text string")
    wide = decontamination.MatchOptions(radius=64)
    for options in (None, wide):
        got = {(r.doc_id, r.n_items, r.item_id, round(r.similarity, 9)) for r in decontamination.contamination(frame(spark, docs, ids), bench, options).collect()}
        best = {i: min((-v, k) for k, v in expected[i].items()) if i in expected else (0.0, None) for i in ids}
        assert got == {(i, len(expected.get(i, {})), best[i][1], round(-best[i][0], 9)) for i in ids}
    assert 0 in best_windows(docs[0], items) and 30 < len(expected) < len(set(ids))


def test_contamination_odd_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(empty(spark), none).collect() == []
    got = decontamination.contamination(frame(spark, ["a b c d e f", None]), none).collect()
    assert [(r.contaminated, r.item_id) for r in got] == [(False, None)] * 2


# personal data ---------------------------------------------------------------------------
def brute_spans(text):
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and personal.luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15),
    ]
    found = [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, rule, good) in enumerate(rules) for m in re.finditer(rule, text) if good(m[0])]
    return ",".join(x[2] for x in sorted(found))


def test_base_spans_on_random_texts():
    rng = random.Random(4)
    bits = ["a@b.c", "_d@e.f", "@", ".", "a", "+1 ", "(859) 555-5442", "4551385696224088", "-", " ", "1.2.3.4", "256.1.1.1", "007.1.2.3", "9" * 20, "é", "12-34", "+", "a.b@c", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 9)))
        assert personal.joined(personal.base_spans(text)) == brute_spans(text), text
    assert personal.base_spans("a" * 200_000 + "@") == []


def test_personal_data_adds_spans_and_redacts(spark):
    rng = random.Random(6)

    def card():
        head = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        return next(head + c for c in "0123456789" if personal.luhn(head + c))

    def phone():
        return f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"

    rows = [f"la {rng.choice([card(), phone(), f'u{k}.x@mail{k}.example.com', f'10.{k % 250}.3.4'])} end {rng.randrange(1, 99)} of 3.{k}" for k in range(400)]
    pair = f"see {card()} {phone()} now"
    rows += [pair, None, "", "no digits", "version 3.0 of 2024"]
    docs = frame(spark, rows)
    model = personal.fit(docs.select("doc_id", "text"))
    got = [r for r in personal.personal_data(docs, model, carry=("key",)).collect()]
    by_id = {r.doc_id: r for r in got}
    for i, t in enumerate(rows):
        r = by_id[3 * i - 7]
        assert r.base == brute_spans(t or "") and set(filter(None, r.base.split(","))) <= set(r.spans.split(",")) and r.key == "k"
    assert by_id[3 * 402 - 7].text == "" and by_id[3 * 404 - 7].text == "version 3.0 of 2024"
    assert "[" not in by_id[3 * 403 - 7].text
    assert personal.redact("abcdef", [(1, 3, 0), (2, 4, 2), (5, 6, 1)]) == "a[EMAIL]e[IP]"
    assert personal.fit(empty(spark).select("doc_id", "text")) is None
    assert personal.personal_data(empty(spark), None).collect() == []


WRITTEN_OUT = ["jane.doe at example dot com", "jane[at]example[dot]com", "Jane.Doe AT Example DOT Com", "jane(AT)example(DOT)com", "jane [AT] example [dot] com"]


@pytest.mark.parametrize("address", WRITTEN_OUT)
def test_written_out_addresses_are_proposed(address):
    class Sure:
        def probability(self, x):
            return np.ones(len(x))

    text = f"write to {address} soon"
    wanted = (9, 9 + len(address), 0)
    assert wanted in personal.proposals(text)
    assert personal.find(text, personal.SpanModel(Sure(), (0.5,) * 4)) == ([], [wanted])
    assert personal.find(text, None) == ([], [])
    assert personal.find(text.replace(address, "nobody"), personal.SpanModel(Sure(), (0.5,) * 4)) == ([], [])


def test_written_out_addresses_are_redacted_without_digits(spark):
    rng = random.Random(3)
    names = [w + x for w in ("jo", "an", "ed", "su", "li", "max", "kim") for x in ("na", "dor", "vic", "rex")]
    rows = [f"see {rng.choice(names)}.{rng.choice(names)}@{rng.choice(names)}.example.com now" for _ in range(300)]
    rows += [f"we met at {rng.choice(names)}. Then we left at {rng.choice(names)} with {rng.choice(names)}" for _ in range(60)]
    docs = frame(spark, rows)
    model = personal.fit(docs.select("doc_id", "text"))
    for address in ["jona.kimrex at maxdor.example dot com", "jona.kimrex AT maxdor DOT example DOT com", "jona.kimrex[AT]maxdor[DOT]example[DOT]com"]:
        text = f"see {address} now"
        assert personal.redact(text, personal.find(text, model)[1]) == "see [EMAIL] now", address
    # documents without digits and '@' are part of the sample
    assert personal.fit(frame(spark, rows[300:]).select("doc_id", "text")) is None
    assert personal.find(rows[310], model) == ([], [])


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((1500, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(int)
    model = boosting.train(x[:800], y[:800])
    boosting.calibrate(model, x[800:1000], y[800:1000])
    p = model.probability(x[1000:])
    assert ((p > 0.5) == y[1000:]).mean() > 0.95


def test_calibration_is_damped_and_thresholds_hold_on_unseen_rows():
    """Separable rows would drive an undamped fit to infinity; noisy ones get a threshold that keeps."""
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    sure = boosting.train(x[:500], (x[:500, 0] > 0.5).astype(int))
    with np.errstate(all="raise"):
        boosting.calibrate(sure, x[500:900], (x[500:900, 0] > 0.5).astype(int))
    assert np.isfinite([sure.slope, sure.shift]).all() and sure.slope > 0
    boosting.calibrate(sure, x[:100], np.ones(100))  # one class only: stays as it is
    y = (rng.random(3000) < np.where(x[:, 1] > 0.6, 0.98, 0.1)).astype(int)
    noisy = boosting.train(x[:1000], y[:1000])
    boosting.calibrate(noisy, x[1000:1500], y[1000:1500])
    limit = boosting.threshold(noisy, x[1500:2000], y[1500:2000], 0.95)
    taken = noisy.probability(x[2000:]) >= limit
    assert y[2000:][taken].mean() > 0.92 and taken.mean() > 0.25
    assert boosting.threshold(noisy, x[:50], np.zeros(50), 0.9) == boosting.NEVER


def test_added_spans_on_unseen_forms(spark):
    """Planted forms that no rule finds and training has not seen: most are added, little else is."""
    rng = random.Random(16)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card(gap):
        head = "5" + digits(14)
        number = next(head + c for c in "0123456789" if personal.luhn(head + c))
        return gap.join(number[i : i + 4] for i in range(0, 16, 4))

    def base(k):
        return [card(" "), card(""), f"+1 {rng.randrange(200, 999)} 555 {digits(4)}", f"u{k}.x@mail{k}.example.com", f"10.{k % 250}.3.4"][k % 5]

    train = [f"la {base(k)} end {rng.randrange(1, 99)} of 3.{k} in {rng.randrange(1900, 2030)} no {digits(rng.randrange(5, 14))} x" for k in range(600)]
    model = personal.fit(frame(spark, train).select("doc_id", "text"))
    hits = wrong = missed = 0
    for k in range(300):
        planted = [f"({rng.randrange(200, 999)}) {digits(3)}-{digits(4)}", f"an.na{k} at host{k} dot org", f"jo[at]site{k}[dot]net"][k % 3]
        text = f"then call {planted} and order {digits(rng.randrange(4, 7))} of {rng.randrange(1900, 2030)}"
        wanted = (10, 10 + len(planted))
        found, spans = personal.find(text, model)
        added = {s[:2] for s in spans} - {s[:2] for s in found}
        hits += wanted in added
        missed += wanted not in added
        wrong += len(added - {wanted})
    assert hits / (hits + missed) > 0.5 and hits / max(hits + wrong, 1) > 0.9, (hits, missed, wrong)


def test_one_long_directory_takes_little_time():
    class Sure:
        def probability(self, x):
            return np.linspace(0.6, 0.9, len(x))

    text = "\n".join(f"jo.doe{k}[at]mail{k}[dot]org" for k in range(20_000))
    base, spans = personal.find(text, personal.SpanModel(Sure(), (0.5,) * 4))
    assert base == [] and len(spans) == 20_000


def test_a_bounded_sample_moves_ids_first(spark):
    rows = spark.range(5000).select((F.col("id") % 700).alias("doc_id"), F.col("id").cast("string").alias("text"), F.lit("xx").alias("lang"))
    some = sampled(rows, 300)
    got = some.collect()
    assert len(got) == len({r.doc_id for r in got}) == 300 and some.columns == ["doc_id", "text", "lang"]
    assert got and sorted(map(tuple, got)) == sorted(map(tuple, sampled(rows.repartition(7), 300).collect()))
    assert sampled(rows.limit(0), 10).collect() == [] and sampled(rows, 10**6).count() == 700


# quality ---------------------------------------------------------------------------------
def test_sum_of_squares_identity():
    rng = np.random.default_rng(3)
    machine = quality.Machine(0.3, rng.normal(size=20), rng.normal(size=(20, 3)))
    index, value = np.array([2, 5, 11, 4]), rng.normal(size=4)
    slow = 0.3 + (machine.linear[index] * value).sum()
    for a in range(4):
        for b in range(a + 1, 4):
            slow += machine.factors[index[a]] @ machine.factors[index[b]] * value[a] * value[b]
    assert machine.margin(index, value, np.array([0, 4])) == pytest.approx([slow])


def test_quality_on_held_out_rows(spark, sf_dir):
    root = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet")
    options = quality.FmOptions()
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    machine = quality.fit(docs, labels, ~held, options)
    got = quality.scored(docs, machine, options).join(labels, "doc_id").where(held).toPandas()
    assert ((got.score >= 0.7) == got.quality).mean() > 0.93
    odd = docs.select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("long").alias("n_chars")).limit(1)
    assert 0 <= quality.scored(odd, machine, options).first().score <= 1
    assert quality.scored(odd.limit(0), machine, options).collect() == []
    blank = quality.fit(docs, labels.limit(0), ~held, options)
    assert 0 < quality.scored(docs.limit(3), blank, options).first().score < 1


# fingerprints ----------------------------------------------------------------------------
def slow_digest(data):
    """The fingerprint by plain counting: every triplet of every window of five bytes."""
    counts = [0] * 256
    for start in range(len(data)):
        for k, (second, third) in enumerate([(1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4)]):
            if start + third < len(data):
                code = data[start] + 256 * data[start + second] + 65536 * data[start + third]
                code = (code + (k + 1) * 0x01000193) % 2**32
                code = (code ^ (code >> 15)) * int(quartiles._FACTORS[k]) % 2**32
                counts[code >> 24] += 1
    ranked = sorted(counts)
    q1, q2, q3 = ranked[63], ranked[127], ranked[191]
    codes = [sum(c > q for q in (q1, q2, q3)) for c in counts]
    body = bytes(64 * a + 16 * b + 4 * c + d for a, b, c, d in zip(*[iter(codes)] * 4))
    length = min(255, round(10 * math.log2(len(data) + 1)))
    ratios = [min(15, 16 * q // max(q3, 1)) for q in (q1, q2)]
    check = hashlib.blake2b(data, digest_size=1).digest()[0]
    return bytes([check, length, 16 * ratios[0] + ratios[1], min(255, q3.bit_length())]).hex() + body.hex()


@pytest.mark.parametrize("parts", ["1", "3", "40"])
def test_successors_over_any_number_of_ranges(spark, parts):
    """Ranges of many rows, of one row and of none; repeated ids, equal rows and rows without an id."""
    rng = random.Random(int(parts))
    rows = [(i, words(rng, 8)) for i in range(25)] + [(None, "x y"), (None, None), (7, "seven"), (7, "seven"), (7, None)]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = quartiles.compared(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    by_id = {i: t for i, t in rows if i is not None and i != 7}
    for r in got:
        if r.doc_id in by_id and (r.doc_id + 1) % 25 in by_id and r.doc_id != 24:
            text, after = by_id[r.doc_id], by_id[r.doc_id + 1]
            half = len(text) // 2
            assert r.edited_sha256 == hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()
    same = [r for r in got if r.doc_id == 7 and r.n_chars == 5]
    assert len(same) == 2 and any(r.near_next == 1 for r in same)


def test_fingerprints_of_texts_and_their_successors(spark, texts):
    ids = [3 * i - 7 for i in range(len(texts))]
    got = rows_of(quartiles.compared(frame(spark, texts)))
    for k, i in enumerate(ids):
        text, after = texts[k] or "", texts[(k + 1) % len(texts)] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (slow_digest(text.encode()), slow_digest(changed.encode()))
        assert 0 <= r.near_next <= 1 and (text != after or r.near_next == 1)
    assert quartiles.compared(empty(spark)).collect() == []
    one = quartiles.compared(frame(spark, ["abcdefgh"])).collect()
    assert [(r.n_chars, r.near_next) for r in one] == [(8, 1.0)]


def test_likeness_prefers_edits_to_other_texts():
    rng = random.Random(8)
    better = 0
    for _ in range(60):
        a, b = words(rng, 200, 60), words(rng, 200, 60)
        half = a[: len(a) // 2] + b[: len(a) // 2]
        x, y, z = (quartiles.digest(t.encode()) for t in (a, half, b))
        better += quartiles.likeness(x, y) > quartiles.likeness(x, z)
        assert quartiles.likeness(x, z) == quartiles.likeness(z, x) and quartiles.likeness(x, x) == 1
    assert better > 55


# token counts ----------------------------------------------------------------------------
OPTIONS = token_counts.CountOptions(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def test_trees_follow_random_edits():
    rng, encoder = random.Random(3), token_counts.encoding(OPTIONS)
    letters = "ab 1.,'\n\ts éß中 \x1c ve"
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(0, 1800)))
        tree = token_counts.TokenTree.build(text, encoder)
        for _ in range(5):
            added = "".join(rng.choice(letters) for _ in range(rng.randrange(0, rng.choice([3, 40, 1500]))))
            text, tree, _ = tree.edit(text, rng.randrange(-2, len(text) + 5), rng.randrange(0, rng.choice([3, 900])), added, encoder)
            assert (tree.total, tree.chars[1]) == (len(encoder.encode_ordinary(text)), len(text))


def test_small_edits_encode_little():
    encoder = token_counts.encoding(OPTIONS)
    text = "some words of a text " * 5000
    _, _, encoded = token_counts.TokenTree.build(text, encoder).edit(text, 50_000, 3, "x", encoder)
    assert encoded < 4 * token_counts.LEAF


def test_recounted_tables(spark, texts):
    encoder = token_counts.encoding(OPTIONS)
    index = token_counts.indexed(frame(spark, texts), OPTIONS, carry=("key",))
    edits = F.when(F.col("doc_id") % 2 == 0, F.array(F.struct(F.lit(3).alias("place"), F.lit(2).alias("removed"), F.lit("new word").alias("added")), F.lit(None).cast("struct<place: int, removed: int, added: string>")))
    got = rows_of(token_counts.recounted(index, edits, OPTIONS))
    for k, t in enumerate(texts):
        i, t = 3 * k - 7, t or ""
        at = min(3, len(t))
        changed = t[:at] + "new word" + t[at + 2 :] if i % 2 == 0 else t
        assert (got[i].text, got[i].tokens[1], got[i].n_before) == (changed, len(encoder.encode_ordinary(changed)), len(encoder.encode_ordinary(t)))
    assert token_counts.recounted(token_counts.indexed(empty(spark), OPTIONS), edits, OPTIONS).collect() == []


# language --------------------------------------------------------------------------------
def test_language_evidence(spark):
    rng = random.Random(12)
    sounds = {"xx": ["ba", "do", "mi"], "yy": ["shu", "krr", "tza"]}

    def text(name, n):
        return " ".join("".join(rng.choice(sounds[name]) for _ in range(3)) for _ in range(n))

    train = [(i, text(n, 60), n) for i, n in enumerate(["xx", "yy"] * 30)]
    options = language.LanguageOptions()
    model = language.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"), options)
    assert model.languages == ["xx", "yy"]
    rows = [(i, text(n, 40), n if i % 7 else "zz", "s1" if n == "xx" else "s2", f"h{n}", 1.0) for i, n in enumerate(["xx", "yy"] * 40)]
    rows += [(1000, "123 456", "xx", "s1", "hxx", 0.0), (1001, None, None, None, None, 0.0), (1002, "bb", None, None, None, None), (1003, text("yy", 40), "xx", "s1", "hxx", 0.0), (None, text("xx", 9), None, None, None, 0.0)]
    schema = "doc_id long, text string, declared string, suffix string, host string, mass double"
    got = rows_of(language.identified(spark.createDataFrame(rows, schema), model, options))
    assert all(got[i].language == ("xx", "yy")[i % 2] for i in range(80))
    assert got[1000].language == got[1001].language == "und" and got[1003].language == "yy" and got[None].language == "xx"
    assert language.identified(spark.createDataFrame([], schema), model, options).collect() == []


def brute_fusion(rows, model, o):
    """The fusion row by row: trigrams, confusion table, three smoothed levels without the row itself."""
    width = len(model.languages)
    softmax = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    letter = lambda b: b >= 128 or chr(b).isalpha()
    found = []
    for _, text, declared, suffix, host in rows:
        data = (text or "").encode()
        grams = [data[i : i + 3] for i in range(len(data) - 2) if sum(map(letter, data[i : i + 3])) >= 2]
        places = [int(language._trigrams(np.frombuffer(g, np.uint8), o.bits)[0]) for g in grams]
        like = sum((model.logs[p].astype(float) for p in places), np.zeros(width)) / (1 + len(grams) / o.effective)
        said = re.match("[A-Za-z]+", declared or "")
        found.append((len(grams), like, softmax(like), said[0].lower() if said else None, suffix and suffix.lower(), host and host.lower()))
    sure = [f for f in found if f[0]]
    total = sum((f[2] for f in sure), np.zeros(width))
    overall = (total + 1) / (total.sum() + width)
    table = np.array([sum((f[2] for f in sure if f[3] == name), np.zeros(width)) for name in model.languages]) + 0.5
    spoken = np.log(table / table.sum(axis=0))
    out = []
    for n, like, posterior, said, suffix, host in found:
        own = posterior if n else np.zeros(width)
        prior = overall
        for level, value in ((4, suffix), (5, host)):
            mass = np.zeros(width) if value is None else np.maximum(sum((f[2] for f in sure if f[level] == value), np.zeros(width)) - own, 0)
            prior = (mass + o.strength * prior) / (mass.sum() + o.strength)
        extra = spoken[model.languages.index(said)] if said in model.languages else np.zeros(width)
        fused = softmax(like + extra + np.log(prior))
        best = int(fused.argmax())
        text_best = model.languages[int(posterior.argmax())] if n else "und"
        out.append((model.languages[best] if n and fused[best] >= o.least else "und", float(fused[best]), text_best, n))
    return out


def test_fusion_equals_brute_force(spark):
    rng = random.Random(21)
    sounds = {"aa": "ba do mi", "bb": "shu krr ba", "cc": "éta ño mi"}
    text = lambda name, n: " ".join("".join(rng.choice(sounds[name].split()) for _ in range(2)) for _ in range(n))
    train = [(i, text(name, 30), name) for i, name in enumerate(["aa", "bb", "cc"] * 12)]
    o = language.LanguageOptions()
    model = language.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"), o)
    rows = []
    for i in range(120):
        name = rng.choice(["aa", "bb", "cc"])
        declared = rng.choice([name, name, name.upper() + "-XX", "zz", None, rng.choice(["aa", "bb", "cc"])])
        rows.append((i, rng.choice([text(name, rng.choice([1, 2, 20])), "12 3", None, "ba"]), declared, rng.choice([None, "S" + name, "s" + name]), rng.choice([None, f"H{name}1", f"h{name}2", "one"])))
    frame_ = spark.createDataFrame(rows, "doc_id long, text string, declared string, suffix string, host string").repartition(3)
    got = rows_of(language.identified(frame_, model, o))
    for row, expected in zip(rows, brute_fusion(rows, model, o)):
        r = got[row[0]]
        assert (r.language, r.text_language, r.n_grams) == (expected[0], *expected[2:]) and r.probability == pytest.approx(expected[1], rel=1e-9)


def test_language_without_declarations_on_unseen_rows(spark):
    """What text and source say alone, on rows that training has not read."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    train = docs.where("doc_id % 2 = 0")
    model = language.fit(train, language.LanguageOptions())
    evidence = language.document_evidence(docs.where("doc_id % 2 = 1")).withColumn("declared", F.lit(None).cast("string"))
    found = language.identified(evidence, model).join(docs.select("doc_id", "lang", "n_chars"), "doc_id").where("n_chars > 100")
    rows = found.collect()
    assert sum(r.language == r.lang for r in rows) / len(rows) > 0.97


def test_language_workers_hold_little(monkeypatch):
    """Trigrams of a full batch and of a long text are taken in small slices, with the same sums."""
    rng = random.Random(8)
    text = lambda n: "".join(rng.choices("abcdefghijklmno 1é", k=n))
    texts = [text(rng.randrange(3000)) for _ in range(1200)] + ["", None, "ab", "é" * 9, text(700_000)]
    batch = pa.record_batch([pa.array(texts), pa.array(range(len(texts)))], names=["text", "doc_id"])
    o = language.LanguageOptions()
    model = language.TextModel(["xx", "yy"], np.log(np.random.default_rng(8).random((1 << o.bits, 2))).astype(np.float32))
    tracemalloc.start()
    try:
        found = list(language.likelihoods(model, o)([batch]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 32 << 20
    monkeypatch.setattr(language, "SLICE_BYTES", 1 << 30)
    for got, expected in zip(found, language.likelihoods(model, o)([batch]), strict=True):
        assert got.column(1).equals(expected.column(1)) and got.column(1)[-1].as_py() > 500_000
        assert got.column(2)[:-1].equals(expected.column(2)[:-1])
        assert got.column(2)[-1].as_py() == pytest.approx(expected.column(2)[-1].as_py(), rel=1e-9)


def test_language_model_counts_every_trigram_of_long_texts(spark):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choices("abcdefghijklmno 1é", k=n))
    train = [(i, text(n), name) for i, (n, name) in enumerate([(300_000, "xx"), (99, "xx"), (600_000, "yy"), (1, "zz")])]
    train += [(100 + i, f"text number {i}", f"l{i}") for i in range(80)]
    o = language.LanguageOptions()
    model = language.fit(spark.createDataFrame(train, "doc_id long, text string, lang string").coalesce(1), o)
    assert model.languages == sorted({name for _, _, name in train})
    counts = np.full((1 << o.bits, len(model.languages)), 0.5)
    for _, text, name in train:
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        at, _ = language._usable(data, np.array([0, len(data)]))
        counts[:, model.languages.index(name)] += np.bincount(language._trigrams(data, o.bits)[at], minlength=1 << o.bits)
    assert np.array_equal(model.logs, np.log(counts / counts.sum(axis=0)).astype(np.float32))


def test_page_evidence(spark):
    html = [
        '<HTML LANG=pt-BR><script>let a = "<b>"</script><p>ol&aacute; <b>mundo</b><!-- não --></p>',
        "<html><body>x</body></html>", "", None, "<html lang='De'><style>p{}</style>t",
    ]
    urls = ["https://u:p@Www.Example.com.br:80/x", "ftp://h/", "no address", None, "http://a.de?x#y"]
    pages = spark.createDataFrame(list(zip(range(5), urls, html)), "page_id long, url string, html string")
    got = {r.doc_id: (re.sub(r"\s+", " ", r.text).strip(), r.declared, r.suffix, r.host) for r in language.page_evidence(pages).collect()}
    assert got == {
        0: ("ol mundo", "pt", "br", "Www.Example.com.br"), 1: ("x", None, "h", "h"), 2: ("", None, None, None),
        3: ("", None, None, None), 4: ("t", "De", "de", "a.de"),
    }


def test_host_prior_decides_when_the_text_does_not(spark):
    model = language.TextModel(["xx", "yy"], np.log(np.full((1 << 14, 2), 2.0**-14)).astype(np.float32))
    model.logs[language._trigrams(np.frombuffer(b"bba", np.uint8), 14)[0]] = np.log([0.5, 0.01])
    rows = [(i, "bba " * 30, None, "s", "h", 0.0) for i in range(200)] + [(900, "cdcd", None, "s", "h", 0.0), (901, "cdcd", None, None, None, 0.0)]
    got = rows_of(language.identified(spark.createDataFrame(rows, "doc_id long, text string, declared string, suffix string, host string, x double"), model))
    assert got[900].probability > got[901].probability > 0.5


# licences --------------------------------------------------------------------------------
def test_licence_digests(spark):
    mit = dict(licences.KNOWN)["MIT"]
    rows = [
        mit,
        "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ;").replace("SUBLICENSE", "sublicence"),
        mit + " and more",
        "words\n* Released under the MIT Licence!\nother\nReleased under the MIT license",
        "The above copyright notice",
        "",
        None,
        "Copyright 2020 x",
    ]
    got = rows_of(licences.licensed(frame(spark, rows, list(range(len(rows)))), licences.known_licences(spark)))
    assert [got[i].license_id for i in range(8)] == ["MIT", "MIT"] + [None] * 6
    assert (got[3].n_license_lines, got[3].license_lines) == (2, "MIT-notice")
    assert [got[i].digest is None for i in range(4, 8)] == [False, True, True, True]
    assert licences.licensed(empty(spark), licences.known_licences(spark)).collect() == []


def paragraphs(text):
    """Paragraphs in one line each; copyright statements keep theirs."""
    held = []
    for line in [*text.split("\n"), ""]:
        if line.strip() and not re.match(licences._COPYRIGHT, line.lower()):
            held.append(line)
            continue
        if held:
            yield " ".join(" ".join(held).split())
        held = []
        if line.strip():
            yield line


def test_wrapped_texts_have_the_same_digest(spark):
    """Every catalogue text in lines of 60 to 80 characters, in one line, and as it is."""
    rows, names = [], []
    for name, text in licences.catalogue():
        for width in (60, 72, 80, 10**6):
            lines = [p if re.match(licences._COPYRIGHT, p.lower()) else textwrap.fill(p, width, break_long_words=False, break_on_hyphens=False) for p in paragraphs(text)]
            rows.append("\n\n".join(lines))
            names.append(licences.plain_digest(text))
    docs = frame(spark, rows, list(range(len(rows))))
    got = rows_of(licences.licensed(docs, licences.known_licences(spark)))
    assert [got[i].digest for i in range(len(rows))] == names
    assert all(got[i].license_id for i in range(len(rows)))


def test_only_copyright_statements_are_dropped(spark):
    body = dict(licences.KNOWN)["ISC"]
    wrapped = body.replace("above copyright notice", "above\ncopyright notice")
    heads = ["Copyright (c) 2020, Someone\nAll rights reserved.\n", "/* (C) Copyright 1999-2004 A. Body */\n", "© 2020 Someone\n", "Copyright [yyyy] [name]\n", "  copyright by A. Body\n"]
    rows = [wrapped, *[h + "\n" + wrapped for h in heads], "copyright notice and this\n" + body, "(c) the following\n" + body]
    got = rows_of(licences.licensed(frame(spark, rows, list(range(len(rows)))), licences.known_licences(spark)))
    assert [got[i].license_id for i in range(len(rows))] == ["ISC"] * 6 + [None] * 2


def test_licences_with_titles_and_other_common_texts(spark):
    by_name = {}
    for name, text in licences.catalogue():
        by_name.setdefault(name, text)
    holder = "\n\nCopyright (c) 2021 Someone\n\n"
    names = ["MIT", "ISC", "Zlib", "BSD-2-Clause", "BSD-3-Clause"]
    rows = [licences.TITLES[n][0] + holder + by_name[n] for n in names]
    others = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "CC0-1.0"]
    rows += [by_name[n] for n in others] + ["x\nSPDX-License-Identifier: MPL-2.0\ny"]
    got = rows_of(licences.licensed(frame(spark, rows, list(range(len(rows)))), licences.known_licences(spark)))
    assert [got[i].license_id for i in range(len(rows) - 1)] == names + others
    assert got[len(rows) - 1].license_lines == "MPL-2.0-notice"
