"""Personal data: rule spans, and boosted trees over the spans of high-recall generators.

Four rules give the base spans. Generators then propose every contiguous part of a number run
that could be a card, phone or address of a machine, and mail addresses written out in words;
proposals overlap. Boosted trees score them by format and context, a threshold calibrated for
precision selects, and the best of overlapping proposals is added. Base spans always stay.

The trees are trained here on a bounded sample (:data:`SAMPLE_DOCUMENTS`,
:data:`SAMPLE_SPANS`): base spans and their rewritten forms are positive, other proposals and
damaged forms negative.
"""

from __future__ import annotations

import bisect
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.boosting import NEVER, Trees, calibrate, threshold, train
from newsloom.llm.tables import sampled

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCUMENTS = 1500
SAMPLE_SPANS = 30_000
PRECISION = 0.99
LEAST_HELD = 20  # held-out proposals of a kind, without which the kind gets no threshold

# A run of address characters is read once, whether or not a domain follows, so that long texts
# cost linear time; the other rules never start inside a run of digits for the same reason.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)?")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# What a generator needs in a text: an at-word or sign, or a digit. The second is also read by Spark.
_AT = r"@|\[(?i:at)\]|\((?i:at)\)| (?i:at) "
_TRIGGER = rf"[0-9]|{_AT}"
_ANY, _AT_ANY = re.compile(_TRIGGER), re.compile(_AT)
_AT_WORD = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}} ?(?:{_AT}) ?[A-Za-z0-9-]{{1,63}}(?: ?(?:\.|\[(?i:dot)\]|\((?i:dot)\)| (?i:dot) ) ?[A-Za-z0-9-]{{2,24}}){{1,4}}")
_RUN = re.compile(r"[+(]{0,2}[0-9][0-9().\x20-]*[0-9]")
_GROUP = re.compile(r"\+?\(?[0-9]+\)?")
_HINT = re.compile(r"(?i)\b(?:tel|phone|call|fax|mobile|card|visa|iban|ip|host|server|mail|contact)\b\W*$")


def luhn(digits: str) -> bool:
    """The check sum of card numbers."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text.split("."))


def _is_card(text: str) -> bool:
    return 14 <= len(d := _digits(text)) <= 19 and luhn(d)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, end, kind number)`` of the four rules, ordered by start, then kind."""
    found = []
    if "@" in text:
        found += [(m.start(), m.end(), 0) for m in _EMAIL.finditer(text) if m[1]]
    found += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if _is_ip(m[0])]
    found += [(m.start(), m.end(), 2) for m in _CARD.finditer(text) if _is_card(m[0])]
    if "+" in text:
        found += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], s[2]))


def proposals(text: str) -> list[tuple[int, int, int]]:
    """Overlapping spans that may be personal data: far more than are."""
    found = [(m.start(), m.end(), 0) for m in _AT_WORD.finditer(text)] if _AT_ANY.search(text) else []
    for run in _RUN.finditer(text):
        if run.end() - run.start() < 7:
            continue
        groups = [(run.start() + g.start(), run.start() + g.end()) for g in _GROUP.finditer(run[0])]
        sizes = [len(_digits(text[a:b])) for a, b in groups]
        for i in range(len(groups)):
            count = 0
            for j in range(i, len(groups)):
                count += sizes[j]
                if count > 19:
                    break
                if count >= 7:
                    start, end = groups[i][0], groups[j][1]
                    found.append((start, end, 3))
                    if count >= 13 and "(" not in text[start:end] and "+" not in text[start:end]:
                        found.append((start, end, 2))
                if j - i == 3 and count >= 4:
                    found.append((groups[i][0], groups[j][1], 1))
    return found


def features(text: str, span: tuple[int, int, int]) -> list[float]:
    """Format and context of a span."""
    start, end, kind = span
    piece, digits = text[start:end], _digits(text[start:end])
    before, after = text[max(0, start - 24) : start], text[end : end + 2]
    sizes = [len(g) for g in re.findall("[0-9]+", piece)] or [0]
    gaps = re.findall("[^0-9]+", piece.strip("+()"))
    return [
        *(float(kind == k) for k in range(4)),
        len(piece),
        len(digits),
        len(sizes),
        max(sizes),
        min(sizes),
        sizes[0],
        sizes[-1],
        len(set(gaps)),
        piece.count(" "),
        piece.count("-"),
        piece.count("."),
        piece.count("("),
        float(piece.startswith("+")),
        piece.count("@"),
        float(piece.count("(") == piece.count(")")),
        float(bool(digits) and luhn(digits)),
        float(all(int(x[:6]) <= 255 for x in re.findall("[0-9]+", piece)) and len(sizes) == 4),
        float(len(set(sizes[:-1])) <= 1),
        float(before[-1:].isalnum() or before[-1:] in "+@_"),
        float(before[-1:].isspace() or not before),
        float(after[:1].isalnum() or after[:1] in "@_"),
        float(bool(re.match(r"[.,-]?[0-9]", after))),
        float(bool(re.search(r"[0-9][ .)-]?$", before))),
        float(bool(_HINT.search(before))),
        float(len(digits) > 1 and len(set(digits)) <= 2),
    ]


WIDTH = len(features("0", (0, 1, 0)))


# training --------------------------------------------------------------------------------
def _rewritten(rng: random.Random, piece: str, kind: int) -> tuple[str, int]:
    """A form of a span, and 1 if it is still personal data."""
    digits = _digits(piece)
    if kind == 0:
        user, _, domain = piece.partition("@")
        at, dot = rng.choice([(" at ", " dot "), ("[at]", "[dot]"), (" (at) ", "."), ("@", ".")])
        return (user + at + domain.replace(".", dot), 1) if rng.random() < 0.7 else (f"{user} at {domain.split('.')[0]}", 0)
    if kind == 1:
        parts = piece.split(".")
        return (piece, 1) if rng.random() < 0.5 else (".".join([str(int(parts[0] or 0) + 256), *parts[1:]]), 0)
    if kind == 2:
        if rng.random() < 0.4:
            at = rng.randrange(len(digits))
            digits = digits[:at] + str((int(digits[at]) + rng.randrange(1, 10)) % 10) + digits[at + 1 :]
            return digits, 0
        gap = rng.choice(["", " ", "-"])
        return gap.join(digits[i : i + 4] for i in range(0, len(digits), 4)), 1
    if rng.random() < 0.3:
        return "".join(rng.choice("0123456789") for _ in range(rng.randrange(7, 16))), 0
    area, rest = digits[-10:-7], digits[-7:]
    forms = [f"+{digits[:-10] or '1'} {area} {rest[:3]} {rest[3:]}", f"+{digits[:-10] or '1'} ({area}) {rest[:3]}-{rest[3:]}", f"({area}) {rest[:3]}-{rest[3:]}"]
    return rng.choice(forms), 1


def _examples(text: str, seed: int) -> Iterator[tuple[list[float], int]]:
    """Labelled proposals of one document, as it is and with its spans rewritten side by side."""
    rng = random.Random(seed)
    base = base_spans(text)
    right = set(base)
    doubtful = [(m.start(), m.end()) for rule in (_CARD, _PHONE) for m in rule.finditer(text) if len(_digits(m[0])) > 15]
    for span in proposals(text):
        if span in right:
            yield features(text, span), 1
        elif not any(a <= span[0] and span[1] <= b for a, b in doubtful):
            yield features(text, span), 0
    for start, end, kind in base:
        around = text[max(0, start - 30) : start], text[end : end + 30]
        piece, good = _rewritten(rng, text[start:end], kind)
        other = rng.choice(base)
        tail = text[other[0] : other[1]] if rng.random() < 0.5 else ""
        made = around[0] + piece + (" " + tail if tail else "") + around[1]
        wanted = {(len(around[0]), len(around[0]) + len(piece), kind)} if good else set()
        if tail:
            at = len(around[0]) + len(piece) + 1
            wanted.add((at, at + len(tail), other[2]))
        edges = (len(around[0]), len(made) - len(around[1]))
        for span in proposals(made):
            if edges[0] <= span[0] and span[1] <= edges[1]:
                yield features(made, span), int(span in wanted)


@dataclass
class SpanModel:
    """Trees and, per kind, the calibrated threshold from which a proposal is taken."""

    trees: Trees
    thresholds: tuple[float, float, float, float]


def fit(texts: DataFrame) -> SpanModel | None:
    """Train on a bounded sample of ``doc_id, text`` rows that a generator can find something in.

    None if the sample has no examples of both classes; then base spans are all there is.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(x, y) for doc_id, text in zip(frame["doc_id"], frame["text"]) for x, y in _examples(text, int(doc_id or 0))]
            yield pd.DataFrame(rows, columns=["x", "y"])

    chosen = sampled(texts.where(F.col("text").rlike(_TRIGGER)), SAMPLE_DOCUMENTS)
    rows = chosen.mapInPandas(run, "x array<double>, y int").limit(SAMPLE_SPANS).toPandas()
    if rows["y"].nunique() < 2:
        return None
    x, y = np.stack(rows["x"].to_list()), rows["y"].to_numpy()
    # a fixed order that does not depend on how tasks delivered the rows
    order = np.lexsort((y, *x.T))
    order = order[np.random.default_rng(7).permutation(len(order))]
    x, y = x[order], y[order]
    part = np.arange(len(x)) % 4  # two parts fit the trees, one calibrates them, one sets the thresholds
    trees = train(x[part < 2], y[part < 2])
    calibrate(trees, x[part == 2], y[part == 2])
    held, target = x[part == 3], y[part == 3]
    mine = [held[:, k] == 1 for k in range(4)]
    return SpanModel(trees, tuple(threshold(trees, held[m], target[m], PRECISION) if m.sum() > LEAST_HELD else NEVER for m in mine))


# scoring ---------------------------------------------------------------------------------
def find(text: str, model: SpanModel | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and all spans: base ones and the proposals that the model adds."""
    if _ANY.search(text) is None:
        return [], []
    base = base_spans(text)
    if model is None:
        return base, base
    taken = sorted((a, b) for a, b, _ in base)
    open_spans = [s for s in proposals(text) if not any(a < s[1] and s[0] < b for a, b in taken)] if len(taken) < 64 else _outside(proposals(text), taken)
    if not open_spans:
        return base, base
    p = model.trees.probability(np.array([features(text, s) for s in open_spans]))
    added: list[tuple[int, int, int]] = []  # disjoint and sorted, so only neighbours can overlap
    good = [(float(q), s) for q, s in zip(p, open_spans) if q >= model.thresholds[s[2]]]
    for _, span in sorted(good, key=lambda g: (-g[0], -(g[1][1] - g[1][0]), g[1])):
        at = bisect.bisect_left(added, span)
        if (at == 0 or added[at - 1][1] <= span[0]) and (at == len(added) or span[1] <= added[at][0]):
            added.insert(at, span)
    return base, sorted(base + added, key=lambda s: (s[0], s[2]))


def _outside(spans: list[tuple[int, int, int]], taken: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Spans that overlap none of many sorted ones."""
    starts = np.array([a for a, _ in taken])
    furthest = np.maximum.accumulate(np.array([b for _, b in taken]))
    at = np.searchsorted(starts, [s[1] for s in spans], side="left") - 1
    return [s for s, i in zip(spans, at) if i < 0 or furthest[i] <= s[0]]


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, or union of overlapping spans, replaced by its kind."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def personal_data(
    docs: DataFrame, model: SpanModel | None, id_column: str = "doc_id", text_column: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """``doc_id, base, spans, text`` and the ``carry`` columns for every row of ``docs``.

    ``base`` and ``spans`` are ``kind:start:end`` in code points, end exclusive, comma-joined by
    start, then kind; ``text`` has all spans replaced by ``[KIND]``. Null and empty texts have no
    spans and an empty text. Rows with a null or repeated id are scored like any other. An empty
    table gives no rows. Columns that are not named are not read.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [find(text or "", model) for text in frame["text"]]
            frame["base"] = [joined(b) for b, _ in found]
            frame["spans"] = [joined(s) for _, s in found]
            frame["text"] = [redact(text or "", s) for text, (_, s) in zip(frame["text"], found)]
            yield frame

    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"), *carry)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema)
    return chosen.mapInPandas(run, f"{fields}, base string, spans string")
