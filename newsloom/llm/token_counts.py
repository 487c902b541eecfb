"""Token counts that follow edits.

A document keeps a segment tree. Its leaves are runs of whole pre-tokens, about :data:`LEAF`
code points long; every node holds the code points and tokens below it. Leaves end where a space
or line feed follows something else: no pre-token or merge crosses such a place, and what
stands on one side never changes how the other side is split. So counts of leaves add up, and
after an edit only the leaves that touch it, with their boundary characters, are encoded anew;
then the sums above them are updated.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAF = 256
_CUT = re.compile(r"(?<=\S)[ \n]")


@dataclass(frozen=True)
class CountOptions:
    """``ranks``: path of a tiktoken vocabulary; ``pattern``: its pre-token pattern."""

    ranks: str
    pattern: str


_LOADED: dict[CountOptions, tiktoken.Encoding] = {}


def encoding(options: CountOptions) -> tiktoken.Encoding:
    """The worker's encoder."""
    if options not in _LOADED:
        with open(options.ranks, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _LOADED[options] = tiktoken.Encoding("counts", pat_str=options.pattern, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[options]


def leaves(text: str) -> list[str]:
    """The text in runs of whole pre-tokens."""
    out, at = [], 0
    while len(text) - at > LEAF and (cut := _CUT.search(text, at + LEAF)):
        out.append(text[at : cut.start()])
        at = cut.start()
    return [*out, text[at:]]


class TokenTree:
    """Sums of code points and tokens; node ``i`` has the children ``2 i`` and ``2 i + 1``."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.chars, self.tokens = chars, tokens

    @classmethod
    def of_leaves(cls, chars: list[int], tokens: list[int]) -> TokenTree:
        room = 1
        while room < len(chars):
            room *= 2
        tree = cls(np.zeros(2 * room, dtype=np.int32), np.zeros(2 * room, dtype=np.int32))
        tree.chars[room : room + len(chars)] = chars
        tree.tokens[room : room + len(tokens)] = tokens
        tree._update(0, room - 1)
        return tree

    @classmethod
    def build(cls, text: str, encoder: tiktoken.Encoding) -> TokenTree:
        parts = leaves(text)
        return cls.of_leaves([len(p) for p in parts], [len(encoder.encode_ordinary(p)) for p in parts])

    @property
    def room(self) -> int:
        return len(self.chars) // 2

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def _update(self, first: int, last: int) -> None:
        """Recompute the sums above the leaves ``first`` to ``last``."""
        low, high = (self.room + first) // 2, (self.room + last) // 2
        while low >= 1:
            for sums in (self.chars, self.tokens):
                sums[low : high + 1] = sums[2 * low : 2 * high + 2 : 2] + sums[2 * low + 1 : 2 * high + 2 : 2]
            low, high = low // 2, high // 2

    def locate(self, place: int) -> tuple[int, int]:
        """The leaf that holds a code point (the last filled one at the end) and where it begins."""
        place = max(0, min(place, int(self.chars[1]) - 1))
        node, before = 1, 0
        while node < self.room:
            node *= 2
            if place - before >= self.chars[node]:
                before += int(self.chars[node])
                node += 1
        return node - self.room, before

    def edit(self, text: str, place: int, removed: int, added: str, encoder: tiktoken.Encoding) -> tuple[str, TokenTree, int]:
        """Replace ``removed`` code points at ``place``: the new text, its tree, code points encoded."""
        place = max(0, min(place, len(text)))
        removed = max(0, min(removed, len(text) - place))
        first, begin = self.locate(place - 1)
        last, end = self.locate(place + removed)
        end += int(self.chars[self.room + last])
        changed = text[:place] + added + text[place + removed :]
        parts = leaves(changed[begin : end + len(added) - removed])
        counts = [len(encoder.encode_ordinary(p)) for p in parts]
        sizes, slots = [len(p) for p in parts], last - first + 1
        if len(parts) <= slots:
            low, high = self.room + first, self.room + last + 1
            chars, tokens = self.chars.copy(), self.tokens.copy()
            chars[low:high] = sizes + [0] * (slots - len(parts))
            tokens[low:high] = counts + [0] * (slots - len(parts))
            tree = TokenTree(chars, tokens)
            tree._update(first, last)
        else:  # more leaves than before: known counts move to a tree with room for them
            chars, tokens = self.chars[self.room :].tolist(), self.tokens[self.room :].tolist()
            chars[first : last + 1], tokens[first : last + 1] = sizes, counts
            filled = [i for i, c in enumerate(chars) if c] or [0]
            tree = TokenTree.of_leaves([chars[i] for i in filled], [tokens[i] for i in filled])
        return changed, tree, sum(sizes)


def _frames(run, fields: str, df: DataFrame) -> DataFrame:
    return df.mapInPandas(run, fields)


def indexed(docs: DataFrame, options: CountOptions, carry: tuple[str, ...] = (), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, text, chars, tokens`` and the ``carry`` columns: every document with its tree.

    ``tokens[1]`` is the document's count. Null texts are empty, with a count of 0.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoding(options)
        for frame in frames:
            frame["text"] = [t or "" for t in frame["text"]]
            trees = [TokenTree.build(t, encoder) for t in frame["text"]]
            frame["chars"], frame["tokens"] = [t.chars for t in trees], [t.tokens for t in trees]
            yield frame

    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"), *carry)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema)
    return _frames(run, f"{fields}, chars array<int>, tokens array<int>", chosen)


EDITS = "array<struct<place: int, removed: int, added: string>>"


def recounted(index: DataFrame, edits: Column, options: CountOptions) -> DataFrame:
    """Apply every row's ``edits``, in order, to an index of :func:`indexed`.

    Gives ``doc_id, text, chars, tokens`` after the edits and ``n_before``, ``n_encoded`` (code
    points encoded anew). Places refer to the text as the edits before left it and are clamped
    to it; null edits, or a null list of them, change nothing. Rows with a null or repeated id
    are edited like any other; an empty table gives no rows; other columns are not read.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoding(options)
        for frame in frames:
            rows = []
            for doc_id, text, chars, tokens, changes in frame.itertuples(index=False):
                tree, encoded = TokenTree(np.array(chars, dtype=np.int32), np.array(tokens, dtype=np.int32)), 0
                before = tree.total
                for change in changes if changes is not None else ():
                    if change is None or pd.isna(change["place"]):
                        continue
                    removed = 0 if pd.isna(change["removed"]) else int(change["removed"])
                    text, tree, more = tree.edit(text, int(change["place"]), removed, change["added"] or "", encoder)
                    encoded += more
                rows.append((doc_id, text, tree.chars, tree.tokens, before, encoded))
            out = pd.DataFrame(rows, columns=["doc_id", "text", "chars", "tokens", "n_before", "n_encoded"])
            out["doc_id"] = frame["doc_id"].astype("Int64").to_numpy() if len(frame) else out["doc_id"]
            yield out

    chosen = index.select("doc_id", "text", "chars", "tokens", edits.cast(EDITS).alias("edits"))
    return _frames(run, "doc_id long, text string, chars array<int>, tokens array<int>, n_before long, n_encoded long", chosen)
