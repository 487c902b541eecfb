"""Token ids of whole texts with a bounded memory of words.

Words repeat, so Arrow splits a group of texts into distinct words and those into distinct
pre-tokens, a worker remembers the ids of the pre-tokens it has met, and NumPy joins them again.
That is exact: the tokenizer drops white space, and neither its pre-tokens nor its merges reach
across them. A group holds a bounded number of characters, and long texts are taken in slices that
end at white space, so the words of a batch are never held together.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The pre-token classes of the tokenizer within Latin-1, where lower-casing is one to one and
# normalization changes nothing: letters, single numbers, runs of anything else.
_LETTERS = "A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff"
_NUMBERS = "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe"
_PLAIN = "^[\\x21-\\x7e\\xa1-\\xff]*$"
_PIECES = f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]|[^\\s{_LETTERS}{_NUMBERS}]+"
_SPECIAL = "<|"
_SUFFIX = "</w>"  # of the last token of a pre-token, and of no other
_BLANK = re.compile("[\\t\\n\\r ]")
SLICE = 1 << 18  # code points of texts that are split into words at a time
MEMORY = 32 << 20  # bytes of the words a worker remembers; one slice's words may come on top
CALL = 1024  # fresh words the tokenizer gets at a time
COST = 160  # about what Python needs for a word and its ids in a dictionary, besides their bytes


def _slices(text: str) -> Iterator[str]:
    """``text`` in slices of about :data:`SLICE`, cut in front of white space only."""
    low = 0
    while len(text) - low > SLICE:
        found = _BLANK.search(text, low + SLICE)
        if found is None:
            break
        yield text[low : found.start()]
        low = found.start()
    yield text[low:] if low else text


def _groups(texts: Iterable[str]) -> Iterator[list[str]]:
    """``texts`` in groups of at most :data:`SLICE` code points, or of one text."""
    group, held = [], 0
    for text in texts:
        if group and held + len(text) > SLICE:
            yield group
            group, held = [], 0
        group.append(text)
        held += len(text)
    if group:
        yield group


def _distinct(lists: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of lists, the place of every word among them, and where the lists begin."""
    coded = lists.values.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), lists.offsets.to_numpy()


def _runs(values: np.ndarray, starts: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs ``index`` of ``values`` in a row, and where each begins; run ``i`` began at ``starts[i]``."""
    lengths = np.diff(starts)[index]
    own = np.concatenate([[0], np.cumsum(lengths)])
    return values[np.repeat(starts[index] - own[:-1], lengths) + np.arange(own[-1])], own


class WordTokens:
    """Ids as little-endian unsigned 32-bit bytes.

    Words are remembered in two generations of half the memory each: when the younger is full it
    becomes the older one, whose words move back as they are met. Frequent words stay that way.
    """

    _loaded: dict[str, WordTokens] = {}

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self._tokenizer = Tokenizer.from_file(path)
        # The same model for pre-tokens that are found already, many in one call.
        self._model = Tokenizer(self._tokenizer.model)
        self._model.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self._tokenizer.get_vocab()
        self._last = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self._last[[i for token, i in vocabulary.items() if token.endswith(_SUFFIX)]] = True
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._held = 0

    @classmethod
    def of(cls, path: str) -> WordTokens:
        """The worker's instance for a tokenizer file."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _ids(self, texts: list[str]) -> list[bytes]:
        done = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in done]

    def _of_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of plain pre-tokens from one call of the model; one ends where a last token is. An empty one has none."""
        ids = np.array(self._model.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(self._last[ids]) + 1
        after = np.cumsum([piece != "" for piece in pieces], dtype=np.int64)
        starts = np.concatenate([[0], ends])
        if len(ends) != after[-1] or starts[-1] != len(ids):
            return self._ids(pieces)
        cuts, data = (4 * starts[after]).tolist(), ids.tobytes()
        return [data[low:high] for low, high in zip([0, *cuts], cuts)]

    def _remembered(self, words: pa.Array) -> list[bytes]:
        """Ids of distinct words; the fresh ones are remembered."""
        listed = words.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self._known.get, listed))
        lost = [at for at, ids in enumerate(found) if ids is None]
        if not lost:
            return found
        new = [listed[at] for at in lost]
        ids = list(map(self._older.get, new))
        fresh = [at for at, given in enumerate(ids) if given is None]
        plain = _plain(words.take(pa.array(lost, pa.int64()).take(pa.array(fresh, pa.int64())))).to_numpy(zero_copy_only=False)
        for read, wanted in ((self._of_pieces, plain), (self._ids, ~plain)):
            places = np.array(fresh, dtype=np.int64)[wanted].tolist()
            for low in range(0, len(places), CALL):
                part = places[low : low + CALL]
                for at, given in zip(part, read([new[at] for at in part])):
                    ids[at] = given
        for at, given in zip(lost, ids):
            found[at] = given
        self._known.update(zip(new, ids))
        self._held += COST * len(new) + sum(map(len, new)) + sum(map(len, ids))
        if self._held > MEMORY // 2:
            self._older, self._known, self._held = self._known, {}, 0
        return found

    def _of_group(self, texts: list[str]) -> Iterator[bytes]:
        words, word_at, text_starts = _distinct(pc.ascii_split_whitespace(pa.array(texts, pa.large_string())))
        cut = pc.replace_substring_regex(pc.utf8_lower(words), _PIECES, "\\0 ")
        cut = pc.utf8_rtrim(pc.if_else(_plain(words), cut, words), " ")
        pieces, piece_at, word_starts = _distinct(pc.ascii_split_whitespace(cut))
        ids = self._remembered(pieces)
        starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)) // 4)])
        of_words, at = _runs(np.frombuffer(b"".join(ids), dtype="<u4"), starts, piece_at)
        of_texts, at = _runs(of_words, at[word_starts], word_at)
        cuts, data = (4 * at[text_starts]).tolist(), of_texts.tobytes()
        for low, high in zip(cuts, cuts[1:]):
            yield data[low:high]

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Ids of whole texts, one after the other; null is empty."""
        for group in _groups(text or "" for text in texts):
            if len(group) == 1:
                yield b"".join([ids for part in _slices(group[0]) for ids in self._of_group([part])])
            else:
                yield from self._of_group(group)


def _plain(words: pa.Array) -> pa.Array:
    return pc.and_not(pc.match_substring_regex(words, _PLAIN), pc.match_substring(words, _SPECIAL))
