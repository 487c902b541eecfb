"""HTML helper of the extraction UDFs (private).

A page is kept as one flat token list in document order. An element knows the slice of tokens
it spans, so its text and its HTML are loops over that slice, and all of its descendants form
one contiguous range of element numbers. A selector is matched once per page in a single pass;
matches inside an element are then found by binary search.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from functools import lru_cache
from html import escape
from html.parser import HTMLParser

# Fixed values from the HTML standard: elements without content, and elements whose text is raw.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW_TEXT_TAGS = frozenset(("script", "style"))
# What sanitizing keeps unless told otherwise.
DEFAULT_ALLOWED_TAGS = ("p", "br", "strong", "em", "ul", "ol", "li", "a", "blockquote")
KEPT_ATTRIBUTES = ("href", "title")

OPEN, TEXT, CLOSE = 0, 1, 2


Attributes = dict[str, str | None]


class Element:
    __slots__ = ("_marks", "attrs", "end", "last", "number", "parent", "start", "tag")

    def __init__(self, tag: str, attrs: Attributes, number: int, parent: int, start: int) -> None:
        self.tag = tag
        self.attrs = attrs  # as read: null stands for an attribute without a value
        self._marks: frozenset[str] | None = None
        self.number = number
        self.parent = parent
        self.start = start  # token range
        self.end = start + 1
        self.last = number  # number of the last descendant

    def value(self, name: str) -> str | None:
        """An attribute's text, empty if it has no value; null if the element lacks it."""
        return (self.attrs[name] or "") if name in self.attrs else None

    @property
    def marks(self) -> frozenset[str]:
        """What plain selectors ask for: ``tag``, ``#id`` and every ``.class``."""
        if self._marks is None:
            classes = (self.value("class") or "").split()
            self._marks = frozenset([self.tag, "#" + (self.value("id") or ""), *("." + c for c in classes)])
        return self._marks


class Page(HTMLParser):
    """Token and element lists of one HTML text."""

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.kinds = bytearray()
        self.tokens: list = []
        self.elements: list[Element] = []
        self._open: list[Element] = []
        self._depths: dict[str, list[int]] = {}  # where each tag stands in `_open`
        self._found: dict[tuple[str, bool], list[int]] = {}
        self.feed(html)
        self.close()
        self._close_down_to(0)

    # events -----------------------------------------------------------------
    def updatepos(self, i: int, j: int) -> int:
        """Line numbers are never asked for, so they are not tracked."""
        return j

    def _emit(self, kind: int, token: object) -> None:
        self.kinds.append(kind)
        self.tokens.append(token)

    def _close_down_to(self, depth: int) -> None:
        while len(self._open) > depth:
            element = self._open.pop()
            self._depths[element.tag].pop()
            element.last = len(self.elements) - 1
            self._emit(CLOSE, element)
            element.end = len(self.tokens)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        above = self._open[-1].number if self._open else -1
        element = Element(tag, dict(attrs), len(self.elements), above, len(self.tokens))
        self.elements.append(element)
        self._emit(OPEN, element)
        if tag not in VOID_TAGS:
            self._depths.setdefault(tag, []).append(len(self._open))
            self._open.append(element)

    def handle_endtag(self, tag: str) -> None:
        if depths := self._depths.get(tag):
            self._close_down_to(depths[-1])

    def handle_data(self, data: str) -> None:
        if data:
            self._emit(TEXT, data)

    # queries ----------------------------------------------------------------
    def select(self, selector: str, inside: Element | None = None, css: bool = False) -> list[Element]:
        """Elements that match, in document order, below ``inside`` or anywhere."""
        key = (selector, css)
        found = self._found.get(key)
        if found is None:
            found = self._found[key] = self._match(compile_selector(selector, css))
        if inside is not None:
            found = found[bisect_right(found, inside.number) : bisect_right(found, inside.last)]
        return [self.elements[n] for n in found]

    def first(self, selector: str, inside: Element | None = None, css: bool = False) -> Element | None:
        matches = self.select(selector, inside, css)
        return matches[0] if matches else None

    def _match(self, chains: tuple[tuple[Step, ...], ...]) -> list[int]:
        hits: set[int] = set()
        for chain in chains:
            # bit k of `at`: the first k steps can end exactly on this element;
            # bit k of `below`: they can end on it or on one of its ancestors
            at, below = [], []
            for element in self.elements:
                up_at = at[element.parent] if element.parent >= 0 else 0
                up_below = below[element.parent] if element.parent >= 0 else 0
                mask = 0
                for k, step in enumerate(chain):
                    reached = k == 0 or (up_at if step.child else up_below) >> k & 1
                    if reached and step.fits(element):
                        mask |= 2 << k
                at.append(mask)
                below.append(mask | up_below)
                if mask >> len(chain) & 1:
                    hits.add(element.number)
        return sorted(hits)

    def text(self, element: Element | None = None, skip: frozenset[str] = frozenset()) -> str:
        """Text parts joined by a blank and trimmed at the ends; `skip` drops whole elements."""
        start, end = (element.start, element.end) if element else (0, len(self.tokens))
        parts = []
        i = start
        while i < end:
            kind, token = self.kinds[i], self.tokens[i]
            if kind == TEXT:
                parts.append(token)
            elif kind == OPEN and token.tag in skip:
                i = token.end
                continue
            i += 1
        return " ".join(parts).strip()

    def html(self, element: Element | None = None) -> str:
        start, end = (element.start, element.end) if element else (0, len(self.tokens))
        out = []
        raw = 0
        for kind, token in zip(self.kinds[start:end], self.tokens[start:end], strict=True):
            if kind == TEXT:
                out.append(token if raw else escape(token, quote=False))
            elif kind == OPEN:
                out.append(_opening(token.tag, token.attrs))
                raw += token.tag in RAW_TEXT_TAGS
            else:
                out.append(f"</{token.tag}>")
                raw -= token.tag in RAW_TEXT_TAGS
        return "".join(out)

    def sanitized(self, allowed: frozenset[str], element: Element | None = None) -> str:
        """HTML with scripts and styles removed, other tags unwrapped, attributes reduced."""
        start, end = (element.start, element.end) if element else (0, len(self.tokens))
        out = []
        i = start
        while i < end:
            kind, token = self.kinds[i], self.tokens[i]
            i += 1
            if kind == TEXT:
                out.append(escape(token, quote=False))
            elif kind == OPEN and token.tag in RAW_TEXT_TAGS:
                i = token.end
            elif token.tag in allowed:
                out.append(_opening(token.tag, _safe(token.attrs)) if kind == OPEN else f"</{token.tag}>")
        return "".join(out).strip()


def collapsed(text: str) -> str:
    """One blank between words, none at the ends and none before ``!?.,;:``."""
    text = " ".join(text.split())
    for mark in "!?.,;:":
        text = text.replace(" " + mark, mark)
    return text


# Browsers ignore these characters in front of and inside a URL scheme.
_IGNORED_IN_SCHEME = re.compile(r"[\x00-\x20]+")


def _opening(tag: str, attrs: Attributes) -> str:
    quoted = (f'{name}="{escape(text or "")}"' for name, text in attrs.items())
    return "<" + " ".join((tag, *quoted)) + ">"


def _runs_script(link: str | None) -> bool:
    return _IGNORED_IN_SCHEME.sub("", link or "").lower().startswith("javascript:")


def _safe(attrs: Attributes) -> Attributes:
    return {k: v for k, v in attrs.items() if k in KEPT_ATTRIBUTES and not (k == "href" and _runs_script(v))}


class Step:
    """One compound of a selector: the marks an element needs and (CSS mode) attribute tests."""

    __slots__ = ("attrs", "child", "marks")

    def __init__(self) -> None:
        self.marks: frozenset[str] = frozenset()
        self.attrs: list[tuple[str, str | None]] = []
        self.child = False

    def fits(self, element: Element) -> bool:
        return self.marks <= element.marks and all(
            (own := element.value(name)) is not None and wanted in (None, own) for name, wanted in self.attrs
        )


_PIECE = re.compile(r"([.#]?)([^.#]+)")
_CSS_PIECE = re.compile(r"\[\s*([\w:-]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\]\s]*)\s*)?\]|([.#]?)([\w*:-]+)")
_CSS_WORD = re.compile(r">|(?:\[[^\]]*\]|[^\s>\[])+")


@lru_cache(maxsize=4096)
def compile_selector(selector: str, css: bool = False) -> tuple[tuple[Step, ...], ...]:
    """Alternatives of a selector, each a chain of steps.

    The plain language knows descendant chains of ``tag``, ``.class`` and ``#id``; CSS mode adds
    ``,``, ``>``, ``*`` and ``[attr]`` / ``[attr=value]``.
    """
    chains = []
    for alternative in selector.split(",") if css else [selector]:
        chain: list[Step] = []
        child = False
        for word in _CSS_WORD.findall(alternative) if css else alternative.split():
            if css and word == ">":
                child = True
                continue
            step = Step()
            step.child, child = child, False
            if css:
                for attr, value, mark, name in _CSS_PIECE.findall(word):
                    if attr:
                        quoted = value[:1] in ("'", '"')
                        step.attrs.append((attr.lower(), (value[1:-1] if quoted else value) or None))
                    else:
                        _add(step, mark, "" if name == "*" else name)
            else:
                for mark, name in _PIECE.findall(word):
                    _add(step, mark, name)
            chain.append(step)
        if chain:
            chains.append(tuple(chain))
    return tuple(chains)


def _add(step: Step, mark: str, name: str) -> None:
    """Classes add up; of several tags or ids in one compound the last one counts."""
    if not name:
        return
    new = mark + (name if mark else name.lower())
    old = step.marks if mark == "." else (m for m in step.marks if m[0] == "." or m.startswith("#") != (mark == "#"))
    step.marks = frozenset([*old, new])


__all__ = ["DEFAULT_ALLOWED_TAGS", "RAW_TEXT_TAGS", "Element", "Page", "collapsed", "compile_selector"]
