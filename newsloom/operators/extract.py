"""Extraction of listing items, articles and fields from HTML, one parse per page.

Each page kind has one Arrow UDF that returns a struct. Selectors arrive as a JSON text column,
so portals with different options share one job; a worker turns each into :class:`Rules` once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from newsloom import schemas as S
from newsloom.functions.text import collapse_text
from newsloom.operators.html import DEFAULT_ALLOWED_TAGS, RAW_TEXT_TAGS, Element, Page, collapsed

LISTING_RESULT = T.ArrayType(S.LISTING_ITEM)
FIELD_MAP = T.MapType(T.StringType(), T.StringType())
_LISTING_ARROW = to_arrow_type(LISTING_RESULT)
_ARTICLE_ARROW = to_arrow_type(S.ARTICLE_PARTS)
_CLEANED_ARROW = to_arrow_type(S.CLEANED)
_FIELDS_ARROW = to_arrow_type(FIELD_MAP)


# Bytes of HTML whose rows are Python objects at one time, so a worker's memory does not follow the batch.
SLICE_BYTES = 1 << 20

Reader = Callable[[Page, Element], str | None]


def _reader(attribute: str | None) -> Reader:
    """What a field takes from its element: the text, the element's own HTML, or an attribute."""
    if not attribute:
        return Page.text
    if attribute == "html":
        return Page.html
    return lambda _, node: node.value(attribute)


@dataclass(frozen=True)
class Field:
    """A metadata field: its place, what is read there, and whether every match counts."""

    name: str
    selector: str
    read: Reader
    every: bool

    @classmethod
    def of(cls, name: str, given: object) -> Field:
        wanted = given if isinstance(given, dict) else {"selector": given}
        place = str(wanted.get("selector") or "").strip()
        return cls(name, place, _reader(wanted.get("attr")), bool(wanted.get("all")))


@dataclass(frozen=True)
class Rules:
    """Options of a portal for one page kind; an empty selector means the part is not wanted."""

    item: str
    link: str
    target: str
    title: str
    summary: str
    body: str
    content: bool
    allowed: frozenset[str]
    fields: tuple[Field, ...]

    def metadata(self, page: Page, inside: Element | None = None) -> tuple[dict[str, str], dict[str, list[str]]]:
        """``(texts, lists)``: a field of every match is a list and its JSON text."""
        texts, lists = {}, {}
        for field in self.fields:
            if matches := page.select(field.selector, inside):
                read = [field.read(page, node) for node in (matches if field.every else matches[:1])]
                present = [value for value in read if value is not None]
                if field.every:
                    lists[field.name], texts[field.name] = present, json.dumps(present, ensure_ascii=False)
                elif present:
                    texts[field.name] = present[0]
        return texts, lists


@lru_cache(maxsize=4096)
def _rules(text: str | None) -> Rules:
    given = json.loads(text) if text else {}
    fields = [Field.of(name, value) for name, value in (given.get("metadata_selectors") or {}).items()]
    return Rules(
        item=given.get("item_selector") or "",
        link=given.get("link_selector", "a") or "",
        target=given.get("url_attribute") or "href",
        title=given.get("title_selector") or "",
        summary=given.get("summary_selector") or "",
        body=given.get("body_selector") or "",
        content=bool(given.get("keep_content")),
        allowed=frozenset(given.get("allowed_tags") or DEFAULT_ALLOWED_TAGS),
        fields=tuple(field for field in fields if field.selector),
    )


@lru_cache(maxsize=4096)
def _link_rules(text: str | None) -> Rules:
    return replace(_rules(text), title="", summary="", content=False, fields=())


def _parsed(html: str | None) -> Page | None:
    try:
        return Page(html or "")
    except (AssertionError, ValueError, IndexError):  # malformed declarations
        return None


def _text_at(page: Page, selector: str, inside: Element | None = None) -> str | None:
    """Text of the first match; null without a selector, a match or any text."""
    node = page.first(selector, inside) if selector else None
    return (page.text(node) or None) if node else None


def _listing_item(page: Page, item: Element, rules: Rules) -> dict:
    link = page.first(rules.link, item) if rules.link else item
    href = (link.value(rules.target) or "").strip() if link else ""
    if not href:
        return {"href": ""}
    texts, lists = rules.metadata(page, item)
    summary = page.first(rules.summary, item) if rules.summary else None
    return {
        "href": href,
        "content": page.html(item) if rules.content else None,
        "link_text": page.text(link) or None,
        "title_text": _text_at(page, rules.title, item),
        "summary_html": page.html(summary) if summary else None,
        "summary_text": page.text(summary) if summary else None,
        "meta": texts,
        "lists": lists,
    }


def _listing_items(html: str | None, options_text: str | None, links_only: bool = False) -> list[dict] | None:
    rules, page = (_link_rules if links_only else _rules)(options_text), _parsed(html)
    return page and [_listing_item(page, item, rules) for item in page.select(rules.item)]


def _article_parts(
    html: str | None, options_text: str | None, keep_body: bool = True, summary_html: str | None = None
) -> dict | None:
    rules, page = _rules(options_text), _parsed(html)
    body = page.first(rules.body) if page else None
    if body is None:
        return None
    texts, lists = rules.metadata(page)
    return {
        "found": True,
        "body_html": page.html(body) if keep_body else None,
        "title_text": _text_at(page, rules.title),
        "meta": texts,
        "lists": lists,
        "safe_html": page.sanitized(rules.allowed, body),
        "text": collapsed(page.text(body, RAW_TEXT_TAGS)),
        "summary": _clean_text(texts.get("summary_html", summary_html)),
    }


def _clean_text(html: str | None) -> str | None:
    page = _parsed(html) if html is not None else None
    return collapsed(page.text(None, RAW_TEXT_TAGS)) if page else None


def _cleaned(html: str | None, options_text: str | None) -> dict | None:
    if html is None:
        return None
    page = _parsed(html)
    if page is None:
        return None
    return {
        "safe_html": page.sanitized(_rules(options_text).allowed),
        "text": collapsed(page.text(None, RAW_TEXT_TAGS)),
    }


def _fields(html: str | None, options_text: str | None) -> list[tuple[str, str | None]] | None:
    page = _parsed(html)
    if page is None:
        return None
    found = []
    for name, selector in json.loads(options_text or "{}").items():
        node = page.first(selector, css=True)
        found.append((name, page.text(node) if node else None))
    return found


def _slices(columns: tuple[pa.Array, ...]) -> Iterator[tuple[pa.Array, ...]]:
    """The rows of a batch in parts of about :data:`SLICE_BYTES` of its first column, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(columns[0]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low, done = 0, 0
    while low < len(ends):
        high = max(int(np.searchsorted(ends, done + SLICE_BYTES, side="right")), low + 1)
        yield tuple(column.slice(low, high - low) for column in columns)
        low, done = high, int(ends[high - 1])


def _arrow(function, arrow_type: pa.DataType, batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    for batch in batches:
        for columns in _slices(batch):
            rows = [function(*values) for values in zip(*(column.to_pylist() for column in columns), strict=True)]
            yield pa.array(rows, type=arrow_type)


@F.arrow_udf(LISTING_RESULT)
def _listing_udf(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    yield from _arrow(_listing_items, _LISTING_ARROW, batches)


@F.arrow_udf(S.ARTICLE_PARTS)
def _article_udf(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    yield from _arrow(_article_parts, _ARTICLE_ARROW, batches)


@F.arrow_udf(S.CLEANED)
def _clean_udf(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    yield from _arrow(_cleaned, _CLEANED_ARROW, batches)


@F.arrow_udf(FIELD_MAP)
def _fields_udf(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    yield from _arrow(_fields, _FIELDS_ARROW, batches)


# column functions -------------------------------------------------------------------
def listing_items(html: Column, options: Column, links_only: bool = False) -> Column:
    """All item elements of a listing page, also those without a link (``href`` empty).

    With ``links_only`` the same items with their link alone.
    """
    return _listing_udf(html, options, F.lit(links_only))


def linked_items(items: Column) -> Column:
    """Drop the items without a link target."""
    return F.filter(items, lambda item: item["href"] != "")


def article_parts(
    html: Column, options: Column, keep_body: bool = True, summary_html: Column | None = None
) -> Column:
    """Body, title, metadata, safe HTML and clean text of an article page; null without a body.

    ``summary`` is the clean text of the page's own ``summary_html``, else of the given one. The
    collect job stores safe HTML only and leaves the original body out.
    """
    given = F.lit(None).cast("string") if summary_html is None else summary_html
    return _article_udf(html, options, F.lit(keep_body), given)


def extract_fields(html: Column, selectors: dict[str, str]) -> Column:
    """``map<field, text>`` of the first match per selector; null text where nothing matches."""
    return _fields_udf(html, F.lit(json.dumps(selectors)))


def missing_fields(fields: Column, required: tuple[str, ...] = ("title", "body")) -> Column:
    """Names of the required fields that are absent or empty."""
    names = [
        F.when(F.coalesce(F.try_element_at(fields, F.lit(n)), F.lit("")) == "", F.lit(n)) for n in sorted(required)
    ]
    return F.array_compact(F.array(*names))


def clean(html: Column, allowed_tags: tuple[str, ...] | None = None) -> Column:
    """Struct of ``safe_html`` and clean ``text`` from one parse."""
    return _clean_udf(html, F.lit(json.dumps({"allowed_tags": list(allowed_tags)}) if allowed_tags else "{}"))


def sanitize_html(html: Column, allowed_tags: tuple[str, ...] | None = None) -> Column:
    return clean(html, allowed_tags)["safe_html"]


def html_to_text(html: Column) -> Column:
    """Clean text of an HTML fragment. Text without markup or entities never leaves the JVM."""
    has_markup = html.rlike("[<&]")
    parsed = _clean_udf(F.when(has_markup, html), F.lit("{}"))["text"]
    return F.when(has_markup, parsed).otherwise(collapse_text(html))
