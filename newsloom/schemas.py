"""Explicit schemas of every stage; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _TS = T.StringType(), T.IntegerType(), T.TimestampType()
STRING_MAP = T.MapType(_S, _S)
STRING_LIST = T.ArrayType(_S)

PAGINATION = T.StructType(
    [
        T.StructField("param", _S),
        T.StructField("start", _I),
        T.StructField("stop", _I),
        T.StructField("step", _I),
        T.StructField("count", _I),
        T.StructField("limit", _I),
        T.StructField("pages", T.ArrayType(_I)),
        T.StructField("params", STRING_MAP),
    ]
)

# The same as users write it: numbers may be text.
PAGINATION_TEXT = T.StructType(
    [
        T.StructField(f.name, T.ArrayType(_S) if f.name == "pages" else f.dataType if f.name == "params" else _S)
        for f in PAGINATION.fields
    ]
)

PAGE_ENTRY = T.StructType(
    [
        T.StructField("url", _S),
        T.StructField("metadata", STRING_MAP),
        T.StructField("tags", STRING_LIST),
        T.StructField("pagination", PAGINATION),
    ]
)

# One row per configured page; `settings` columns repeat the portal's options.
PAGES_PLAN = T.StructType(
    [
        T.StructField("portal_idx", _I),
        T.StructField("portal", _S),
        T.StructField("page_index", _I),
        T.StructField("page_url", _S),
        T.StructField("page_meta", STRING_MAP),
        T.StructField("page_tags", STRING_LIST),
        T.StructField("pagination", PAGINATION),
        T.StructField("listing_options", _S),
        T.StructField("article_options", _S),
        T.StructField("default_base", _S),
        T.StructField("fp_fields", STRING_LIST),
        T.StructField("fp_prefix", _S),
    ]
)

RAW_PAGES = T.StructType(
    [
        T.StructField("request_url", _S),
        T.StructField("final_url", _S),
        T.StructField("status_code", _I),
        T.StructField("html", _S),
        T.StructField("fetched_at", _TS),
    ]
)

JSON_PAYLOADS = T.StructType(
    [
        T.StructField("request_url", _S),
        T.StructField("status_code", _I),
        T.StructField("payload", _S),
    ]
)

# Arrow UDF results ---------------------------------------------------------------
LISTING_ITEM = T.StructType(
    [
        T.StructField("href", _S),
        T.StructField("content", _S),
        T.StructField("link_text", _S),
        T.StructField("title_text", _S),
        T.StructField("summary_html", _S),
        T.StructField("summary_text", _S),
        T.StructField("meta", STRING_MAP),
        T.StructField("lists", T.MapType(_S, STRING_LIST)),
    ]
)

ARTICLE_PARTS = T.StructType(
    [
        T.StructField("found", T.BooleanType()),
        T.StructField("body_html", _S),
        T.StructField("title_text", _S),
        T.StructField("meta", STRING_MAP),
        T.StructField("lists", T.MapType(_S, STRING_LIST)),
        T.StructField("safe_html", _S),
        T.StructField("text", _S),
        T.StructField("summary", _S),
    ]
)

CLEANED = T.StructType([T.StructField("safe_html", _S), T.StructField("text", _S)])

# Items handed from a scraper to the collect job ------------------------------------
SCRAPED_ITEMS = T.StructType(
    [
        T.StructField("portal_idx", _I),
        T.StructField("portal", _S),
        T.StructField("page_index", _I),
        T.StructField("position", T.LongType()),
        T.StructField("url", _S),
        T.StructField("title", _S),
        T.StructField("content_html", _S),
        T.StructField("summary_html", _S),
        T.StructField("tags", STRING_LIST),
        T.StructField("published_at", _S),
        T.StructField("metadata", STRING_MAP),
    ]
)

# Listing items whose article page has not landed yet.
WAITING_ITEMS = T.StructType(
    [
        T.StructField("portal_idx", _I),
        T.StructField("portal", _S),
        T.StructField("page_index", _I),
        T.StructField("position", T.LongType()),
        T.StructField("page_url", _S),
        T.StructField("fetch_url", _S),
        T.StructField("url", _S),
        T.StructField("metadata", STRING_MAP),
        T.StructField("tags", STRING_LIST),
        T.StructField("article_options", _S),
        T.StructField("default_base", _S),
        T.StructField("fp_fields", STRING_LIST),
        T.StructField("fp_prefix", _S),
    ]
)

RAW_ARTICLES = T.StructType(
    [
        T.StructField("url", _S),
        T.StructField("title", _S),
        T.StructField("body", _S),
        T.StructField("metadata", STRING_MAP),
        T.StructField("tags", STRING_LIST),
        T.StructField("published_at", _S),
    ]
)

# The stored document.
ARTICLES = T.StructType(
    [
        T.StructField("article_id", _S),
        T.StructField("url", _S),
        T.StructField("portal_name", _S),
        T.StructField("title", _S),
        T.StructField("summary", _S),
        T.StructField("content_html", _S),
        T.StructField("content_text", _S),
        T.StructField("tags", STRING_LIST),
        T.StructField("published_at_raw", _S),
        T.StructField("published_at", _TS),
        T.StructField("collected_at", _TS),
        T.StructField("fingerprint", _S),
        T.StructField("raw_meta", STRING_MAP),
    ]
)
ARTICLE_FIELDS = [f.name for f in ARTICLES.fields if f.name != "article_id"]
