"""Feeds as listings: RSS, Atom and sitemaps, sitemap indexes included.

A landed feed is parsed by Spark's own XML functions with one explicit schema over the roots of
all kinds, names without their prefixes. What is not well formed, or has another root, is a
``parse`` error; a feed that has not landed is a ``fetch`` error, as for other pages.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.dates import parse_date
from newsloom.functions.tags import normalize_list
from newsloom.functions.text import bind, collapse_text, empty_to_null, strip
from newsloom.functions.urls import to_absolute
from newsloom.operators.boundary import running_offset
from newsloom.session import Staging
from newsloom.sources.landed import PARSE_ERROR, join_pages

RSS, SITEMAP, LISTING = "rss", "sitemap", "listing"
STRATEGIES = (RSS, SITEMAP, LISTING)

_ROOT = r"(?s)^(?:\s|\x{FEFF}|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>]*>)*<(?:[\w.-]+:)?([\w.-]+)"
# Root elements and what they hold (fixed values of the formats).
_KINDS = {"rss": RSS, "RDF": RSS, "feed": RSS, "urlset": SITEMAP, "sitemapindex": "index"}

_LINKS = "array<struct<_VALUE:string,_href:string,_rel:string>>"
_TERMS = "array<struct<_VALUE:string,_term:string>>"
_ITEM = f"struct<title:string,link:{_LINKS},guid:string,description:string,encoded:string,pubDate:string,date:string,category:{_TERMS},subject:array<string>>"
_ENTRY = f"struct<title:string,link:{_LINKS},id:string,summary:string,content:string,published:string,updated:string,category:{_TERMS}>"
_NEWS = "struct<title:string,publication_date:string>"
_FEED = (
    f"struct<channel:struct<item:array<{_ITEM}>>,item:array<{_ITEM}>,entry:array<{_ENTRY}>,"
    f"url:array<struct<loc:string,lastmod:string,news:{_NEWS}>>,sitemap:array<struct<loc:string>>,_broken:string>"
)
_XML = {"ignoreNamespace": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
_ENTRIES = "array<struct<href:string,title:string,summary_html:string,content_html:string,published_at_raw:string,tags:array<string>,guid:string>>"

# Zone names of mail dates (fixed values).
_ZONES = {
    "UT": "+0000", "UTC": "+0000", "GMT": "+0000", "Z": "+0000", "EST": "-0500", "EDT": "-0400", "CST": "-0600",
    "CDT": "-0500", "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}
_MAIL_DATE = r"^(?:[A-Za-z]{3,9},?\s+)?(\d{1,2})\s+([A-Za-z]{3})[a-z]*\s+(\d{4}|\d{2})\s+(\d{2}:\d{2})(?::(\d{2}))?\s*([+-]\d{4}|[A-Za-z]{1,4})?$"


def parse_feed_date(text: Column) -> Column:
    """Timestamp of a mail date (``Mon, 01 Jan 2024 10:00:00 GMT``) or any date of :func:`parse_date`.

    Two-digit years from 50 on are 19xx. A missing zone is UTC, an unknown one gives null.
    """

    def mail(value: Column) -> Column:
        part = lambda i: F.regexp_extract(value, _MAIL_DATE, i)
        year = F.when(F.length(part(3)) == 4, part(3)).when(part(3) >= "50", F.concat(F.lit("19"), part(3))).otherwise(F.concat(F.lit("20"), part(3)))
        named = F.upper(part(6))
        zone = F.when(part(6) == "", F.lit("+0000")).when(part(6).rlike("^[+-]"), part(6))
        for name, offset in _ZONES.items():
            zone = zone.when(named == name, F.lit(offset))
        seconds = F.when(part(5) == "", F.lit("00")).otherwise(part(5))
        written = F.concat(part(1), F.lit(" "), part(2), F.lit(" "), year, F.lit(" "), part(4), F.lit(":"), seconds, F.lit(" "), zone)
        return F.when(value.rlike(_MAIL_DATE), F.try_to_timestamp(written, F.lit("d MMM yyyy HH:mm:ss Z")))

    return F.coalesce(bind(strip(text), mail), parse_date(text))


def feed_kind(xml: Column) -> Column:
    """``rss``, ``sitemap`` or ``index`` by the root element; null for anything else."""
    root = F.regexp_extract(xml, _ROOT, 1)
    kind = F.lit(None).cast("string")
    for name, value in _KINDS.items():
        kind = F.when(root == name, F.lit(value)).otherwise(kind)
    return kind


def _link(links: Column, alternate_only: bool) -> Column:
    """The address of an entry: text of a link, else its first alternate reference."""
    text = F.filter(F.transform(links, lambda x: strip(x["_VALUE"])), lambda x: F.coalesce(x, F.lit("")) != "")
    refs = F.filter(links, lambda x: x["_href"].isNotNull() & (F.coalesce(x["_rel"], F.lit("alternate")) == "alternate"))
    hrefs = F.transform(refs, lambda x: strip(x["_href"]))
    return F.coalesce(*([] if alternate_only else [F.get(text, F.lit(0))]), F.get(hrefs, F.lit(0)))


def _terms(categories: Column) -> Column:
    return F.transform(categories, lambda x: F.coalesce(x["_term"], x["_VALUE"]))


def _entry(href: Column, title: Column, summary: Column, content: Column, date: Column, tags: Column, guid: Column) -> Column:
    text = lambda c: empty_to_null(strip(c))
    tags = normalize_list(F.coalesce(tags, F.array().cast("array<string>")))
    return F.struct(
        text(href).alias("href"), empty_to_null(collapse_text(title)).alias("title"), text(summary).alias("summary_html"),
        text(content).alias("content_html"), text(date).alias("published_at_raw"), tags.alias("tags"), text(guid).alias("guid"),
    )


def _rss_entry(x: Column) -> Column:
    guid = strip(x["guid"])
    href = F.coalesce(_link(x["link"], False), F.when(guid.rlike("^(?i)https?://"), guid))
    tags = F.coalesce(_terms(x["category"]), x["subject"])
    return _entry(href, x["title"], x["description"], x["encoded"], F.coalesce(x["pubDate"], x["date"]), tags, guid)


def _atom_entry(x: Column) -> Column:
    date = F.coalesce(x["published"], x["updated"])
    return _entry(_link(x["link"], True), x["title"], x["summary"], x["content"], date, _terms(x["category"]), x["id"])


def _sitemap_entry(x: Column) -> Column:
    none, news = F.lit(None).cast("string"), x["news"]
    return _entry(x["loc"], news["title"], none, none, F.coalesce(news["publication_date"], x["lastmod"]), F.lit(None).cast("array<string>"), none)


def parse_feeds(landed: DataFrame) -> DataFrame:
    """``landed`` (``html``, ``error_kind``, any other columns) with ``kind, entries, children``.

    The XML goes no further than this. An entry without an address is dropped.
    """
    parsed = landed.withColumn("kind", feed_kind(F.col("html"))).withColumn("feed", F.from_xml(F.when(F.col("kind").isNotNull(), F.col("html")), _FEED, _XML))
    feed = F.col("feed")
    fine = F.col("error_kind").isNull() & F.col("kind").isNotNull() & feed["_broken"].isNull()
    items = F.coalesce(feed["channel"]["item"], feed["item"])
    entries = F.coalesce(F.transform(items, _rss_entry), F.transform(feed["entry"], _atom_entry), F.transform(feed["url"], _sitemap_entry))
    entries = F.filter(F.coalesce(entries, F.array().cast(_ENTRIES)), lambda e: e["href"].isNotNull())
    children = F.filter(F.transform(feed["sitemap"], lambda x: strip(x["loc"])), lambda x: F.coalesce(x, F.lit("")) != "")
    error = F.coalesce("error_kind", F.when(~fine, F.lit(PARSE_ERROR)))
    return parsed.select(
        *[c for c in landed.columns if c not in ("html", "error_kind")],
        error.alias("error_kind"),
        F.when(fine, F.col("kind")).alias("kind"),
        F.when(fine, entries).alias("entries"),
        F.when(fine & (F.col("kind") == "index"), F.coalesce(children, F.array().cast("array<string>"))).alias("children"),
    )


@dataclass(frozen=True)
class Feeds:
    """``states``: every feed, and with ``parent_url`` every sitemap of an index, with its kind,
    error and number of entries;
    ``items``: the entries as listing items."""

    states: DataFrame
    items: DataFrame


def read_feeds(plan: DataFrame, raw_pages: DataFrame, keep: Staging | None = None) -> Feeds:
    """Items of the planned feeds (``portal_idx, portal, page_index, page_url``).

    ``raw_pages`` are landed pages, one row per ``request_url``. The sitemaps of an index are
    looked up among them too; an index within an index is a parse error. Positions count the
    entries of a page from 1 on, over the sitemaps of an index in their order. Addresses are made
    absolute against the final address of their feed.
    """
    keep = keep or Staging(plan.sparkSession)
    page = ["portal_idx", "portal", "page_index"]
    wanted = plan.select(*page, F.col("page_url").alias("request_url"), F.lit(None).cast("string").alias("parent_url"), F.lit(0).alias("request_pos"))
    top = keep(parse_feeds(join_pages(wanted, raw_pages)), "feeds")
    nested = top.where("kind = 'index'").select(*page, F.col("request_url").alias("parent_url"), F.posexplode("children").alias("request_pos", "loc"), "final_url")
    nested = nested.select(*page, "parent_url", "request_pos", to_absolute(F.col("loc"), F.col("final_url")).alias("request_url"))
    below = parse_feeds(join_pages(nested, raw_pages))
    nested_index = F.col("kind") == "index"
    below = below.withColumns({
        "error_kind": F.when(nested_index, F.lit(PARSE_ERROR)).otherwise(F.col("error_kind")),
        "entries": F.when(~nested_index, F.col("entries")),
    })
    below = keep(below, "sitemaps")
    both = top.unionByName(below)
    size = F.when(F.col("error_kind").isNull(), F.size("entries")).otherwise(F.lit(0))
    states = both.select(*page, "request_url", "parent_url", "request_pos", "kind", "error_kind", size.alias("n_items"))

    held = both.where(F.size("entries") > 0)
    offsets = running_offset(held.select("portal_idx", "page_index", "request_pos", F.size("entries").alias("n")), ["portal_idx", "page_index"], "request_pos", "n")
    rows = held.join(offsets.drop("n"), ["portal_idx", "page_index", "request_pos"])
    rows = rows.select(*page, "final_url", "offset", "kind", F.posexplode("entries").alias("pos", "entry"))
    entry = lambda name: F.col(f"entry.{name}").alias(name)
    items = rows.select(
        *page,
        (F.col("offset") + F.col("pos") + 1).cast("long").alias("position"),
        F.col("kind").alias("strategy"),
        to_absolute(F.col("entry.href"), F.col("final_url")).alias("url"),
        entry("title"), entry("summary_html"), entry("content_html"), entry("tags"), entry("guid"), entry("published_at_raw"),
        parse_feed_date(F.col("entry.published_at_raw")).alias("published_at"),
    )
    return Feeds(states, items)


def by_priority(items: DataFrame, priorities: DataFrame) -> DataFrame:
    """The items of each portal's first strategy that found any.

    ``priorities`` has ``portal_idx, priority``, strategies from the most wanted on. Strategies
    that a portal does not list are dropped. One narrow row per portal goes back to the items.
    """
    ranked = items.join(priorities.select("portal_idx", "priority"), "portal_idx")
    ranked = ranked.withColumn("_rank", F.array_position("priority", F.col("strategy"))).where("_rank > 0").drop("priority")
    best = ranked.groupBy("portal_idx").agg(F.min("_rank").alias("_rank"))
    return ranked.join(best, ["portal_idx", "_rank"]).select(*items.columns)
