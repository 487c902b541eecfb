"""Collect inputs derived from the given tables by Spark, at any scale.

`documents` becomes a small news web: one portal per language, listing pages of fifty documents,
one article page per distinct source and text, whose hash decides which pages are broken. Whole
texts are summaries, and whole hashes of texts titles: copies within a source share an address,
copies in different sources share a title only.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import schemas as S
from newsloom.functions.urls import to_absolute

PER_PAGE = 50
# A slug between these: an article without a body, a refused page. One page in 64 each.
NO_BODY, REFUSED = ("00", "04"), ("10", "14")
PORTALS = ("de", "en", "es", "fr")
LISTING_OPTIONS = {
    "item_selector": "ul.list li.item",
    "link_selector": "a",
    "summary_selector": ".summary",
    "metadata_selectors": {"tags": {"selector": "span.tag", "all": True}, "published_at": "time.date"},
}
ARTICLE_OPTIONS = {
    "body_selector": "article .content",
    "title_selector": "h1",
    "metadata_selectors": {"section": {"selector": "article", "attr": "data-section"}},
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def title_of(text: Column) -> Column:
    """A title that only copies share."""
    return F.concat(F.lit("Nota "), F.sha2(text, 256))


def slug_of(source: Column, text: Column) -> Column:
    """The address of a text in its source."""
    return F.sha2(F.concat(source, F.lit(" "), text), 256)


def _within(slug: Column, ends: tuple[str, str]) -> Column:
    return (slug >= ends[0]) & (slug < ends[1])


def escaped(text: Column) -> Column:
    amp = F.replace(text, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(amp, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def portal_index(lang: Column) -> Column:
    index = F.lit(len(PORTALS))
    for i, name in enumerate(PORTALS):
        index = F.when(lang == name, F.lit(i)).otherwise(index)
    return index


def _html(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _host(lang: Column) -> Column:
    return _html("https://", lang, ".news.example")


def article_pages(docs: DataFrame) -> DataFrame:
    """One landed page per distinct source and text of a language."""
    slug = slug_of(F.col("source"), F.col("text"))
    distinct = docs.groupBy("lang", slug.alias("slug")).agg(F.any_value("text").alias("text"))
    text = F.col("text")
    body = _html('<div class="content" onclick="x()"><p>', escaped(text), '</p><script>track("</p>")</script></div>')
    html = _html(
        "<!DOCTYPE html><html><head><title>t</title></head><body><!-- ad --><article data-section=\"",
        F.col("lang"), '"><h1>', title_of(text), "</h1>",
        F.when(_within(F.col("slug"), NO_BODY), F.lit("<br>")).otherwise(body), "</article></body></html>",
    )
    refused = _within(F.col("slug"), REFUSED)
    return distinct.select(
        _html(_host(F.col("lang")), "/a/", F.col("slug")).alias("request_url"),
        F.lit(None).cast("string").alias("final_url"),
        F.when(refused, F.lit(404)).otherwise(F.lit(200)).alias("status_code"),
        html.alias("html"),
        F.lit(None).cast("timestamp").alias("fetched_at"),
    )


def _listing_chunks(docs: DataFrame) -> DataFrame:
    """Items grouped by page; a page holds at most fifty because `doc_id` is unique."""
    text = F.col("text")
    date = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n_chars") % 9000).cast("int")), "dd/MM/yyyy")
    item = _html(
        '<li class="item"><a href="/a/', slug_of(F.col("source"), text), '">', title_of(text),
        '</a><div class="summary">', escaped(text), '</div><span class="tag">', F.col("lang"),
        '</span><span class="tag"> ', F.col("source"), ' </span><time class="date">', date, "</time></li>",
    )
    chunk = F.floor(F.col("doc_id") / PER_PAGE)
    rows = docs.select("lang", (chunk + 1).cast("int").alias("page_index"), "doc_id", item.alias("li"))
    return rows.groupBy("lang", "page_index").agg(F.sort_array(F.collect_list(F.struct("doc_id", "li"))).alias("items"))


def listing_url(lang: Column, page_index: Column) -> Column:
    return _html(_host(lang), "/list/", page_index.cast("string"))


def document_web(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Page plan and landed pages of the documents."""
    docs = table(spark, sf_dir, "documents")
    chunks = _listing_chunks(docs)
    lis = F.array_join(F.transform("items", lambda i: i["li"]), "")
    listings = chunks.select(
        listing_url(F.col("lang"), F.col("page_index")).alias("request_url"),
        F.lit(None).cast("string").alias("final_url"),
        F.lit(200).alias("status_code"),
        _html('<html><body><ul class="list">', lis, "</ul></body></html>").alias("html"),
        F.lit(None).cast("timestamp").alias("fetched_at"),
    )
    places = docs.select("lang", (F.floor(F.col("doc_id") / PER_PAGE) + 1).cast("int").alias("page_index")).distinct()
    plan = places.select(
        portal_index(F.col("lang")).alias("portal_idx"),
        F.col("lang").alias("portal"),
        "page_index",
        listing_url(F.col("lang"), F.col("page_index")).alias("page_url"),
        F.create_map(F.lit("portal_name"), F.col("lang")).alias("page_meta"),
        F.lit(None).cast("array<string>").alias("page_tags"),
        F.lit(None).cast(S.PAGINATION).alias("pagination"),
        F.lit(json.dumps(LISTING_OPTIONS)).alias("listing_options"),
        F.lit(json.dumps(ARTICLE_OPTIONS)).alias("article_options"),
        F.lit(None).cast("string").alias("default_base"),
        F.array(F.lit("title")).alias("fp_fields"),
        F.lit("").alias("fp_prefix"),
    )
    return plan, listings.unionByName(article_pages(docs))


def document_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as scraped items of one portal per language, fifty to a page."""
    docs = table(spark, sf_dir, "documents")
    slug = F.sha2("text", 256)
    return docs.select(
        portal_index(F.col("lang")).alias("portal_idx"),
        F.col("lang").alias("portal"),
        (F.floor(F.col("doc_id") / PER_PAGE) + 1).cast("int").alias("page_index"),
        F.col("doc_id").alias("position"),
        to_absolute(_html("../a/", slug), _html(_host(F.col("lang")), "/list/1")).alias("url"),
        F.col("text"),
        F.col("n_chars"),
    )
