"""Verification queries: each runs operators over whole tables, most with an equal SQL query.

Results hold scalar columns only, with the same names and integer widths as the SQL.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import schemas as S
from newsloom.functions.dates import parse_date
from newsloom.functions.fingerprint import fingerprint
from newsloom.functions.metadata import merge_maps, portal_name, set_default
from newsloom.functions.tags import split_tags
from newsloom.functions.urls import to_absolute
from newsloom.operators.boundary import page_status
from newsloom.operators.dedup import dedup_fingerprint, dedup_url, new_fingerprints
from newsloom.operators.extract import (
    article_parts,
    extract_fields,
    html_to_text,
    linked_items,
    listing_items,
    missing_fields,
    sanitize_html,
)
from newsloom.operators.metrics import outcome_counts, run_metrics, run_report
from newsloom.operators.normalize import build_articles, simple_normalize
from newsloom.operators.paginate import expand_requests
from newsloom.operators.upsert import plan_by_url, plan_with_unique_fingerprint, upserted, write_log
from newsloom.plans.collect import CollectResult, Options, collect
from newsloom.plans.json_ingest import ingest_json_listing
from newsloom.plans.samples import document_items, document_web, escaped, slug_of, table, title_of
from newsloom.session import configure, shuffles_removed, spread, stage, staging_root
from newsloom.sources.json_listing import listing_items as json_items
from newsloom.sources.landed import join_pages, latest_pages
from newsloom.sources.portals import build_page_plan, config_violations, load_page_plan
from newsloom.sources.store import current_articles
from newsloom.streaming.incremental import incremental_collect, landed_stream

RUN_TS = "2024-06-01 12:00:00"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL form if there is one."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(configure(spark), sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def _text_time(column: Column) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


# SQL fragments -------------------------------------------------------------------------
def _sql_collapse(text: str) -> str:
    return (
        rf"regexp_replace(trim(regexp_replace({text}, '\s+', ' ', 'g')), ' +([!?.,;:])', '\1', 'g')"
    )


def _sql_strip(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


_SQL_PORTAL = "CASE lang WHEN 'de' THEN 0 WHEN 'en' THEN 1 WHEN 'es' THEN 2 WHEN 'fr' THEN 3 ELSE 4 END"


# page plan -----------------------------------------------------------------------------
@query("""
WITH seeds AS (
  SELECT p_partkey, p_size AS s, p_partkey % 6 AS kind FROM part),
numbers AS (
  SELECT p_partkey, 0 AS request_pos, NULL::INTEGER AS page_no FROM seeds WHERE kind = 0
  UNION ALL
  SELECT p_partkey, i, s + 2 * i FROM seeds, range(0, 30) r(i) WHERE kind = 1 AND s + 2 * i <= s + 7
  UNION ALL
  SELECT p_partkey, i, s - 3 * i FROM seeds, range(0, 30) r(i) WHERE kind = 2 AND s - 3 * i >= 1
  UNION ALL
  SELECT p_partkey, i, 1 + i FROM seeds, range(0, 60) r(i) WHERE kind = 3 AND i < greatest(s, 1) AND i < 5
  UNION ALL
  SELECT p_partkey, i, CASE i WHEN 0 THEN s ELSE 3 END FROM seeds, range(0, 2) r(i) WHERE kind = 4)
SELECT p_partkey, CAST(request_pos AS INTEGER) AS request_pos, CAST(page_no AS INTEGER) AS page_no,
  'https://h.example/l/' || p_partkey ||
  CASE WHEN page_no IS NULL THEN '' ELSE '?q=a+b&pg=' || page_no END AS request_url
FROM numbers
""")
def pagination_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pagination setting per part: none, up, down, count with limit, explicit, empty."""
    size, kind = F.col("p_size"), F.col("p_partkey") % 6
    none = F.lit(None).cast("int")
    value = lambda **by_kind: F.coalesce(
        *[F.when(kind == int(k[1:]), v) for k, v in by_kind.items()], none
    ).cast("int")
    pagination = F.struct(
        F.lit("pg").alias("param"),
        value(k1=size, k2=size, k3=F.lit(1), k5=F.lit(5)).alias("start"),
        value(k1=size + 7, k2=F.lit(1), k5=F.lit(4)).alias("stop"),
        value(k1=F.lit(2), k2=F.lit(-3)).alias("step"),
        value(k3=size).alias("count"),
        value(k3=F.lit(5)).alias("limit"),
        F.when(kind == 4, F.array(size, F.lit(3))).alias("pages"),
        F.create_map(F.lit("q"), F.lit("a b")).alias("params"),
    )
    plan = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.concat(F.lit("https://h.example/l/"), F.col("p_partkey").cast("string")).alias("page_url"),
        F.when(kind != 0, pagination).alias("pagination"),
    )
    return expand_requests(plan).select("p_partkey", "request_pos", "page_no", "request_url")


def _config_texts(spark: SparkSession, sf_dir: str, writer: bool = False) -> DataFrame:
    """One portal configuration per supplier; a low balance leaves the writer out unless it is asked for."""
    component = F.struct(F.lit("a:b").alias("factory"))
    given = component if writer else F.when(F.col("s_acctbal") >= 5000, component)
    meta = F.struct(F.col("s_nationkey").cast("string").alias("nation"), F.lit("x, y").alias("tags"))
    page = lambda n, own: F.struct(
        F.concat(F.lit(f"https://h.example/{n}/"), F.col("s_suppkey").cast("string")).alias("url"), own.alias("metadata")
    )
    own = F.struct(F.lit("own").alias("nation"), F.lit(None).cast("string").alias("section"))
    other = F.struct(F.lit(None).cast("string").alias("nation"), F.lit("s").alias("section"))
    names = ("scraper", "url_normalizer", "date_normalizer", "text_cleaner", "deduper")
    components = F.struct(*[component.alias(n) for n in names], given.alias("writer"))
    config = F.struct(
        F.concat(F.lit(" "), F.col("s_name"), F.lit(" ")).alias("name"), meta.alias("metadata"),
        F.array(page("a", own), page("b", other)).alias("pages"), components.alias("components"),
    )
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("portal_idx"), F.col("s_name").alias("file"), F.to_json(config).alias("text")
    )


# Broken configurations: a part of the valid text, what stands there instead, and the rule it breaks.
_BROKEN = (
    ('"name":"', '"name":"  ","x":"', "name is required"),
    ('"pages":[', '"pages":"p","x":[', "pages must be a list"),
    ('"pages":[', '"pages":[7,', "every page must be an object"),
    ('"metadata":{"nation":"own"', '"metadata":[],"x":{"nation":"own"', "page metadata must be an object"),
    ('"components":{', '"components":{},"x":{', "component scraper is required"),
    ('"scraper":{"factory":"a:b"', '"scraper":{"factory":" "', "component scraper needs a factory"),
    ('"deduper":{', '"deduper":{"options":[],', "component deduper options must be an object"),
    ('"pages":[{', '"pages":[{"pagination":[1,2],', "pagination must be an object"),
    ('"pages":[{', '"pages":[{"pagination":{"start":"x"},', "pagination start must be a whole number"),
    ('"pages":[{', '"pages":[{"pagination":{"count":1.5},', "pagination count must be a whole number"),
    ('"pages":[{', '"pages":[{"pagination":{"pages":["1","q"]},', "pagination pages must be a list of whole numbers"),
    ('"pages":[{', '"pages":[{"pagination":{"limit":-1,"stop":" 3 "},', "pagination limit must not be negative"),
    ('"scraper":{"factory":"a:b"', '"scraper":{"factory":"a:b","options":{"pagination":{"params":[1],"param":2}}', "pagination params must be an object"),
)


@query(
    "WITH broken AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{rule}')" for i, (_, _, rule) in enumerate(_BROKEN)) + """) AS t(kind, rule)),
s AS (SELECT s_name AS file, s_suppkey % 15 AS kind, s_acctbal < 5000 AS poor FROM supplier)
SELECT file, rule FROM s JOIN broken USING (kind) WHERE kind <> 4
UNION ALL SELECT file, 'component ' || name || ' is required' FROM s, (VALUES ('scraper'), ('url_normalizer'), ('date_normalizer'),
  ('text_cleaner'), ('deduper'), ('writer')) AS c(name) WHERE kind = 4
UNION ALL SELECT file, 'component writer is required' FROM s WHERE poor AND kind NOT IN (4, 14)
UNION ALL SELECT file, 'pagination param must be text' FROM s WHERE kind = 12
UNION ALL SELECT file, 'config must be an object' FROM s WHERE kind = 14
"""
)
def config_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier's configuration, most of them broken in one way."""
    kind, text = F.col("portal_idx") % 15, F.col("text")
    broken = F.when(kind == 14, F.lit("[1]"))
    for i, (old, new, _) in enumerate(_BROKEN):
        broken = broken.when(kind == i, F.concat(F.substring_index(text, old, 1), F.lit(new), F.substr(text, F.instr(text, F.lit(old)) + F.lit(len(old)))))
    return config_violations(_config_texts(spark, sf_dir).withColumn("text", broken.otherwise(text)))


@query("""
SELECT CAST(row_number() OVER (ORDER BY s_suppkey || '/') - 1 AS INTEGER) AS portal_idx, trim(s_name) AS portal FROM supplier
""")
def config_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configurations as files in nested folders, found, validated and planned."""
    texts = _config_texts(spark, sf_dir, writer=True).select(F.from_json("text", "name string, metadata struct<nation:string,tags:string>, "
        "pages array<struct<url:string,metadata map<string,string>>>, components map<string,struct<factory:string>>").alias("c"), F.col("portal_idx").alias("k"))  # fmt: skip
    root = f"{staging_root(spark)}/configs-{uuid.uuid4().hex}"
    # A file takes its time, however small: all cores write, and put their files in place themselves.
    tasks = 4 * spark.sparkContext.defaultParallelism
    writer = texts.select("k", "c.*").repartition(tasks, "k").write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    writer.partitionBy("k").json(root)
    return load_page_plan(spark, directory=root).where("page_index = 1").select("portal_idx", "portal")


@query("""
SELECT CAST(s_suppkey AS INTEGER) AS portal_idx, trim(s_name) AS portal, CAST(i AS INTEGER) AS page_index,
  'https://h.example/' || CASE i WHEN 1 THEN 'a' ELSE 'b' END || '/' || s_suppkey AS page_url,
  CASE i WHEN 1 THEN 'own' ELSE CAST(s_nationkey AS VARCHAR) END AS nation,
  CASE i WHEN 2 THEN 's' END AS section, trim(s_name) AS portal_name, 'x|y' AS tags
FROM supplier, range(1, 3) r(i)
""")
def page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = build_page_plan(_config_texts(spark, sf_dir))
    meta = lambda key: F.try_element_at("page_meta", F.lit(key)).alias(key)
    return plan.select(
        "portal_idx", "portal", "page_index", "page_url", meta("nation"), meta("section"), meta("portal_name"),
        F.array_join("page_tags", "|").alias("tags"),
    )


# extraction ----------------------------------------------------------------------------
NAV_OPTIONS = json.dumps({"item_selector": "nav ul li", "link_selector": "a"})
PAGE_OPTIONS = json.dumps(
    {
        "body_selector": "article",
        "title_selector": "h1",
        "metadata_selectors": {
            "lang": {"selector": "html", "attr": "lang"},
            "links": {"selector": "nav a", "attr": "href", "all": True},
            "head": {"selector": "title", "attr": "html"},
        },
    }
)


@query(r"""
WITH li AS (
  SELECT page_id, url, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">', 1)) AS href,
    unnest(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1)) AS label,
    generate_subscripts(regexp_extract_all(html, '<li><a href="([^"]*)">', 1), 1) AS position
  FROM pages)
SELECT page_id, CAST(position AS INTEGER) AS position,
  regexp_extract(url, '^[a-z]+://[^/?#]+') || href AS link_url,
  nullif(trim(replace(replace(label, '&amp;', '&'), '&quot;', '"')), '') AS link_text
FROM li WHERE trim(href) <> ''
""")
def listing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(table(spark, sf_dir, "pages"))
    items = linked_items(listing_items(F.col("html"), F.lit(NAV_OPTIONS)))
    rows = pages.select("page_id", "url", F.posexplode(items).alias("pos", "item"))
    return rows.select(
        "page_id",
        (F.col("pos") + 1).cast("int").alias("position"),
        to_absolute(F.col("item.href"), F.col("url")).alias("link_url"),
        F.col("item.link_text").alias("link_text"),
    )


# The two entities of the pages; HTML decodes them also where the semicolon was cut off.
_SQL_UNESCAPE = "regexp_replace(regexp_replace({}, '&quot;?', '\"', 'g'), '&amp;?', '&', 'g')"


@query(rf"""
SELECT page_id, {_SQL_UNESCAPE.format("trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1))")} AS title,
  {_sql_collapse(_SQL_UNESCAPE.format("regexp_replace(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<[^>]*>', ' ', 'g')"))} AS content_text,
  regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
  CAST(len(regexp_extract_all(html, '<li><a href=')) AS INTEGER) AS n_links
FROM pages
""")
def article_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(table(spark, sf_dir, "pages"))
    parsed = pages.select("page_id", article_parts(F.col("html"), F.lit(PAGE_OPTIONS)).alias("a"))
    return parsed.select(
        "page_id",
        F.col("a.title_text").alias("title"),
        F.col("a.text").alias("content_text"),
        F.try_element_at("a.meta", F.lit("lang")).alias("lang"),
        F.size(F.try_element_at("a.lists", F.lit("links"))).alias("n_links"),
    )


@query(rf"""
SELECT page_id,
  nullif({_SQL_UNESCAPE.format("trim(regexp_extract(html, '<h1>([^<]*)</h1>', 1))")}, '') AS title,
  {_SQL_UNESCAPE.format("trim(regexp_extract(html, '<li><a href=[^>]*>([^<]*)</a>', 1))")} AS first_link,
  CAST(NULL AS VARCHAR) AS author, 'author' AS missing
FROM pages
""")
def selector_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    selectors = {"title": "article > h1", "link": "nav ul > li a[href]", "author": ".author, #author"}
    rows = spread(table(spark, sf_dir, "pages")).select("page_id", extract_fields(F.col("html"), selectors).alias("f"))
    value = lambda key: F.try_element_at("f", F.lit(key))
    return rows.select(
        "page_id", value("title").alias("title"), value("link").alias("first_link"), value("author").alias("author"),
        F.array_join(missing_fields(F.col("f"), ("title", "author")), ",").alias("missing"),
    )


_SQL_ENTITIES = "replace(replace({}, '&copy;', '©'), '&middot;', '·')"


@query(rf"""
WITH plain AS (
  SELECT page_id, regexp_replace(html, '(?s)<!--.*?-->|<!DOCTYPE[^>]*>|<style>.*?</style>|<script>.*?</script>', '', 'g') AS part FROM pages),
closed AS (
  SELECT page_id, replace(part, '</article>', repeat('</p>', len(regexp_extract_all(part, '<p>')) - len(regexp_extract_all(part, '</p>'))) || '</article>') AS part FROM plain)
SELECT page_id, {_sql_strip("regexp_replace(replace(" + _SQL_UNESCAPE.format(_SQL_ENTITIES.format("part")) + ", '&', '&amp;'), "
  "'</?(?:html|head|meta|title|body|nav|div|article|h1|b|footer)(?: [^>]*)?>', '', 'g')")} AS safe_html FROM closed
""")
def sanitize_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole pages: head, navigation, scripts, comments and footer included."""
    return spread(table(spark, sf_dir, "pages")).select("page_id", sanitize_html(F.col("html")).alias("safe_html"))


@query(rf"""
SELECT doc_id, '<p title="' || lang || '">' || {{esc}} || '<br></p><a>x</a>' AS safe_html FROM documents
""".replace("{esc}", "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"))
def sanitize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.concat(
        F.lit('<div class="c"><style>p{}</style><p onclick="bad()" title="'), F.col("lang"), F.lit('"><span><b>'),
        escaped(F.col("text")), F.lit('</b></span><br></p><a href=" JavaScript:x()">x</a><script>y("<p>")</script></div>'),
    )
    return spread(table(spark, sf_dir, "documents")).select("doc_id", sanitize_html(html).alias("safe_html"))


# scalar functions ------------------------------------------------------------------------
@query(f"SELECT doc_id, {_sql_collapse('text')} AS content_text FROM documents")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of documents wrapped in markup, so that every row goes through the parser."""
    html = F.concat(F.lit("<div>"), escaped(F.col("text")), F.lit("<script>x</script></div>"))
    return spread(table(spark, sf_dir, "documents")).select("doc_id", html_to_text(html).alias("content_text"))


@query("""
SELECT o_orderkey, strftime(CASE
    WHEN o_orderkey % 8 IN (2, 4) THEN o_orderdate + INTERVAL 450 MINUTE
    WHEN o_orderkey % 8 = 5 THEN o_orderdate + INTERVAL 180 MINUTE
    WHEN o_orderkey % 8 = 7 THEN NULL
    ELSE o_orderdate END, '%Y-%m-%d %H:%M:%S') AS published_at
FROM orders
""")
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, kind = F.col("o_orderdate"), F.col("o_orderkey") % 8
    form = lambda pattern: F.date_format(day, pattern)
    text = (
        F.when(kind == 0, form("yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == 1, form("d/M/yyyy"))
        .when(kind == 2, F.concat(form("dd/MM/yyyy"), F.lit(" 07:30")))
        .when(kind == 3, form("yyyy-M-d"))
        .when(kind == 4, F.concat(form("yyyy-MM-dd"), F.lit(" 07:30:00")))
        .when(kind == 5, form("yyyy-MM-dd'T'HH:mm:ss'-03:00'"))
        .when(kind == 6, form("' 'yyyyMMdd'T'HHmm'Z '"))
        .otherwise(form("dd.MM.yyyy"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", _text_time(parse_date(text)).alias("published_at"))


@query("""
SELECT o_orderkey, strftime(date_trunc('day', o_orderdate) - CASE WHEN o_orderpriority = '5-LOW' THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END,
  '%Y-%m-%d %H:%M:%S') AS published_at FROM orders WHERE o_orderpriority IN ('5-LOW', '1-URGENT')
UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderpriority NOT IN ('5-LOW', '1-URGENT')
""")
def relative_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.col("o_orderpriority")
    word = F.when(priority == "5-LOW", F.lit(" Ontem ")).when(priority == "1-URGENT", F.lit("today")).otherwise(priority)
    parsed = parse_date(word, F.col("o_orderdate") + F.expr("INTERVAL '15' HOUR"))
    return table(spark, sf_dir, "orders").select("o_orderkey", _text_time(parsed).alias("published_at"))


@query("""
SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(p_type || ', ,' || p_brand || ' ,' || p_name, ','),
  lambda x: trim(x)), lambda x: x <> ''), '|') AS tags FROM part
""")
def normalize_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.col("p_type"), F.lit(", ,"), F.col("p_brand"), F.lit(" ,"), F.col("p_name"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(split_tags(text), "|").alias("tags"))


@query("""
SELECT event_id, coalesce(props->>'$.k', '0') AS k, event_type AS kind,
  CASE WHEN value > 50 THEN 'own' ELSE 'default' END AS section,
  CASE WHEN value > 50 THEN 'Item' WHEN event_type = 'click' THEN 'Page' ELSE '' END AS portal_name
FROM events
""")
def metadata_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.create_map(
        F.lit("k"), F.lit("0"), F.lit("kind"), F.lit("page"),
        F.lit("portal_name"), F.when(F.col("event_type") == "click", F.lit("Page")).otherwise(F.lit("")),
    )
    own = F.from_json("props", S.STRING_MAP)
    item = F.create_map(F.lit("kind"), F.col("event_type"))
    special = F.when(
        F.col("value") > 50, F.create_map(F.lit("section"), F.lit("own"), F.lit("portal_name"), F.lit("Item"))
    )
    merged = set_default(merge_maps(page, own, item, special), "section", F.lit("default"))
    rows = table(spark, sf_dir, "events").select("event_id", merged.alias("m"))
    get = lambda key: F.try_element_at("m", F.lit(key)).alias(key)
    return rows.select("event_id", get("k"), get("kind"), get("section"), portal_name(F.col("m")).alias("portal_name"))


@query("""
SELECT doc_id, sha256(concat_ws('␟', 'v1', text, CASE WHEN doc_id % 3 > 0 THEN source END,
  array_to_string(list_sort([lang, source]), '␞'))) AS fingerprint, 'noop:' || source AS noop FROM documents
""")
def fingerprint_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from newsloom.functions.fingerprint import noop_fingerprint

    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "source", F.when(F.col("doc_id") % 3 > 0, F.col("source")).alias("long_source"),
        F.array("source", "lang").alias("tags"),
    )
    return docs.select(
        "doc_id",
        fingerprint(docs, "text, long_source, tags", "v1").alias("fingerprint"),
        noop_fingerprint(F.col("source")).alias("noop"),
    )


# dedup --------------------------------------------------------------------------------------
_SQL_ITEMS = f"""items AS (
  SELECT doc_id, text, n_chars, {_SQL_PORTAL} AS portal_idx, lang, 1 + doc_id // 50 AS page_index,
    'https://' || lang || '.news.example/a/' || sha256(text) AS url FROM documents)"""


@query(f"""
WITH {_SQL_ITEMS}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY portal_idx, url ORDER BY page_index, doc_id) AS n FROM items)
SELECT doc_id AS position, CAST(portal_idx AS INTEGER) AS portal_idx, url FROM numbered WHERE n = 1
""")
def first_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = document_items(spark, sf_dir).select("portal_idx", "page_index", "position", "url")
    return dedup_url(items).select("position", "portal_idx", "url")


@query(f"""
WITH {_SQL_ITEMS}, seen AS (SELECT DISTINCT text FROM documents WHERE source = 'src3'),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY portal_idx, text ORDER BY page_index, doc_id) AS n FROM items)
SELECT doc_id AS position, sha256('␟' || text) AS fingerprint FROM numbered
WHERE n = 1 AND text NOT IN (SELECT text FROM seen)
""")
def first_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First item per fingerprint that a stored set of fingerprints does not hold."""
    items = document_items(spark, sf_dir)
    keyed = items.select("portal_idx", "page_index", "position", fingerprint(items, "text").alias("fingerprint"))
    docs = table(spark, sf_dir, "documents").filter("source = 'src3'")
    seen = docs.select(fingerprint(docs, "text").alias("fingerprint")).distinct()
    return dedup_fingerprint(keyed, seen).select("position", "fingerprint")


@query("""
SELECT DISTINCT sha256('␟' || text) AS fingerprint FROM documents
WHERE text NOT IN (SELECT text FROM documents WHERE lang = 'en')
""")
def seen_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    keyed = docs.select("lang", fingerprint(docs, "text").alias("fingerprint"))
    return new_fingerprints(keyed, keyed.filter("lang = 'en'"))


# fetch and page boundary -----------------------------------------------------------------------
@query("""
SELECT o.o_orderkey, 'https://h.example/c/' || o.o_custkey AS request_url,
  CASE WHEN c.c_acctbal >= 0 THEN c.c_name END AS html,
  CASE WHEN c.c_acctbal IS NULL OR c.c_acctbal < 0 THEN 'fetch' END AS error_kind
FROM orders o LEFT JOIN customer c ON c.c_custkey = o.o_custkey AND c.c_mktsegment <> 'BUILDING'
""")
def request_page_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders request a page per customer; some pages are missing, some were refused."""
    url = lambda key: F.concat(F.lit("https://h.example/c/"), F.col(key).cast("string"))
    requests = table(spark, sf_dir, "orders").select("o_orderkey", url("o_custkey").alias("request_url"))
    landed = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'BUILDING'").select(
        url("c_custkey").alias("request_url"), F.lit(None).cast("string").alias("final_url"),
        F.when(F.col("c_acctbal") < 0, F.lit(503)).otherwise(F.lit(200)).alias("status_code"), F.col("c_name").alias("html"),
    )
    return join_pages(requests, landed).select("o_orderkey", "request_url", "html", "error_kind")


@query("""
WITH p AS (SELECT CAST(o_custkey AS INTEGER) AS portal_idx, o_orderkey AS page_index, o_orderstatus = 'P' AS bad FROM orders),
a AS (SELECT *, min(CASE WHEN bad THEN page_index END) OVER (PARTITION BY portal_idx) AS stop FROM p)
SELECT portal_idx, page_index, CASE WHEN stop IS NULL OR page_index < stop THEN 'fetched'
  WHEN page_index = stop THEN 'error' ELSE 'not_run' END AS page_state FROM a
""")
def page_abort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as portals, orders as their pages; a pending order is a failing page."""
    pages = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("int").alias("portal_idx"), F.col("o_orderkey").alias("page_index"), "o_orderstatus"
    )
    failed = pages.filter("o_orderstatus = 'P'")
    return page_status(pages, failed, "abort").select("portal_idx", "page_index", "page_state")


# JSON listings ---------------------------------------------------------------------------------
def _event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty events per JSON payload, each followed by an entry that is not an object."""
    entry = F.to_json(
        F.struct(
            F.concat(F.lit("https://h.example/e/"), F.col("event_id").cast("string")).alias("url"),
            F.when(F.col("value") > 10, F.concat(F.lit("<p class=x>"), F.col("event_type"), F.lit("</p><b>"), F.col("value").cast("string"), F.lit("</b>"))).alias("content"),
            F.from_json("props", "k int")["k"].alias("k"),
            F.array("event_type").alias("tags"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("published_at"),
        )
    )
    chunk = F.floor(F.col("event_id") / 20)
    rows = table(spark, sf_dir, "events").select(chunk.alias("chunk"), "event_id", entry.alias("entry"))
    grouped = rows.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("event_id", "entry"))).alias("e"))
    joined = F.concat(F.lit("["), F.array_join(F.transform("e", lambda x: x["entry"]), ",7,"), F.lit(",null]"))
    wrapped = F.when(F.col("chunk") % 2 == 0, F.concat(F.lit('{"items":'), joined, F.lit("}"))).otherwise(joined)
    return grouped.select(
        F.concat(F.lit("p"), F.col("chunk").cast("string")).alias("request_url"), F.lit(200).alias("status_code"),
        wrapped.alias("payload"),
    )


@query("""
SELECT 'p' || event_id // 20 AS request_url, 'https://h.example/e/' || event_id AS url,
  props->>'$.k' AS k, '["' || event_type || '"]' AS tags, CASE WHEN value > 10 THEN event_type ELSE '' END AS body
FROM events
""")
def json_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = json_items(_event_payloads(spark, sf_dir))
    get = lambda key: F.try_element_at("metadata", F.lit(key)).alias(key)
    return items.select("request_url", "url", get("k"), get("tags"), F.regexp_extract("content", ">([^<]*)</p>", 1).alias("body"))


@query("""
SELECT 'https://h.example/e/' || event_id AS url, CASE WHEN value > 10 THEN event_type ELSE 'Sem título' END AS title,
  CASE WHEN value > 10 THEN event_type ELSE '' END AS summary, event_type AS tags,
  strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS published_at, props->>'$.k' AS k,
  CASE WHEN value <= 10 THEN 'parse' END AS error_kind FROM events
""")
def json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest_json_listing(_event_payloads(spark, sf_dir), {"title": "p.x", "body": "p", "extra": "i"}, RUN_TS)
    return rows.select(
        "url", "title", "summary", F.array_join("tags", "|").alias("tags"), _text_time(F.col("published_at")).alias("published_at"),
        F.try_element_at("raw_meta", F.lit("k")).alias("k"), "error_kind",
    )


# normalization -----------------------------------------------------------------------------------
@query("""
SELECT doc_id, CASE WHEN doc_id % 4 > 0 THEN source ELSE 'Fallback' END AS title, lang AS portal_name,
  substr(text, 1, 280) AS summary, CASE WHEN doc_id % 5 > 1 THEN lang || '|' || source ELSE 'd' END AS tags,
  CASE WHEN n_chars % 3 > 0 THEN '2024-01-02 03:04:05' END AS published_at,
  CASE WHEN n_chars % 3 = 2 THEN '2024-01-02T03:04:05' END AS published_at_raw,
  CASE WHEN text = '' OR n_chars % 3 = 0 THEN 'normalize' END AS error_kind
FROM documents
""")
def simple_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_date = F.lit("2024-01-02T03:04:05")
    kind = F.col("n_chars") % 3
    raw = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 4 > 0, F.col("source")).otherwise(F.lit("")).alias("title"),
        F.col("text").alias("body"),
        merge_maps(
            F.create_map(F.lit("portal_name"), F.col("lang")),
            F.when(kind == 2, F.create_map(F.lit("published_at_raw"), raw_date)),
        ).alias("metadata"),
        F.when(F.col("doc_id") % 5 > 1, F.array("lang", "source")).alias("tags"),
        F.when(kind == 0, F.lit("02/01/2024")).otherwise(raw_date).alias("published_at"),
    )
    rows = simple_normalize(raw, RUN_TS, ["d"], "Fallback")
    return rows.select(
        "doc_id", "title", "portal_name", "summary", F.array_join("tags", "|").alias("tags"),
        _text_time(F.col("published_at")).alias("published_at"), "published_at_raw", "error_kind",
    )


@query(rf"""
WITH c AS (SELECT doc_id, lang, {_sql_collapse('text')} AS content_text, {_sql_collapse('source')} AS short FROM documents),
s AS (SELECT *, CASE WHEN doc_id % 2 = 1 THEN short ELSE content_text END AS summary FROM c)
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang ELSE coalesce(nullif(summary, ''), 'Sem título') END AS title,
  lang AS portal_name, nullif(summary, '') AS summary, content_text, '2024-06-01 12:00:00' AS collected_at,
  '2024-06-01T12:00:00' AS normalized_at FROM s
""")
def build_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical rows: cleaning, summary, title and metadata defaults."""
    docs = spread(table(spark, sf_dir, "documents"))
    own_summary = F.col("doc_id") % 2 == 1
    items = docs.select(
        "doc_id",
        F.when(F.col("doc_id") % 3 == 0, F.col("lang")).alias("title"),
        F.concat(F.lit("<p>"), escaped(F.col("text")), F.lit("</p>")).alias("content_html"),
        F.when(own_summary, F.concat(F.lit("<i>"), escaped(F.col("source")), F.lit("</i>"))).alias("summary_html"),
        F.array("source").alias("tags"),
        F.lit(None).cast("string").alias("published_at"),
        F.create_map(F.lit("source"), F.col("source")).alias("metadata"),
        F.create_map(F.lit("portal_name"), F.col("lang")).alias("page_meta"),
    )
    rows = build_articles(items, RUN_TS)
    return rows.select(
        "doc_id", "title", "portal_name", "summary", "content_text", _text_time(F.col("collected_at")).alias("collected_at"),
        F.try_element_at("raw_meta", F.lit("normalized_at")).alias("normalized_at"),
    )


# landed pages --------------------------------------------------------------------------
@query("""
SELECT arg_max(doc_id, (fetched, doc_id)) AS doc_id, request_url, arg_max(status_code, (fetched, doc_id)) AS status_code, arg_max(text, (fetched, doc_id)) AS html
FROM (SELECT doc_id, text, 'https://' || source || '.example/' || CAST(doc_id % 7 AS VARCHAR) AS request_url,
    CAST(CASE WHEN doc_id % 10 = 3 THEN 404 ELSE 200 END AS INTEGER) AS status_code, doc_id * 37 % 1009 * 1000000000 + doc_id AS fetched FROM documents)
GROUP BY request_url
""")
def relanded_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest row of every URL that was landed again and again."""
    docs = table(spark, sf_dir, "documents")
    key = F.col("doc_id")
    history = docs.select(
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example/"), (key % 7).cast("string")).alias("request_url"),
        key.cast("string").alias("final_url"),
        F.when(key % 10 == 3, F.lit(404)).otherwise(F.lit(200)).alias("status_code"),
        F.col("text").alias("html"),
        F.timestamp_micros(key * 37 % 1009 * 1_000_000_000 + key).alias("fetched_at"),
    )
    return latest_pages(history).select(F.col("final_url").cast("long").alias("doc_id"), "request_url", "status_code", "html")


# the whole job --------------------------------------------------------------------------------------
def collected(spark: SparkSession, sf_dir: str, on_error: str = "skip", **options: object) -> CollectResult:
    plan, raw_pages = document_web(spark, sf_dir)
    landed = stage(raw_pages, "landed")
    return collect(plan, landed, Options(run_ts=RUN_TS, on_error=on_error, **options), unique_pages=True)


_SQL_COLLECT = rf"""d AS (
  SELECT doc_id, text, n_chars, lang, source, {_SQL_PORTAL} AS portal_idx, 1 + doc_id // 50 AS page_index,
    row_number() OVER (PARTITION BY lang, doc_id // 50 ORDER BY doc_id) AS position,
    'https://' || lang || '.news.example/a/' || slug AS url,
    CASE WHEN slug < '04' THEN 'parse' WHEN slug >= '10' AND slug < '14' THEN 'fetch' END AS error_kind,
    'Nota ' || sha256(text) AS title FROM (SELECT *, sha256(source || ' ' || text) AS slug FROM documents)),
u AS (SELECT *, row_number() OVER (PARTITION BY portal_idx, url ORDER BY page_index, position) AS un FROM d),
f AS (SELECT *, CASE WHEN un = 1 AND error_kind IS NULL THEN
    row_number() OVER (PARTITION BY portal_idx, title, un = 1 AND error_kind IS NULL ORDER BY page_index, position) END AS fn FROM u),
o AS (SELECT *, CASE WHEN un > 1 THEN 'url' WHEN error_kind IS NOT NULL THEN error_kind
    WHEN fn > 1 THEN 'fingerprint' ELSE 'persisted' END AS outcome FROM f)"""


@query(f"""
WITH {_SQL_COLLECT}
SELECT CAST(portal_idx AS INTEGER) AS portal_idx, CAST(page_index AS INTEGER) AS page_index, position, lang AS portal, url, outcome FROM o
""")
def collect_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = collected(spark, sf_dir)
    return result.outcomes.select("portal_idx", "page_index", "position", "portal", "url", "outcome")


@query(rf"""
WITH {_SQL_COLLECT}
SELECT url, lang AS portal_name, title, nullif({_sql_collapse('text')}, '') AS summary,
  '<p>' || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</p>' AS content_html,
  {_sql_collapse('text')} AS content_text, lang || '|' || source AS tags,
  strftime(DATE '2024-01-01' + CAST(n_chars % 9000 AS INTEGER), '%d/%m/%Y') AS published_at_raw,
  strftime(DATE '2024-01-01' + CAST(n_chars % 9000 AS INTEGER), '%Y-%m-%d 00:00:00') AS published_at,
  sha256('␟' || title) AS fingerprint, lang AS section
FROM o WHERE outcome = 'persisted'
""")
def collect_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the documents of the whole two-hop collect job."""
    return collected(spark, sf_dir).changes.select(
        "url", "portal_name", "title", "summary", "content_html", "content_text", F.array_join("tags", "|").alias("tags"),
        "published_at_raw", _text_time(F.col("published_at")).alias("published_at"), "fingerprint",
        F.try_element_at("raw_meta", F.lit("section")).alias("section"),
    )


@query(f"""
WITH {_SQL_COLLECT}
SELECT CAST(portal_idx AS INTEGER) AS portal_idx, lang AS portal, outcome, count(*) AS items FROM o GROUP BY ALL
""")
def collect_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcome_counts(collected(spark, sf_dir).outcomes)


@query(f"""
WITH {_SQL_COLLECT}
SELECT lang AS portal, count(*) FILTER (outcome = 'persisted') AS processed,
  count(*) FILTER (outcome = 'url') AS skipped_url, count(*) FILTER (outcome = 'fingerprint') AS skipped_fingerprint,
  count(DISTINCT page_index) AS pages_total, count(DISTINCT page_index) AS pages_fetched FROM o GROUP BY 1
""")
def collect_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = collected(spark, sf_dir)
    report = run_report(run_metrics(result.pages, result.outcomes))
    m = F.col("result.metrics")
    skipped = lambda key: F.coalesce(F.try_element_at(m["skipped"], F.lit(key)), F.lit(0))
    return report.select(
        "portal", m["processed"].alias("processed"), skipped("url").alias("skipped_url"),
        skipped("fingerprint").alias("skipped_fingerprint"), m["pages"]["total"].alias("pages_total"),
        m["pages"]["fetched"].alias("pages_fetched"),
    )


@query(f"""
WITH {_SQL_COLLECT}
SELECT CAST(portal_idx AS INTEGER) AS portal_idx, CAST(page_index AS INTEGER) AS page_index, lang AS portal, count(*) AS items
FROM o GROUP BY ALL
""")
def page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collected(spark, sf_dir).per_page.select("portal_idx", "page_index", "portal", "items")


@query(f"""
WITH {_SQL_COLLECT}, stop AS (
  SELECT portal_idx, min(page_index) AS page FROM o WHERE un = 1 AND error_kind IS NOT NULL GROUP BY 1)
SELECT CAST(o.portal_idx AS INTEGER) AS portal_idx, CAST(page_index AS INTEGER) AS page_index, position, url, outcome
FROM o LEFT JOIN stop s ON s.portal_idx = o.portal_idx WHERE s.page IS NULL OR page_index < s.page
""")
def collect_abort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same job where a portal stops at its first failing page."""
    result = collected(spark, sf_dir, on_error="abort")
    return result.outcomes.select("portal_idx", "page_index", "position", "url", "outcome")


@query(f"""
WITH {_SQL_COLLECT}
SELECT url, 'noop:' || url AS fingerprint, 'inserted' AS status,
  substr(sha256(concat_ws('␟', '2024-06-01 12:00:00', CAST((portal_idx * 2147483648::HUGEINT
    + page_index) * 9223372036854775808::HUGEINT + position AS VARCHAR), url)), 1, 24) AS article_id,
  '2024-06-01 12:00:00' AS processed_at
FROM o WHERE un = 1 AND error_kind IS NULL
""")
def collect_write_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write log with the fingerprint stage off."""
    log = collected(spark, sf_dir, skip_dedup=True).items
    return log.select("url", "fingerprint", "status", "article_id", _text_time(F.col("processed_at")).alias("processed_at"))


# upsert ------------------------------------------------------------------------------------------------
def _upsert_inputs(spark: SparkSession, sf_dir: str, url: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Every document is written once; sources are portals, so copies meet across portals.
    The texts of one language are stored already."""
    docs = table(spark, sf_dir, "documents")
    text = F.col("text")
    if url is None:
        url = F.concat(F.lit("https://news.example/a/"), F.sha2(text, 256))
    fields = [
        url.alias("url"), F.col("source").alias("portal_name"), title_of(text).alias("title"),
        F.lit(None).cast("string").alias("summary"), text.alias("content_html"), text.alias("content_text"),
        F.array("lang").alias("tags"), F.lit(None).cast("string").alias("published_at_raw"),
        F.lit(None).cast("timestamp").alias("published_at"), F.lit(RUN_TS).cast("timestamp").alias("collected_at"),
        F.sha2(text, 256).alias("fingerprint"), F.create_map(F.lit("lang"), F.col("lang")).alias("raw_meta"),
    ]
    order = [
        F.regexp_extract("source", r"(\d+)$", 1).cast("int").alias("portal_idx"),
        F.lit(1).alias("page_index"), F.col("doc_id").alias("position"),
    ]
    old = docs.filter("lang = 'fr'").select(*order, *fields)
    firsts = plan_by_url(old, None, "old")
    return docs.select(*order, *fields), upserted(None, firsts)


_SQL_UPSERT = r"""w AS (
  SELECT doc_id, lang, source, text, 'https://news.example/a/' || sha256(text) AS url,
    CAST(regexp_extract(source, '(\d+)$', 1) AS INTEGER) AS portal_idx FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY url ORDER BY portal_idx, doc_id) AS fwd,
    row_number() OVER (PARTITION BY url ORDER BY portal_idx DESC, doc_id DESC) AS bwd,
    CAST((portal_idx * 2147483648::HUGEINT + 1) * 9223372036854775808::HUGEINT + doc_id AS VARCHAR) AS ord FROM w),
stored AS (SELECT url, substr(sha256(concat_ws('␟', 'old', ord, url)), 1, 24) AS stored_id FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY portal_idx, doc_id) AS k FROM n WHERE lang = 'fr') WHERE k = 1),
r AS (SELECT n.*, stored_id, coalesce(stored_id, substr(sha256(concat_ws('␟', 'new',
    first_value(ord) OVER (PARTITION BY n.url ORDER BY fwd), n.url)), 1, 24)) AS doc_key
  FROM n LEFT JOIN stored USING (url))"""


@query(f"""
WITH {_SQL_UPSERT}
SELECT doc_key AS article_id, url, source AS portal_name, text AS content_text, lang, sha256(text) AS fingerprint FROM r WHERE bwd = 1
""")
def upsert_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming, stored = _upsert_inputs(spark, sf_dir)
    after = upserted(stored, plan_by_url(incoming, stored, "new"))
    return after.select(
        "article_id", "url", "portal_name", "content_text", F.try_element_at("raw_meta", F.lit("lang")).alias("lang"),
        "fingerprint",
    )


@query(f"""
WITH {_SQL_UPSERT}
SELECT doc_id AS position, url, CASE WHEN fwd = 1 AND stored_id IS NULL THEN 'inserted' ELSE 'updated' END AS status,
  CASE WHEN fwd = 1 AND stored_id IS NULL THEN doc_key END AS article_id FROM r
""")
def upsert_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming, stored = _upsert_inputs(spark, sf_dir)
    log = write_log(plan_by_url(incoming, stored, "new"), F.lit(RUN_TS).cast("timestamp"))
    return log.select("position", "url", "status", "article_id")


@query(rf"""
WITH RECURSIVE {_SQL_UPSERT},
known AS (SELECT list({{'k': url, 'd': stored_id}}) AS urls, list({{'k': replace(url, 'https://news.example/a/', ''), 'd': stored_id}}) AS fps FROM stored),
incoming AS (
  SELECT doc_id, ord, sha256(text) AS fp, row_number() OVER (ORDER BY portal_idx, doc_id) AS n, 'https://n.example/' || sha256(CAST(
    ('0x' || substr(sha256(source || ' ' || text), 1, 15))::BIGINT % (SELECT count(*) FROM documents) AS VARCHAR)) AS url FROM n),
state AS (
  SELECT 0::BIGINT AS n, coalesce(urls, []) AS urls, coalesce(fps, []) AS fps, NULL::VARCHAR AS status, NULL::VARCHAR AS doc FROM known
  UNION ALL
  SELECT n, CASE WHEN status = 'write' THEN urls ELSE list_append(list_filter(urls, lambda x: x.d <> doc), {{'k': url, 'd': doc}}) END,
    CASE WHEN status = 'write' THEN fps ELSE list_append(list_filter(fps, lambda x: x.d <> doc), {{'k': fp, 'd': doc}}) END, status, doc
  FROM (
    SELECT n, urls, fps, url, fp, CASE WHEN a <> b THEN 'write' WHEN a IS NULL AND b IS NULL THEN 'inserted' ELSE 'updated' END AS status,
      CASE WHEN a <> b THEN NULL ELSE coalesce(a, b, substr(sha256(concat_ws('␟', 'new', ord, url)), 1, 24)) END AS doc
    FROM (SELECT i.n, s.urls, s.fps, i.url, i.fp, i.ord, list_filter(s.urls, lambda x: x.k = i.url)[1].d AS a, list_filter(s.fps, lambda x: x.k = i.fp)[1].d AS b
      FROM state s JOIN incoming i ON i.n = s.n + 1)))
SELECT doc_id AS position, i.url, fp AS fingerprint, status, CASE WHEN status = 'inserted' THEN doc END AS article_id,
  doc IS NOT NULL AND i.n = max(i.n) OVER (PARTITION BY doc) AS is_last
FROM state s JOIN incoming i USING (n)
""")
def upsert_unique_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert where a new url with a stored fingerprint updates that document. A url holds the texts
    of one of as many hash buckets as there are rows, by source and text, and a fingerprint the
    copies of one text, so both keys cross and no number of texts fills the urls."""
    rows = table(spark, sf_dir, "documents").count()
    place = F.conv(F.substring(slug_of(F.col("source"), F.col("text")), 1, 15), 16, 10).cast("long")
    bucket = F.pmod(place, F.lit(max(rows, 1))).cast("string")
    _, stored = _upsert_inputs(spark, sf_dir)
    incoming, _ = _upsert_inputs(spark, sf_dir, F.concat(F.lit("https://n.example/"), F.sha2(bucket, 256)))
    writes = plan_with_unique_fingerprint(incoming, stored, "new")
    return writes.select("position", "url", "fingerprint", "status", "article_id", "is_last")


@query(f"""
WITH {_SQL_COLLECT}
SELECT url, title, {_sql_collapse('text')} AS content_text, sha256('␟' || title) AS fingerprint FROM o WHERE outcome = 'persisted'
""")
def incremental_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming job, read back from the article store: the first half of the listings, whose
    items have to wait, then all articles, then the other listings, whose articles came before."""
    plan, raw_pages = document_web(spark, sf_dir)
    root = f"{staging_root(spark)}/incremental-{uuid.uuid4().hex}"
    last = plan.agg(F.max("page_index")).first()[0] or 0
    is_list = F.col("request_url").contains("/list/")
    page = F.substring_index("request_url", "/", -1).try_cast("int")
    first_half = is_list & (page * 2 <= last)
    for step in (first_half, ~is_list, is_list & ~first_half):
        with shuffles_removed(spark):
            raw_pages.where(F.coalesce(step, F.lit(False))).write.mode("append").parquet(f"{root}/landed", compression="zstd")
        stream = landed_stream(spark, f"{root}/landed")
        earlier = spark.read.schema(stream.schema).parquet(f"{root}/landed")
        options = Options(run_ts=RUN_TS)
        incremental_collect(stream, plan, f"{root}/store", options, f"{root}/state", remember=True, earlier=earlier).awaitTermination()
    return current_articles(spark, f"{root}/store/articles", ["url", "title", "content_text", "fingerprint"])


__all__ = ["QUERIES", "SQL", "collected"]
