"""Two-hop example, item-level collect and the page boundary."""

import json

import pytest
from pyspark.sql import functions as F

from newsloom import schemas as S
from newsloom.plans.collect import Options, collect, collect_items
from newsloom.plans.scrape import scraped_items
from newsloom.sources.portals import load_page_plan

# Warnings of a coast guard: table rows with an icon as link, two of many numbered pages.
SITE = "https://tempo.example"
ROWS_4 = """<table id="avisos"><tbody>
<tr class="row"><td class="head">Maré alta</td><td class="about"><em>Porto</em> fechado</td>
<td class="when" title="05/06/2023 07:40">segunda</td><td class="topics">Mar, Porto,</td>
<td class="go"><a href="/boletim/31"><img src="i.png"></a></td></tr>
<tr class="row"><td class="head">Sem destino</td></tr>
<tr class="row"><td class="head">Vento</td><td class="go"><a href="../arquivo/32?x=1"><img src="i.png"></a></td></tr>
</tbody></table>"""
ROWS_7 = """<table><tr class="row"><td class="go"><a href="/boletim/33"><img src="i.png"></a></td></tr>
<tr class="row"><td class="head">De novo</td><td class="go"><a href="/boletim/31">abrir</a></td></tr></table>"""
REPORT = """<main data-ed="{ed}"><h2>Boletim {ed}</h2><div id="texto"><p>Onda {ed}</p><style>p</style>
<p>fim</p></div></main>"""
UNTITLED = '<main><div id="texto"><p>Rajadas</p></div></main>'


def numbered(*pages):
    return {"pages": list(pages), "param": "p"}


def config(name="Costa", pages=None, **scraper):
    listing = {
        "item_selector": "tr.row",
        "link_selector": "td.go a",
        "title_selector": ".head",
        "summary_selector": "td.about",
        "metadata_selectors": {"tags": "td.topics", "published_at": {"selector": ".when", "attr": "title"}},
    }
    article = {
        "body_selector": "main div#texto",
        "title_selector": "main h2",
        "metadata_selectors": {"edition": {"selector": "main", "attr": "data-ed"}},
    }
    parts = {name: {"factory": "x:y"} for name in ("url_normalizer", "date_normalizer", "text_cleaner", "writer")}
    parts["scraper"] = {
        "factory": "x:y",
        "options": {"listing": listing, "article": article, "pagination": numbered(4, 7), **scraper},
    }
    parts["deduper"] = {"factory": "x:y", "options": {"fields": "title,content_text"}}
    return {
        "name": name,
        "metadata": {"coast": "norte"},
        "pages": pages or [{"url": f"{SITE}/costa/avisos", "metadata": {"kind": "aviso"}}],
        "components": parts,
    }


def plan_of(spark, tmp_path, *configs, **kwargs):
    paths = []
    for i, body in enumerate(configs):
        path = tmp_path / f"portal{i}.json"
        path.write_text(json.dumps(body), "utf-8")
        paths.append(str(path))
    return load_page_plan(spark, paths, **kwargs)


def landed(spark, rows):
    data = [(url, url, status, html, None) for url, status, html in rows]
    return spark.createDataFrame(data, S.RAW_PAGES)


FIRST, SECOND, THIRD = f"{SITE}/boletim/31", f"{SITE}/arquivo/32?x=1", f"{SITE}/boletim/33"
PAGES = [
    (f"{SITE}/costa/avisos?p=4", 200, ROWS_4),
    (f"{SITE}/costa/avisos?p=7", 200, ROWS_7),
    (FIRST, 200, REPORT.format(ed=31)),
    (SECOND, 200, UNTITLED),
    (THIRD, 200, REPORT.format(ed=33)),
]
OPTIONS = Options(run_ts="2023-06-06 18:30:00")


def test_titles_tags_and_metadata_of_items(spark, tmp_path):
    rows = scraped_items(plan_of(spark, tmp_path, config()), landed(spark, PAGES)).orderBy("position").collect()
    assert [(r.position, r.url) for r in rows] == [(1, FIRST), (2, SECOND), (3, THIRD), (4, FIRST)]
    # The icon has no text: the title selector counts; without a listing title the article's own.
    assert [r.title for r in rows] == ["Maré alta", "Vento", "Boletim 33", "abrir"]
    assert rows[0].summary_html == '<td class="about"><em>Porto</em> fechado</td>' and rows[1].summary_html is None
    assert [t.lower() for t in rows[0].tags] == ["mar", "porto"] and rows[2].tags == []
    assert [r.published_at for r in rows] == ["05/06/2023 07:40", None, None, None]
    assert [r.metadata["page"] for r in rows] == ["4", "4", "7", "7"]
    assert [r.metadata.get("edition") for r in rows] == ["31", None, "33", "31"]
    common = {"coast": "norte", "kind": "aviso", "portal_name": "Costa"}
    assert all(common.items() <= r.metadata.items() for r in rows)
    assert rows[2].metadata["page_url"] == f"{SITE}/costa/avisos?p=7"


def test_stored_documents_and_report(spark, tmp_path):
    result = collect(plan_of(spark, tmp_path, config()), landed(spark, PAGES), OPTIONS)
    fates = {(r.position, r.outcome) for r in result.outcomes.collect()}
    assert fates == {(1, "persisted"), (2, "persisted"), (3, "persisted"), (4, "url")}
    docs = {r.url: r for r in result.changes.collect()}
    assert {u: d.content_text for u, d in docs.items()} == {FIRST: "Onda 31 fim", SECOND: "Rajadas", THIRD: "Onda 33 fim"}
    assert "style" not in docs[FIRST].content_html and docs[FIRST].summary == "Porto fechado"
    assert str(docs[FIRST].published_at) == "2023-06-05 07:40:00" and docs[THIRD].published_at is None
    metrics = {"processed": 3, "skipped": {"url": 1}, "pages": {"total": 1, "fetched": 1}}
    assert [json.loads(r)["result"]["metrics"] for r in result.report.toJSON().collect()] == [metrics]


def test_a_run_over_stored_documents(spark, tmp_path):
    plan, pages = plan_of(spark, tmp_path, config()), landed(spark, PAGES)
    first = collect(plan, pages, OPTIONS)
    again = collect(plan, pages, OPTIONS, stored=first.changes)
    assert {r.status for r in again.items.collect()} == {"updated"}
    ids = lambda r: {(x.url, x.article_id) for x in r.changes.collect()}
    assert ids(first) == ids(again)


@pytest.mark.parametrize("status,html,kind", [(503, "", "fetch"), (200, "<main></main>", "parse")])
def test_lost_article_and_portal_that_stops(spark, tmp_path, status, html, kind):
    pages = [page for page in PAGES if page[0] != SECOND] + [(SECOND, status, html)]
    place = f"{SITE}/costa/avisos"
    both = config(pages=[{"url": place, "pagination": numbered(n)} for n in (4, 7)])
    calm = config("Calma", pages=[{"url": place, "pagination": numbered(7)}])
    plan = plan_of(spark, tmp_path, both, calm)
    skipped = collect(plan, landed(spark, pages), OPTIONS).metrics.orderBy("portal_idx").collect()
    assert [(m.processed, m.skipped) for m in skipped] == [(2, {kind: 1, "url": 1}), (2, {})]
    stopped = collect(plan, landed(spark, pages), Options(run_ts="2023-06-06", on_error="abort"))
    states = stopped.pages.orderBy("portal_idx", "page_index").collect()
    assert [s.page_state for s in states] == ["error", "not_run", "fetched"]
    assert {r.portal for r in stopped.outcomes.collect()} == {"Calma"} == {r.portal for r in stopped.report.collect()}


def test_listing_that_never_landed(spark, tmp_path):
    plan, pages = plan_of(spark, tmp_path, config()), landed(spark, PAGES[:1] + PAGES[2:])
    m = collect(plan, pages, OPTIONS).metrics.first()
    assert (m.processed, m.skipped, m.pages_total, m.pages_fetched, m.failed) == (2, {}, 1, 0, False)
    stopped = collect(plan, pages, Options(run_ts="2023-06-06", on_error="abort"))
    assert stopped.outcomes.isEmpty() and stopped.metrics.first().failed


def _items(spark, rows):
    full = [
        (0, "p", page, pos, url, title, html, summary, tags, date, {})
        for page, pos, url, title, html, summary, tags, date in rows
    ]
    return spark.createDataFrame(full, S.SCRAPED_ITEMS)


def _pages(spark, n):
    return spark.createDataFrame(
        [(0, "p", i, f"https://radar.example/mapa/{i}/", {"zone": "sul"}) for i in range(1, n + 1)],
        "portal_idx int, portal string, page_index int, page_url string, page_meta map<string,string>",
    )


def test_repetitions_over_three_pages(spark):
    rows = [
        (1, 1, "/chuva", "Chuva", "<p>choveu</p>", "<p>chuva forte</p>", ["tempo"], None),
        (1, 2, "/sol", "Chuva", "<p>parou</p>", None, [], None),
        (1, 3, "/chuva", "Outra", "<p>de novo</p>", None, [], None),
        (2, 1, "https://radar.example/chuva", "Outra", "<p>de novo</p>", None, [], None),
        (2, 2, "vento", "Vento", "<p>soprou</p>", None, [], None),
    ]
    result = collect_items(_items(spark, rows), _pages(spark, 3), Options(run_ts="2023-06-06", fields="title"))
    fates = [r.outcome for r in result.outcomes.orderBy("page_index", "position").collect()]
    assert fates == ["persisted", "fingerprint", "url", "url", "persisted"]
    docs = {r.url: r.summary for r in result.changes.collect()}
    assert docs == {"https://radar.example/chuva": "chuva forte", "https://radar.example/mapa/2/vento": "soprou"}
    m = result.metrics.first()
    assert (m.processed, m.skipped, m.pages_total, m.pages_fetched) == (2, {"fingerprint": 1, "url": 2}, 3, 3)


def test_invalid_item_hides_later_ones(spark):
    rows = [
        (1, 1, "/a", "A", "", None, [], None),
        (1, 2, "/a", "A", "<p>ok</p>", None, [], None),
        (1, 3, " ", "B", "<p>ok</p>", None, [], None),
        (1, 4, "", "C", "<p>ok</p>", None, [], None),
        (1, 5, "/d", None, "<p>texto , aqui</p>", "", [], " HOJE "),
    ]
    options = Options(run_ts="2024-01-01 12:00:00", reference="2023-03-15 20:15:00", fields="title")
    result = collect_items(_items(spark, rows), _pages(spark, 1), options)
    assert [r.outcome for r in result.outcomes.orderBy("position").collect()] == [
        "invalid", "url", "invalid", "invalid", "persisted"]
    doc = result.changes.first()
    assert (doc.title, doc.summary, doc.content_text) == ("Sem título", None, "texto, aqui")
    assert str(doc.published_at) == "2023-03-15 00:00:00"


def test_skip_dedup_and_since(spark):
    rows = [
        (1, 1, "/a", "T", "<p>1</p>", None, [], "2024-01-01"),
        (1, 2, "/b", "T", "<p>2</p>", None, [], "01/03/2024"),
        (1, 3, "/c", "T", "<p>3</p>", None, [], None),
        (1, 4, "/c", "T", "<p>3</p>", None, [], None),
    ]
    options = Options(run_ts="2024-01-01 12:00:00", fields="title", skip_dedup=True, since="2024-02-01")
    result = collect_items(_items(spark, rows), _pages(spark, 1), options)
    assert [r.outcome for r in result.outcomes.orderBy("position").collect()] == ["since", "persisted", "persisted", "url"]
    assert {r.fingerprint for r in result.items.collect()} == {"noop:https://radar.example/b", "noop:https://radar.example/c"}


def test_page_override_keeps_portal_name(spark, tmp_path):
    plan = plan_of(spark, tmp_path, config(), config("Dois"), pages_override=[{"url": "https://x/1", "metadata": None}])
    rows = plan.orderBy("portal_idx").select("portal", "page_url", F.col("page_meta")["portal_name"].alias("n")).collect()
    assert [tuple(r) for r in rows] == [("Costa", "https://x/1", "Costa"), ("Dois", "https://x/1", "Dois")]


def test_own_parser_cleaner_normalizer_and_writer(spark, tmp_path):
    """Every hook of a run is used, on the columns it is promised."""
    from newsloom.operators.extract import article_parts, clean
    from newsloom.plans.collect import Components
    from newsloom.plans.run import run_collect

    def parse(html, options, keep_body, given):
        part = article_parts(html, options, keep_body, given)
        return part.withField("title_text", F.concat(F.lit("own "), F.col("metadata")["edition"].isNull().cast("string")))

    def cleaner(html):
        found = clean(html)
        return F.struct(found["safe_html"].alias("safe_html"), F.upper(found["text"]).alias("text"))

    stored = {}

    def write(result, root, version):
        stored[version] = {r.url: (r.title, r.content_text, r.portal_name) for r in result.changes.collect()}

    parts = Components(parse_article=parse, clean=cleaner, normalize=lambda df: df.withColumn("portal_name", F.lit("Outro")), write=write)
    root = str(tmp_path / "store")
    report = run_collect(spark, plan_of(spark, tmp_path, config()), landed(spark, PAGES), root, 3, Options(run_ts="2023-06-06", components=parts))
    assert report.count() == 1 and set(stored) == {3}
    assert stored[3][FIRST][1:] == ("ONDA 31 FIM", "Outro") and stored[3][THIRD] == ("own true", "ONDA 33 FIM", "Outro")
    assert not (tmp_path / "store" / "articles").exists() and (tmp_path / "store" / "write_log").exists()
