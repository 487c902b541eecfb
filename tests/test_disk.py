"""What lies on disk during a run: texts once, shuffles of one query, copies that are still read."""

import os
import time
from pathlib import Path

from pyspark.sql import functions as F

from newsloom import schemas as S
from newsloom.operators.upsert import changed_rows, plan_by_url
from newsloom.plans import scrape as module
from newsloom.plans.collect import collect
from newsloom.session import Staging, picked, shuffles_removed, staging_root
from newsloom.sources.landed import latest_pages
from newsloom.sources.store import compact, current_articles, read_versions, write_articles, write_version
from test_scrape_collect import OPTIONS, PAGES, config, landed, plan_of


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def article(i, summary, text, meta):
    return (f"id{i}", f"u{i}", "p", "t", summary, f"<p>{text}</p>", text, ["a"], None, None, None, f"f{i}", meta)


def test_an_article_stores_its_texts_side_by_side(spark):
    root = f"{staging_root(spark)}/packed"
    noise = lambda i: os.urandom(3000 + i).hex()
    texts = [noise(i) for i in range(300)]
    rows = [article(i, t, t, {"summary_html": f"<i>{t}</i>", "page": None}) for i, t in enumerate(texts)]
    rows += [article(300, None, None, None), article(301, "", None, {})]
    frame = spark.createDataFrame(rows, S.ARTICLES).coalesce(1)
    write_version(frame, f"{root}/plain", 0)  # a column each, as before
    write_articles(frame, f"{root}/packed", 0)
    size = lambda name: sum(f.stat().st_size for f in Path(f"{root}/{name}".removeprefix("file:")).rglob("*.parquet"))
    assert size("packed") < 0.45 * size("plain")
    full = lambda name, **kw: sorted(current_articles(spark, f"{root}/{name}", **kw).collect(), key=repr)
    assert full("packed") == full("plain") == sorted(frame.collect(), key=repr)

    write_articles(frame.where("article_id = 'id5'").withColumn("summary", F.lit("new")), f"{root}/plain", 1)
    mixed = {r.article_id: r.summary for r in full("plain", columns=["article_id", "summary"])}
    assert mixed == {r[0]: "new" if r[0] == "id5" else r[4] for r in rows}
    compact(spark, f"{root}/plain", f"{root}/compact")
    assert full("compact") == full("plain") and read_versions(spark, f"{root}/compact", S.ARTICLES).count() == 302


def test_pages_landed_once_do_not_move(spark, tmp_path):
    pages = landed(spark, PAGES + [(None, 200, "nowhere")])
    pages.write.parquet(f"{tmp_path}/once")
    kept = latest_pages(spark.read.parquet(f"{tmp_path}/once"))
    assert "Exchange" not in plan_text(kept) and {r.request_url for r in kept.collect()} == {url for url, *_ in PAGES}
    again = pages.where("request_url LIKE '%/33'").withColumn("html", F.lit("zz")).withColumn("fetched_at", F.lit("2025-01-01").cast("timestamp"))
    pages.unionByName(again).unionByName(again).write.parquet(f"{tmp_path}/again")
    found = {r.request_url: r.html for r in latest_pages(spark.read.parquet(f"{tmp_path}/again")).collect()}
    assert found == {url: "zz" if url.endswith("/33") else html for url, _, html in PAGES}


def test_the_smaller_side_picks(spark):
    rows = spark.createDataFrame([(i if i < 9 else None, "x" * i) for i in range(10)], "k int, wide string")
    keys = lambda odd: rows.where(f"k % 2 = {odd}").select("k")
    for bound in (0, 4, 5):
        assert sorted(r.k for r in picked(rows, ["k"], keys(1), keys(0), bound).collect()) == [1, 3, 5, 7]


def test_shuffle_files_go_with_their_query(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {p for p in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in p}
    before, key = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    with shuffles_removed(spark):
        for _ in range(3):
            spark.range(1000).repartition(3, "id").write.format("noop").mode("overwrite").save()
    assert spark.conf.get(key) == "false"
    end = time.time() + 30
    while files() - before and time.time() < end:
        time.sleep(0.2)
    assert not files() - before


def test_slices_give_the_same_run(spark, tmp_path, monkeypatch):
    plan, pages = plan_of(spark, tmp_path, config()), landed(spark, PAGES)

    def run():
        with Staging(spark) as staged:
            result = collect(plan, pages, OPTIONS, staged=staged)
            return [sorted(map(repr, frame.collect())) for frame in (result.outcomes, result.items, result.changes)]

    once = run()
    sizes = []
    monkeypatch.setattr(module, "SLICE_ITEMS", 1)
    sliced = module.sliced_articles
    monkeypatch.setattr(module, "sliced_articles", lambda *a: sizes.append(sliced(*a)) or sizes[-1])
    assert run() == once and len(sizes[0]) > 1 and len(once[2]) > 0


def test_changed_rows_stay_where_they_are(spark, tmp_path):
    """New articles get their id from their own row; stored ones and the last of several writes from the plan."""
    items = [(p, 1, i, f"u{i % 40}" if p else f"u{i}", f"f{i}", "s", "<p>", "wide", {}) for p in (0, 1) for i in range(1, 61)]
    names = "portal_idx int, page_index int, position long, url string, fingerprint string, summary string, content_html string, content_text string, raw_meta map<string,string>"
    rows = spark.createDataFrame(items, names)
    empty = {f.name: F.lit(None).cast(f.dataType) for f in S.ARTICLES.fields if f.name not in rows.columns}
    rows.withColumns(empty).drop("article_id").write.parquet(f"{tmp_path}/rows")
    contents = spark.read.parquet(f"{tmp_path}/rows").where("portal_idx = 0 OR position > 5")
    stored = spark.createDataFrame([("old", "u3", "x")], "article_id string, url string, fingerprint string")
    writes = plan_by_url(contents.where("position % 7 > 0").select("portal_idx", "page_index", "position", "url", "fingerprint"), stored, "run")
    ids = lambda df: sorted((r.article_id, r.url, r.fingerprint) for r in df.collect())
    found = changed_rows(writes, contents, "run")
    assert ids(found) == ids(changed_rows(writes, contents)) and any(i == "old" for i, *_ in ids(found))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = [line for line in plan_text(changed_rows(writes, contents, "run")).splitlines() if "Exchange hashpartitioning" in line]
        assert "content_text" in plan_text(found) and not any("content_text" in line for line in moved)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_listings_of_ready_items_move_once(spark, tmp_path, monkeypatch):
    """A listing page meets its items by one shuffle, and only one that landed twice by another; slices change nothing."""
    from newsloom.streaming.bounded import listed_links, read_items

    plan = plan_of(spark, tmp_path, config())
    when = F.lit("2024-01-01 00:00:00").cast("timestamp")
    pages = landed(spark, PAGES).withColumn("fetched_at", when)
    pages.write.parquet(f"{tmp_path}/once")
    pages.unionByName(pages).write.parquet(f"{tmp_path}/twice")
    once, twice = (spark.read.schema(S.RAW_PAGES).parquet(f"{tmp_path}/{name}") for name in ("once", "twice"))
    links = spark.createDataFrame(listed_links(once, plan).collect(), listed_links(once, plan).schema)
    found = read_items(links, once, plan)
    assert "first(html" not in plan_text(found)
    rows = lambda frame: sorted(map(repr, frame.collect()))
    assert rows(found) == rows(read_items(links, twice, plan)) and found.count() == links.count() > 0
    count = {}
    for size in (100_000, 1):
        monkeypatch.setattr(module, "SLICE_ITEMS", size)
        parts = module.sliced_articles(found, once, links.count())
        count[size] = len(parts), sorted(repr(r) for part in parts for r in part.collect())
    assert count[1][0] > count[100_000][0] == 1 and count[1][1] == count[100_000][1] != []
