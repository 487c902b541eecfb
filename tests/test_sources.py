"""Portal configs, pagination, landed pages and JSON listings."""

import json
import random

import pytest
from pyspark.sql import functions as F

from newsloom import schemas as S
from newsloom.operators.boundary import running_offset
from newsloom.operators.paginate import expand_requests
from newsloom.plans.json_ingest import ingest_json_listing, parse_fields
from newsloom.sources.json_listing import listing_items, read_listings
from newsloom.sources.landed import join_pages, land_pages, latest_pages
from newsloom.sources.portals import config_files, config_violations, load_page_plan, read_configs
from test_scrape_collect import config

PLAN = "i int, page_url string, pagination " + S.PAGINATION.simpleString()


def _page_model(p):
    if not p:
        return [None]
    start, step = (1 if p.get("start") is None else p["start"]), p.get("step") or 1
    if p.get("pages") is not None:
        pages = list(p["pages"])
    elif p.get("stop") is not None:
        pages = list(range(start, p["stop"] + (1 if step > 0 else -1), step))
    else:
        pages = [start + step * i for i in range(max(1 if p.get("count") is None else p["count"], 1))]
    return pages if p.get("limit") is None else pages[: p["limit"]]


def test_pagination_equals_model(spark):
    rng = random.Random(7)
    maybe = lambda *values: rng.choice([None, *values])
    settings = [None]
    for _ in range(300):
        settings.append(
            {
                "param": maybe("p"), "start": maybe(0, 1, 5, -2), "stop": maybe(-3, 0, 1, 4, 9), "step": maybe(0, 1, 2, -1, -3),
                "count": maybe(-1, 0, 1, 3), "limit": maybe(0, 1, 2, 50, -1), "pages": maybe([], [3, 1, 3]), "params": None,
            }
        )
    df = spark.createDataFrame([(i, "https://h/l", p) for i, p in enumerate(settings)], PLAN)
    got = {}
    for r in expand_requests(df).orderBy("i", "request_pos").collect():
        got.setdefault(r.i, []).append(r.page_no)
    assert {i: got.get(i, []) for i in range(len(settings))} == {i: _page_model(p) for i, p in enumerate(settings)}


def test_page_parameter_keeps_its_place(spark):
    params = F.create_map(*[F.lit(x) for x in ("a", "1", "page", "x", "b", "2")])
    row = {f.name: F.lit(None).cast(f.dataType) for f in S.PAGINATION.fields} | {"params": params, "count": F.lit(1)}
    pagination = F.struct(*[column.alias(name) for name, column in row.items()])
    df = spark.range(1).select(F.lit("https://h/l").alias("page_url"), pagination.alias("pagination"))
    assert expand_requests(df).first().request_url == "https://h/l?a=1&page=1&b=2"


def write_configs(tmp_path, **files):
    for name, body in files.items():
        path = tmp_path / name.replace("__", "/")
        path.parent.mkdir(parents=True, exist_ok=True)
        path.with_suffix(".json").write_text(body if isinstance(body, str) else json.dumps(body), "utf-8")


def test_config_scan_order_and_once(spark, tmp_path):
    write_configs(tmp_path, b=config("B"), sub__a=config("A"), sub__deep__c=config("C"))
    (tmp_path / "notes.txt").write_text("not a config")
    explicit = str(tmp_path / "sub" / "deep" / "c.json")
    plan = load_page_plan(spark, [explicit, explicit], str(tmp_path))
    assert [r.portal for r in plan.orderBy("portal_idx").collect()] == ["C", "B", "A"]
    with pytest.raises(ValueError):
        config_files(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        config_files(spark, [str(tmp_path / "none.json")])


def test_config_rules(spark, tmp_path):
    bad = {
        "list": "[]",
        "text": "{not json",
        "blank": {**config(), "name": "  "},
        "pages": {**config(), "pages": {"url": "x"}},
        "page": {**config(), "pages": ["x"]},
        "pagemeta": {**config(), "pages": [{"url": "x", "metadata": "y"}]},
        "meta": {**config(), "metadata": [1]},
        "component": {**config(), "components": {k: v for k, v in config()["components"].items() if k != "writer"}},
        "factory": {**config(), "components": {**config()["components"], "writer": {"factory": " "}}},
        "options": {**config(), "components": {**config()["components"], "writer": {"factory": "a:b", "options": 3}}},
        "none": {**config(), "components": None},
    }
    write_configs(tmp_path, ok=config(), **bad)
    rows = config_violations(read_configs(spark, directory=str(tmp_path))).collect()
    found = {}
    for r in rows:
        found.setdefault(r.file.rsplit("/", 1)[1].removesuffix(".json"), set()).add(r.rule)
    assert "ok" not in found and set(found) == set(bad)
    expected = {
        "list": "config must be an object", "text": "config must be an object", "blank": "name is required",
        "pages": "pages must be a list", "page": "every page must be an object", "pagemeta": "page metadata must be an object",
        "meta": "metadata must be an object", "component": "component writer is required",
        "factory": "component writer needs a factory", "options": "component writer options must be an object",
        "none": "components is required",
    }
    for name, rule in expected.items():
        assert rule in found[name], name
    assert found["meta"] == {"metadata must be an object"} and found["component"] == {"component writer is required"}
    with pytest.raises(ValueError, match="invalid portal configuration"):
        load_page_plan(spark, directory=str(tmp_path))


def test_plan_metadata_tags_and_options(spark, tmp_path):
    body = config(pages=[
        {"url": "https://x/1", "metadata": {"portal_name": "Own", "tags": [" a ", "b,c"]}, "pagination": {"start": 2, "stop": 4, "params": {"z": "1", "a": "2"}}},
        {"url": "https://x/2", "metadata": None, "pagination": {}},
    ], pagination={})
    body["metadata"]["tags"] = "x, y"
    body["components"]["url_normalizer"]["options"] = {"default_base_url": "https://base/x"}
    body["components"]["text_cleaner"]["options"] = {"allowed_tags": ["p"]}
    body["components"]["deduper"]["options"] = {"fields": ["title"], "prefix": "v1"}
    write_configs(tmp_path, one=body)
    plan = load_page_plan(spark, directory=str(tmp_path)).orderBy("page_index")
    first, second = plan.withColumn("names", F.map_keys("pagination.params")).collect()
    assert first.page_meta["portal_name"] == "Own" and first.page_meta["coast"] == "norte"
    assert first.page_tags == ["a", "b,c"] and second.page_tags == ["x", "y"]
    assert first.names == ["z", "a"] and second.pagination is None
    assert json.loads(first.article_options)["allowed_tags"] == ["p"]
    assert (first.default_base, first.fp_fields, first.fp_prefix) == ("https://base/x", ["title"], "v1")


def test_bucketed_pages_are_not_shuffled(spark):
    pages = spark.createDataFrame([(f"u{i}", f"u{i}", 200, "<p>", None) for i in range(50)], S.RAW_PAGES)
    table = land_pages(pages, "landed_bucketed", 4)
    requests = spark.range(60).select(F.concat(F.lit("u"), "id").alias("request_url"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_pages(requests, table)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1  # the requests only
        assert joined.filter("error_kind = 'fetch'").count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE landed_bucketed")


def test_latest_pages(spark):
    rows = [("u", "u", 200, "old", "2024-01-01"), ("u", "u", 200, "new", "2024-01-02"), ("v", "v", 200, "x", "2024-01-01")]
    df = spark.createDataFrame(rows * 3, "request_url string, final_url string, status_code int, html string, t string")
    df = df.withColumn("fetched_at", F.col("t").cast("timestamp")).drop("t")
    assert sorted(r.html for r in latest_pages(df).collect()) == ["new", "x"]


def test_running_offset_in_blocks(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").cast("int").alias("pos"), (F.col("id") % 7).alias("n"))
    total, expected = 0, {}
    for i in range(1000):
        expected[i] = total
        total += i % 7
    assert {r.pos: r.offset for r in running_offset(df, ["k"], "pos", "n", block=64).collect()} == expected


def _payloads(spark, *texts, status=200):
    return spark.createDataFrame([(f"r{i}", status, t) for i, t in enumerate(texts)], S.JSON_PAYLOADS)


def test_json_listing_shapes(spark):
    good = json.dumps({"items": [{"url": "u1", "content": "c", "n": 1, "o": {"a": [1]}, "z": None}, 7, "x", None, [1], {"url": 5}]})
    texts = [good, '[{"url":"u2"}]', '{"items":{}}', '{"other":[]}', "not json", '{"items":[{"content":"c"}]}', "[]", "3"]
    listed = {r.request_url: r.error_kind for r in read_listings(_payloads(spark, *texts)).collect()}
    assert [listed[f"r{i}"] for i in range(8)] == [None, None, "fetch", "fetch", "fetch", "fetch", None, "fetch"]
    rows = listing_items(_payloads(spark, *texts)).orderBy("request_url", "item_pos").collect()
    assert [(r.url, r.content) for r in rows] == [("u1", "c"), ("5", ""), ("u2", "")]
    assert rows[0].metadata == {"n": "1", "o": '{"a":[1]}', "z": None}
    assert read_listings(_payloads(spark, good, status=500)).first().error_kind == "fetch"
    assert listing_items(_payloads(spark, '{"data list":[{"url":"u"}]}'), "data list").count() == 1


def test_selector_fields_and_null_override(spark):
    html = "<h1>T</h1><div class=b>Body <i>text</i></div>"
    text = json.dumps([{"url": "u", "content": html, "author": "kept?"}, {"url": "v", "content": "<h1> </h1>"}])
    selectors = {"title": "h1", "body": ".b", "author": ".author"}
    rows = parse_fields(listing_items(_payloads(spark, text)), selectors).orderBy("item_pos").collect()
    assert (rows[0].title, rows[0].body, rows[0].metadata) == ("T", "Body  text", {"author": None})
    assert rows[0].parse_error is None and rows[1].parse_error == "parse" and rows[1].missing == ["body", "title"]
    out = ingest_json_listing(_payloads(spark, text), selectors, "2024-01-01").orderBy("item_pos").collect()
    assert [r.error_kind for r in out] == [None, "parse"]


def test_ingest_dates_and_tags(spark):
    items = [{"url": str(i), "content": "<h1>t</h1><p>b</p>", "published_at": d, "tags": t}
             for i, (d, t) in enumerate([("2024-01-01T10:00:00Z", ["a"]), ("01/02/2024", "x,y"), (None, None)])]
    out = ingest_json_listing(_payloads(spark, json.dumps(items)), {"title": "h1", "body": "p"}, "2024-01-01", default_tags=["d"])
    rows = out.orderBy("item_pos").collect()
    assert [r.error_kind for r in rows] == [None, "normalize", None]
    assert [r.tags for r in rows] == [["a"], ["d"], ["d"]]
    assert str(rows[0].published_at) == "2024-01-01 10:00:00" and rows[2].published_at is None


PAGINATION_RULES = [
    ([1, 2], {"must be an object"}),
    ("x", {"must be an object"}),
    ({"start": "x"}, {"start must be a whole number"}),
    ({"stop": 2.5, "step": True}, {"stop must be a whole number", "step must be a whole number"}),
    ({"count": 1.5}, {"count must be a whole number"}),
    ({"count": 10**12}, {"count must be a whole number"}),
    ({"limit": -1}, {"limit must not be negative"}),
    ({"limit": " -2 "}, {"limit must not be negative"}),
    ({"pages": ["1", "q"]}, {"pages must be a list of whole numbers"}),
    ({"pages": 3}, {"pages must be a list of whole numbers"}),
    ({"pages": [1, None]}, {"pages must be a list of whole numbers"}),
    ({"param": 1, "params": []}, {"param must be text", "params must be an object"}),
    ({"start": " 2 ", "stop": "4", "step": -1, "pages": [1, "2"], "limit": 0, "param": "p", "params": {"a": "b"}}, set()),
    ({"start": None, "pages": None, "params": None}, set()),
    ({}, set()),
    (None, set()),
]


@pytest.mark.parametrize("where", ["page", "portal"])
def test_every_bad_pagination_is_a_violation(spark, where):
    rows = []
    for i, (setting, _) in enumerate(PAGINATION_RULES):
        page = {"url": "https://x/1"} | ({"pagination": setting} if where == "page" else {})
        body = config(pages=[{"url": "https://x/0"}, page])
        if where == "portal":
            body["components"]["scraper"]["options"]["pagination"] = setting
        rows.append((i, str(i), json.dumps(body)))
    found = config_violations(spark.createDataFrame(rows, "portal_idx int, file string, text string")).collect()
    for i, (setting, expected) in enumerate(PAGINATION_RULES):
        assert {r.rule for r in found if r.file == str(i)} == {f"pagination {x}" for x in expected}, setting
