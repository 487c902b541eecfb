"""What must not grow with the input: memory of a worker, passes over a table, files opened."""

import pyarrow as pa

from newsloom.operators import extract as X


def test_a_batch_is_parsed_in_slices():
    htmls = [f"<li><a href='/{i}'>{'x' * 50_000}</a></li>" for i in range(100)] + [None, "", "y" * 3_000_000]
    options = ['{"item_selector": "li"}'] * len(htmls)
    alive = []

    def counted(html, given):
        alive.append(len(html or ""))
        return X._listing_items(html, given)

    given = iter([(pa.array(htmls), pa.array(options))])
    sizes, found = [], []
    for part in X._arrow(counted, X._LISTING_ARROW, given):
        sizes.append((len(part), sum(alive)))
        found += part.to_pylist()
        alive.clear()
    assert [n and [i["href"] for i in n] for n in found[:100]] == [[f"/{i}"] for i in range(100)]
    assert len(found) == len(htmls)
    assert all(rows == 1 or size <= X.SLICE_BYTES for rows, size in sizes) and len(sizes) > 5
    assert list(X._arrow(counted, X._LISTING_ARROW, iter([(pa.array([], pa.string()), pa.array([], pa.string()))]))) == []


def test_configs_are_numbered_by_name_and_dealt_out(spark, tmp_path):
    from newsloom.sources.portals import read_configs

    names = [f"{i % 7}/{chr(97 + i % 5)} {i}.json" for i in range(60)]
    for name in names:
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(name)
    given = [str(tmp_path / names[i]) for i in (33, 4, 33)]
    configs = read_configs(spark, given, str(tmp_path))
    rows = sorted((r.portal_idx, r.text) for r in configs.collect())
    order = [names[33], names[4]]
    order += sorted((n for n in names if n not in order), key=lambda n: n.replace(" ", "%20"))
    assert rows == list(enumerate(order))
    assert configs.rdd.getNumPartitions() > 1


def test_events_shuffle_by_article_once(spark):
    from newsloom.operators.outbox import ingested_events

    entities = spark.range(600).selectExpr("id % 7 AS article_id", "id % 50 AS entity_id", "'n' AS name", "'SP' AS uf")
    articles = spark.createDataFrame([(i,) for i in range(9)], "article_id long")
    events = ingested_events(articles, entities, "v1", part=20)
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert ", part#" not in "".join(line for line in plan.splitlines() if "hashpartitioning" in line)
    found = sorted((r.article_id, r.part, r.n_parts, len(r.entities)) for r in events.collect())
    model = [(a, p, 3, 20 if p < 2 else 10) for a in range(7) for p in range(3)] + [(7, 0, 1, 0), (8, 0, 1, 0)]
    assert found == model


def test_a_collect_run_moves_items_and_listings_once(spark, sf_dir, monkeypatch):
    from newsloom.plans import scrape as module
    from newsloom.plans.samples import document_web
    from newsloom.session import stage

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan, pages = document_web(spark, sf_dir)
        staged = {}

        def keep(df, name):
            staged[name] = stage(df, name)
            return staged[name]

        found = module.scrape(plan, stage(pages, "landed"), keep, unique_pages=True)
        text = found.articles._jdf.queryExecution().executedPlan().toString()
        assert set(staged["items"].columns) == {"portal_idx", "page_index", "position", "portal", "url", "fetch_url", "is_first"}
        moved = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
        assert sum("fetch_url" in line for line in moved) == 1 and not any("position" in line for line in moved)
        assert found.first.count() == found.items.where("is_first").count() >= found.articles.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
