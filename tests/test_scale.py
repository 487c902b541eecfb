"""Plan shapes and skew: what must hold for large inputs."""

import random

import pytest
from pyspark.sql import functions as F

from newsloom import schemas as S
from newsloom.operators.dedup import ORDER, dedup_fingerprint, dedup_url, mark_first
from newsloom.operators.upsert import plan_by_url
from newsloom.plans.collect import Components, Options, collect, collect_items
from newsloom.plans.samples import document_web, table
from newsloom.plans.verification import QUERIES
from newsloom.session import Staging, spread, unstaged
from test_scrape_collect import OPTIONS, PAGES, config, landed, plan_of


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def keyed(spark, n):
    """A third of the rows share one url and one fingerprint."""
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        (F.col("id") % 2).cast("int").alias("portal_idx"), F.lit(1).alias("page_index"), (F.lit(n) - F.col("id")).alias("position"),
        F.when(hot, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("url"),
        F.when(hot, F.lit("hot")).otherwise((F.col("id") % 100).cast("string")).alias("fingerprint"),
    )


def first_model(rows, key):
    seen, kept = set(), set()
    for row in sorted(rows, key=lambda r: (r.portal_idx, r.page_index, r.position)):
        if (row.portal_idx, row[key]) not in seen:
            seen.add((row.portal_idx, row[key]))
            kept.add((row.portal_idx, row.page_index, row.position))
    return kept


def test_hot_keys_keep_the_first(spark):
    df = keyed(spark, 3000)
    rows = df.collect()
    order = lambda frame: {(r.portal_idx, r.page_index, r.position) for r in frame.select(*ORDER).collect()}
    assert order(dedup_url(df)) == first_model(rows, "url")
    assert order(dedup_fingerprint(df)) == first_model(rows, "fingerprint")
    seen = spark.createDataFrame([("hot",), ("7",)], "fingerprint string")
    new = order(dedup_fingerprint(df, seen))
    assert new == {o for o in first_model(rows, "fingerprint") if o not in order(df.filter("fingerprint IN ('hot', '7')"))}


def test_order_keys_sort_numerically(spark):
    rng = random.Random(3)
    rows = [(rng.choice([0, 9, 10, 2**31 - 1]), rng.choice([1, 99, 100]), rng.choice([10**11, 10**15, 2**62]) + rng.randrange(10**9), "k") for _ in range(50)]
    df = spark.createDataFrame(rows, "portal_idx int, page_index int, position bigint, url string")
    first = mark_first(df, ["url"], "first").filter("first").collect()
    assert [tuple(r[:3]) for r in first] == [min(rows)[:3]]


@pytest.mark.parametrize("kinds", [("int", "int", "bigint"), ("bigint", "bigint"), ("int", "int"), ("int",), ("bigint", "int", "string")])
def test_order_keys_up_to_the_largest_numbers(spark, kinds):
    """Places of 64 bits sort and come back as they are; other types and widths keep a struct."""
    from newsloom.operators.dedup import pack_order, unpack_order

    rng, names = random.Random(4), ["a", "b", "c"][: len(kinds)]
    top = {"int": 2**31 - 1, "bigint": 2**63 - 1}
    value = {k: lambda k=k: rng.choice([0, 1, 10**12 % top[k], top[k] - rng.randrange(3), rng.randrange(top[k])]) for k in top}
    value["string"] = lambda: rng.choice("xyz")
    rows = [tuple(value[k]() for k in kinds) for _ in range(80)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
    packed = df.select(pack_order(df, names).alias("p"), *names).orderBy("p")
    back = packed.select(*unpack_order(F.col("p"), df, names))
    assert [tuple(r) for r in back.collect()] == sorted(rows)
    assert dict(back.dtypes) == dict(df.dtypes)


def test_a_negative_place_ends_the_job(spark):
    df = spark.createDataFrame([(0, 1, -1, "k")], "portal_idx int, page_index int, position bigint, url string")
    with pytest.raises(Exception, match="negative order column position"):
        mark_first(df, ["url"], "first").collect()


def test_dedup_and_upsert_never_window_over_keys(spark, no_broadcast):
    df = keyed(spark, 100)
    for plan in (plan_text(mark_first(df, ["portal_idx", "url"], "f")), plan_text(plan_by_url(df, None, "r"))):
        assert "Window" not in plan and "SortAggregate" not in plan
        assert "partial_min" in plan  # combined before the shuffle
        assert "Nested" not in plan and "Cartesian" not in plan


def test_scans_read_only_what_they_need(spark, sf_dir):
    plan = plan_text(QUERIES["fingerprint_docs"](spark, sf_dir))
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string,source:string>" in plan
    plan = plan_text(QUERIES["normalize_tags"](spark, sf_dir))
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string,p_brand:string,p_type:string>" in plan
    plan = plan_text(QUERIES["first_fingerprints"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(source), EqualTo(source,src3)]" in plan
    plan = plan_text(QUERIES["clean_text"](spark, sf_dir))
    assert plan.count("ArrowEvalPython") == 1 and "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_struct_fields_share_one_parse(spark, sf_dir):
    assert plan_text(QUERIES["article_extract"](spark, sf_dir)).count("ArrowEvalPython") == 1


def test_small_request_side_is_broadcast(spark, sf_dir):
    from newsloom.operators.paginate import expand_requests
    from newsloom.plans.scrape import fetch_listings

    plan, _ = document_web(spark, sf_dir)
    some = plan.filter("portal_idx = 0").limit(5)
    pages = table(spark, sf_dir, "pages").select(
        F.col("url").alias("request_url"), F.lit(None).cast("string").alias("final_url"), F.lit(200).alias("status_code"), "html"
    )
    fetched = fetch_listings(expand_requests(some), pages)
    fetched.collect()
    final = plan_text(fetched)
    assert "BroadcastHashJoin" in final


def test_spread_moves_only_small_scans(spark, sf_dir):
    scan = table(spark, sf_dir, "pages")
    assert spread(scan).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 100, 1, 50)
    assert spread(wide) is wide


def test_lazy_plan_gives_the_same_result(spark, tmp_path):
    plan, pages = plan_of(spark, tmp_path, config()), landed(spark, PAGES)
    rows = lambda result: sorted(map(str, result.outcomes.drop("article_id").collect()))
    assert rows(collect(plan, pages, OPTIONS, staged=unstaged)) == rows(collect(plan, pages, OPTIONS))


def test_staging_folder_goes_away(spark):
    with Staging(spark) as staged:
        copy = staged(spark.range(5), "numbers")
        assert copy.count() == 5
        path = staged.path
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_own_components(spark):
    items = spark.createDataFrame(
        [(0, "p", 1, 1, "A", "T", "<p>x</p>", None, [], "day 5", {}), (0, "p", 1, 2, "B", "t", "<p>y</p>", None, [], None, {})],
        S.SCRAPED_ITEMS,
    )
    pages = spark.createDataFrame([(0, "p", 1, "https://h/")], "portal_idx int, portal string, page_index int, page_url string")
    own = Components(
        join_url=lambda url, base, default: F.concat(base, F.lower(url)),
        parse_date=lambda text, reference: F.to_timestamp(F.regexp_extract(text, r"\d+", 0), "d"),
        fingerprint=lambda df: F.lower("title"),
    )
    result = collect_items(items, pages, Options(run_ts="2024-01-01", components=own))
    assert [r.outcome for r in result.outcomes.orderBy("position").collect()] == ["persisted", "fingerprint"]
    doc = result.changes.first()
    assert (doc.url, doc.fingerprint, doc.published_at.day) == ("https://h/a", "t", 5)
