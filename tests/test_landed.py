"""Pages that were landed more than once."""

from newsloom.plans.collect import Options, collect
from newsloom.plans.samples import document_web
from newsloom.sources.landed import latest_pages


def test_relanded_pages_change_nothing_but_the_newest_row(spark, sf_dir):
    from pyspark.sql import functions as F

    plan, pages = document_web(spark, sf_dir)
    plan = plan.where("portal_idx = 0")
    newest = pages.withColumn("fetched_at", F.lit("2024-05-02").cast("timestamp"))
    older = pages.withColumn("fetched_at", F.lit("2024-05-01").cast("timestamp")).withColumn("html", F.lit("<p>old</p>"))
    options = Options(run_ts="2024-06-01 12:00:00", run_id="r")
    once = collect(plan, newest, options)
    again = collect(plan, newest.union(older).union(newest), options)
    assert sorted(map(repr, again.outcomes.collect())) == sorted(map(repr, once.outcomes.collect()))
    urls = [r.url for r in again.changes.select("url").collect()]
    assert len(urls) == len(set(urls)) == once.changes.count() > 0


def test_latest_of_rows_without_a_time(spark):
    rows = [("u", None, 200, "a", None), ("u", None, 200, "a", None), ("v", None, 404, None, None)]
    pages = spark.createDataFrame(rows, "request_url string, final_url string, status_code int, html string, fetched_at timestamp")
    assert sorted((r.request_url, r.html) for r in latest_pages(pages).collect()) == [("u", "a"), ("v", None)]
