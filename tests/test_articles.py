"""Search, outbox and reprocessing of stored articles."""

import datetime
import random
import re
from pathlib import Path

from pyspark.sql import functions as F

from newsloom.operators.metrics import run_status
from newsloom.operators.outbox import append_events, ingested_events, read_events
from newsloom.operators.reprocess import read_store, requested_days, selected, write_back, write_store
from newsloom.operators.search import Search, end_of, matches, open_postings, page, write_postings
from newsloom.session import staging_root


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pages_equal_one_sorted_list(spark):
    rng = random.Random(5)
    day = lambda: rng.choice([None, datetime.datetime(2024, 1, rng.randrange(1, 6), rng.randrange(24))])
    words = ["São", "paulo", "rio", "mar", "A1"]
    rows = [(i, rng.choice("ab"), day(), " ".join(rng.choice(words) for _ in range(rng.randrange(0, 5))) or None) for i in range(120)]
    seen = [(i, rng.choice([7, 8])) for i in range(120) if rng.random() < 0.5 for _ in range(2)]
    frame = spark.createDataFrame(rows, "article_id long, source string, published_at timestamp, text string")
    mentions = spark.createDataFrame(seen, "article_id long, entity_id long")
    path = f"{staging_root(spark)}/postings-test"
    write_postings(frame.select("article_id", "text"), path, buckets=16)
    postings = open_postings(spark, path, "long")
    first, last = datetime.datetime(2024, 1, 2), datetime.datetime(2024, 1, 4)
    searches = [
        Search(), Search(text="SAO, rio!"), Search(text="rio", sources=["b"], date_from=first, date_to=last),
        Search(entities=[7, 8]), Search(mentioned=False, text="a1"), Search(mentioned=True, sources=["a"]), Search(text="none"), Search(text="..."),
    ]
    for search in searches:
        wanted = set(re.findall(r"\w+", search.text.lower()))
        expected = []
        for i, source, date, text in rows:
            own = set((text or "").lower().replace("ã", "a").split())
            entities = {e for a, e in seen if a == i}
            fine = wanted <= own and (not search.sources or source in search.sources) and set(search.entities) <= entities
            fine &= search.date_from is None or date is not None and search.date_from <= date < search.date_to
            fine &= search.mentioned is None or search.mentioned == bool(entities)
            if fine and not (search.text.strip() and not wanted):
                expected.append((date is not None, date or datetime.datetime.min, i))
        expected = [i for *_, i in sorted(expected, reverse=True)]
        found, got, after = matches(frame.drop("text"), search, postings, mentions, buckets=16), [], None
        for _ in range(3):
            rows_ = page(found, 17, after)
            got += [r.article_id for r in rows_.collect()]
            after = end_of(rows_)
            if after is None:
                break
        assert got == expected[: 3 * 17], search
    near = matches(frame.drop("text"), Search(text="rio mar"), postings, buckets=16)
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN|PartitionFilters: \[[^\]]*\(bucket#", plan_text(near))
    assert "TakeOrderedAndProject" in plan_text(page(near, 5))


def test_a_replay_adds_no_event(spark):
    articles = spark.createDataFrame([(i, "s") for i in range(6)] + [(5, "s")], "article_id long, source string")
    entities = spark.createDataFrame([(i, e, f"n{e}", None) for i in range(1, 5) for e in range(i * 3)] + [(1, 0, "n0", None)], "article_id long, entity_id long, name string, uf string")
    events = ingested_events(articles, entities, "v1", ["source"], part=4)
    path = f"{staging_root(spark)}/outbox-test"
    rows = lambda: sorted((r.article_id, r.pipeline_version, r.part, r.n_parts, len(r.entities), r.version) for r in read_events(spark, path, events.schema).collect())
    some = events.where("article_id < 3")
    assert append_events(some, path, 1).count() == some.count()
    append_events(events, path, 2)
    first = rows()
    assert [(a, p, n, k) for a, _, p, n, k, _ in first] == [(0, 0, 1, 0), (1, 0, 1, 3), (2, 0, 2, 4), (2, 1, 2, 2), (3, 0, 3, 4), (3, 1, 3, 4), (3, 2, 3, 1), (4, 0, 3, 4), (4, 1, 3, 4), (4, 2, 3, 4), (5, 0, 1, 0)]
    assert {a: v for a, *_, v in first} == {0: 1, 1: 1, 2: 1, 3: 2, 4: 2, 5: 2}
    append_events(events, path, 2)  # the same run again
    append_events(events, path, 3)  # a later run with nothing new
    assert rows() == first
    append_events(ingested_events(articles, entities, "v2", ["source"], part=4), path, 4)
    assert len(rows()) == 2 * len(first)
    assert append_events(events.limit(0), path, 5).count() == 0


def test_only_touched_partitions_are_written(spark):
    path = f"{staging_root(spark)}/reprocess-test"
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int"))
    rows = spark.range(200).select(F.col("id").alias("article_id"), F.lit(1).alias("pipeline"), F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("source"), day.alias("day"))
    write_store(rows, path)
    schema = "article_id long, pipeline int, source string, day date"
    files = lambda: {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    before, store = files(), read_store(spark, path, schema)
    d = lambda n: datetime.date(2024, 1, n)
    requests = spark.createDataFrame([("s1", d(2), d(3)), ("s9", d(1), d(5)), (None, d(1), d(2)), ("s1", d(5), d(4))], "source string, date_from date, date_to date")
    single = spark.createDataFrame([(0, "s0", d(1)), (7, "s1", d(3))], "article_id long, source string, day date")
    again = selected(store, requested_days(requests), single)
    assert "dynamicpruning" in plan_text(again).lower()
    expected = {i for i in range(200) if i % 3 == 1 and i % 5 in (1, 2)} | {0, 7}
    assert {r.article_id for r in again.collect()} == expected
    assert write_back(store, path, again.withColumn("pipeline", F.lit(2))) == 3
    after = files()
    same = [f for f in before if "source=s2" in f or "day=2024-01-05" in f]
    assert same and all(after.get(f) == before[f] for f in same)
    got = {r.article_id: r.pipeline for r in read_store(spark, path, schema).collect()}
    assert got == {i: 2 if i in expected else 1 for i in range(200)}
    assert selected(store).count() == 0


def test_status_of_a_run(spark):
    metrics = spark.createDataFrame([("a", 3, {"url": 2, "parse": 1}, False), ("b", 0, {}, True)], "portal string, processed long, skipped map<string,long>, failed boolean")
    assert tuple(run_status(metrics).first()) == (2, 1, 3, 3, 1)
    assert tuple(run_status(metrics.where("NOT failed")).first()) == (1, 0, 3, 3, 0)
    assert tuple(run_status(metrics.limit(0)).first()) == (0, 0, 0, 0, 0)
