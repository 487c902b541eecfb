"""Week dates, fractions of seconds in fingerprints, and configuration files in odd places."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from newsloom.functions.dates import parse_date, parse_iso
from newsloom.functions.fingerprint import fingerprint
from newsloom.sources.portals import read_configs


def test_week_dates(spark):
    texts = ["2024-W02-3", "2024W023", "2020-W53-7", "2021-W01", "2026-W10-1T06:45", "0001-W01-1"]
    bad = ["2023-W53-1", "2024-W00-1", "2024-W02-8", "2024-W023", "2024W02-3", "W02-3"]
    rows = spark.createDataFrame([(t,) for t in texts + bad], "text string")
    read = rows.select("text", *[f(F.col("text")).cast("string").alias(n) for n, f in (("a", parse_date), ("b", parse_iso))])
    found = {r.text: (r.a, r.b) for r in read.collect()}
    for text in texts:
        expected = str(datetime.fromisoformat(text))
        assert found[text] == (expected, expected), text
    assert all(found[text] == (None, None) for text in bad)


def test_fraction_tells_times_apart(spark):
    rows = spark.sql(
        "SELECT * FROM VALUES (timestamp'2024-05-01 10:00:00'), (timestamp'2024-05-01 10:00:00.5'),"
        " (timestamp'2024-05-01 10:00:00.500001') AS t(published_at)"
    )
    prints = [r[0] for r in rows.select(fingerprint(rows, ["published_at"])).collect()]
    assert len(set(prints)) == 3
    whole = spark.sql("SELECT sha2(concat('', '␟', '2024-05-01 10:00:00'), 256)").first()[0]
    assert prints[0] == whole


def test_paths_with_blanks_and_percent_signs(spark, tmp_path):
    folder = tmp_path / "meus portais"
    folder.mkdir()
    for name in ("a b.json", "c%20d.json"):
        (folder / name).write_text(json.dumps({"name": name}), "utf-8")
    rows = read_configs(spark, directory=str(folder)).orderBy("portal_idx").collect()
    assert sorted(json.loads(r.text)["name"] for r in rows) == ["a b.json", "c%20d.json"]
