"""Ingestion metrics that merge over runs, gap-filled daily series and alerts.

Latencies are kept as counts in log-linear buckets: the leading ``bits`` bits of a value below
its first one, and how far they were shifted. Counts of the same bucket add up, so runs combine
without reading their rows again, in any order and grouping, and the merged sketch equals the
one of a single pass. A quantile is at most ``2 ** -bits`` above the exact one, relatively; values
below ``2 ** (bits + 1)`` are exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 7
COUNTERS = ("attempts", "errors", "fallbacks", "reprocessed")


def bucket_of(value: Column, bits: int = BITS) -> Column:
    """Bucket of a whole number from 0 on; buckets ascend with the values. Negative ones count as 0."""
    whole = F.greatest(value.cast("long"), F.lit(0).cast("long"))
    shift = F.greatest(F.length(F.bin(whole)) - (bits + 1), F.lit(0))
    return (shift * (1 << bits) + F.call_function("shiftright", whole, shift)).cast("int")


def top_of(bucket: Column, bits: int = BITS) -> Column:
    """The largest value of a bucket."""
    shift = F.greatest(F.shiftright(bucket, bits) - 1, F.lit(0))
    lead = (bucket - shift * (1 << bits)).cast("long")
    return F.call_function("shiftleft", lead + 1, shift) - 1


def latency_sketch(attempts: DataFrame, by: Sequence[str], value: str, bits: int = BITS) -> DataFrame:
    """``by, bucket, n``: at most ``2 ** bits * 64`` rows per group. Null values are not counted."""
    known = attempts.where(F.col(value).isNotNull())
    return known.groupBy(*by, bucket_of(F.col(value), bits).alias("bucket")).agg(F.count("*").alias("n"))


def merged_sketch(sketch: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of several runs (one table, or a union) as one per ``by``."""
    return sketch.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, by: Sequence[str], percents: Sequence[int], bits: int = BITS) -> DataFrame:
    """``by, p50, ...``: the nearest-rank quantiles, each the top of its bucket.

    One group has a bounded number of buckets, whatever the number of values.
    """
    order = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sketch.withColumn("upto", F.sum("n").over(order)).withColumn("total", F.sum("n").over(Window.partitionBy(*by)))
    # the smallest bucket that holds the ceil(p / 100 * total)-th value
    found = [F.min(F.when(F.col("upto") * 100 >= F.col("total") * p, F.col("bucket"))).alias(f"p{p}") for p in percents]
    return ranked.groupBy(*by).agg(*found).select(*by, *[top_of(F.col(f"p{p}"), bits).alias(f"p{p}") for p in percents])


def run_counters(attempts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attempts, errors, fallbacks and reprocessed articles per ``by``.

    ``attempts`` has a row per fetched page: ``error_kind`` (null if all went well), ``method``
    (anything but ``direct`` is a fallback) and ``reprocessed``.
    """
    count = lambda condition: F.count(F.when(condition, 1))
    return attempts.groupBy(*by).agg(
        F.count("*").alias("attempts"),
        count(F.col("error_kind").isNotNull()).alias("errors"),
        count(F.col("method") != "direct").alias("fallbacks"),
        count(F.col("reprocessed")).alias("reprocessed"),
    )


def ingestion_metrics(counters: DataFrame, sketch: DataFrame, by: Sequence[str], percents: Sequence[int] = (50, 95)) -> DataFrame:
    """Counters, shares in hundredths of a percent and latency quantiles over any stored runs."""
    total = counters.groupBy(*by).agg(*[F.sum(c).alias(c) for c in COUNTERS])
    share = lambda name: F.expr(f"{name} * 10000 div attempts")
    rows = total.select(
        *by, *COUNTERS, share("errors").alias("error_share"), share("fallbacks").alias("fallback_share")
    )
    return rows.join(quantiles(merged_sketch(sketch, by), by, percents), list(by), "left")


def daily_series(rows: DataFrame, source: str, day: str, sums: Sequence[Column]) -> DataFrame:
    """``sums`` per source and day, zero on days without rows, from the first to the last day of all.

    The calendar is one narrow row per source and day.
    """
    counted = rows.groupBy(source, day).agg(*sums)
    names = [c for c in counted.columns if c not in (source, day)]
    ends = counted.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    days = F.explode(F.sequence(F.col("first"), F.col("last"))).alias(day)
    calendar = counted.select(source).distinct().join(F.broadcast(ends)).select(source, days)  # one row broadcast
    filled = calendar.join(counted, [source, day], "left")
    return filled.select(source, day, *[F.coalesce(c, F.lit(0)).alias(c) for c in names])


def alerts(series: DataFrame, source: str, day: str, window: int = 7, drop_percent: int = 50, rise_percent: int = 200, least: int = 1) -> DataFrame:
    """``source, day, kind, n, before, baseline_n, baseline_days`` for days that stand out.

    ``series`` has ``articles`` and ``errors`` for every source and day. A day is a ``drop`` if
    its articles fall below ``drop_percent`` of the mean of the ``window`` days before, and a
    ``rise`` if its errors exceed ``rise_percent`` of theirs; days without a whole window, and
    baselines below ``least`` a day on average, raise nothing (a rise needs ``least`` errors).
    ``before`` is the day before. All comparisons are in whole numbers.
    """
    order = Window.partitionBy(source).orderBy(day)
    past = order.rowsBetween(-window, -1)
    rows = series
    for name in ("articles", "errors"):
        rows = rows.withColumns({f"{name}_before": F.lag(name).over(order), f"{name}_sum": F.sum(name).over(past)})
    rows = rows.withColumn("days", F.count("*").over(past)).where(F.col("days") == window)
    drop = (F.col("articles_sum") >= least * window) & (F.col("articles") * 100 * window < F.col("articles_sum") * drop_percent)
    rise = (F.col("errors") >= least) & (F.col("errors") * 100 * window > F.col("errors_sum") * rise_percent)
    kinds = [("drop", "articles", drop), ("rise", "errors", rise)]
    found = [
        rows.where(where).select(
            source, day, F.lit(kind).alias("kind"), F.col(name).alias("n"), F.col(f"{name}_before").alias("before"),
            F.col(f"{name}_sum").alias("baseline_n"), F.col("days").alias("baseline_days"),
        )
        for kind, name, where in kinds
    ]
    return reduce(DataFrame.unionByName, found)


def top_per_period(rows: DataFrame, period: str, key: str, k: int, salts: int = 32) -> DataFrame:
    """``period, key, n, rank``: the ``k`` most frequent keys of every period.

    Ties in ``n`` go to the smaller key, so ranks are unique. Counts are added up before the
    shuffle; the best of every share of a period's keys are found first, then the best of those,
    so neither a frequent key nor a period with most keys meets in one task.
    """
    counted = rows.where(F.col(key).isNotNull()).groupBy(period, key).agg(F.count("*").alias("n"))
    order = [F.col("n").desc(), F.col(key)]
    share = F.row_number().over(Window.partitionBy(period, "_salt").orderBy(*order))
    first = counted.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(salts))).withColumn("rank", share).where(F.col("rank") <= k)
    last = F.row_number().over(Window.partitionBy(period).orderBy(*order))
    return first.drop("_salt").withColumn("rank", last).where(F.col("rank") <= k)
