"""Histograms of durations in fixed buckets.

A histogram is a row per key and bucket with a count. Buckets are fixed, so histograms of parts
(batches, runs, hosts) are added up by bucket, in any order, and quantiles are read from them
within the width of a bucket. Counting is one aggregation with a fixed-size state per key that
combines on the map side, so a hot key costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import pairwise

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Upper bounds in seconds; behind the last one all longer durations share a bucket. The declared
# latency target, 100 ms, is a bound.
BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0)
TARGET_SECONDS = 0.1


def histogram(rows: DataFrame, seconds: str, keys: Sequence[str] = (), bounds: Sequence[float] = BOUNDS) -> DataFrame:
    """``bucket``, ``over_seconds`` (NULL in the first), ``upto_seconds`` (NULL in the last), ``n``
    and ``n_upto`` (with all buckets before) of every key; empty buckets too.

    A duration on a bound belongs to the bucket below it. NULL and NaN are not counted, and a key
    with nothing else has empty buckets.
    """
    if not bounds or any(a >= b for a, b in pairwise(bounds)):
        raise ValueError("bounds must rise")
    value = F.col(seconds).cast("double")
    over = (None, *bounds)
    upto = (*bounds, None)
    counts = []
    for low, high in zip(over, upto, strict=True):
        inside = ~F.isnan(value) if low is None else (value > low) & ~F.isnan(value)
        counts.append(F.count_if(inside if high is None else inside & (value <= high)))
    buckets = F.array(
        *[
            F.struct(
                F.lit(i).alias("bucket"),
                F.lit(low).cast("double").alias("over_seconds"),
                F.lit(high).cast("double").alias("upto_seconds"),
                n.alias("n"),
            )
            for i, (low, high, n) in enumerate(zip(over, upto, counts, strict=True))
        ]
    )
    return _summed(rows.groupBy(*keys).agg(buckets.alias("buckets")).select(*keys, F.inline("buckets")), keys)


def merged(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One histogram of many with the same bounds."""
    added = parts.groupBy(*keys, "bucket", "over_seconds", "upto_seconds").agg(F.sum("n").alias("n"))
    return _summed(added, keys)


def _summed(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A window over the buckets of a key: as many rows as there are bounds."""
    before = Window.partitionBy(*keys).orderBy("bucket")
    return counts.withColumn("n_upto", F.sum("n").over(before))


def quantiles(buckets: DataFrame, shares: Sequence[float], keys: Sequence[str] = ()) -> DataFrame:
    """``share`` and ``seconds`` of every key: within its bucket a quantile is interpolated, in
    the last one it is the highest bound. NULL for a key without durations."""
    whole = Window.partitionBy(*keys)
    ranked = buckets.withColumn("total", F.max("n_upto").over(whole)).withColumn("highest", F.max("upto_seconds").over(whole))
    wanted = ranked.select("*", F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share"))
    rank = F.col("share") * F.col("total")
    low = F.coalesce("over_seconds", F.lit(0.0))
    within = (rank - (F.col("n_upto") - F.col("n"))) / F.col("n")
    found = F.when(F.col("upto_seconds").isNull(), F.col("highest")).otherwise(
        low + (F.col("upto_seconds") - low) * within
    )
    # The share 0 is the lower edge of the first bucket in use.
    begun = (F.col("n_upto") - F.col("n") < rank) | ((rank <= 0) & (F.col("n_upto") == F.col("n")))
    here = (F.col("n") > 0) & (F.col("n_upto") >= rank) & begun
    return wanted.groupBy(*keys, "share").agg(F.min(F.when(here, found)).alias("seconds"))


def within_target(buckets: DataFrame, keys: Sequence[str] = (), target: float = TARGET_SECONDS) -> DataFrame:
    """``n_batches`` and the ``share`` of them that took ``target`` seconds (a bound) at most."""
    n = F.sum("n")
    fast = F.sum(F.when(F.col("upto_seconds") <= target, F.col("n")).otherwise(0))
    return buckets.groupBy(*keys).agg(n.alias("n_batches"), F.try_divide(fast, n).alias("share"))
