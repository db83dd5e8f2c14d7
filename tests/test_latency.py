"""Histograms of durations, and those of the batches of a stream."""

import math
import random

import pytest
from pyspark.sql import functions as F

from logweir.operators import latency
from logweir.sources import queue
from logweir.streaming import run, sinks
from tests.test_streaming import add_file, queue_of, scan_rows


def brute(values, bounds):
    edges = [-math.inf, *bounds, math.inf]
    return [sum(a < v <= b for v in values) for a, b in zip(edges, edges[1:], strict=False)]


def counts(buckets):
    rows = sorted(buckets.collect(), key=lambda r: r["bucket"])
    total = 0
    for r in rows:
        total += r["n"]
        assert r["n_upto"] == total
    return [r["n"] for r in rows]


def test_buckets_and_bounds(spark):
    values = [0.0, 0.1, 0.1000001, 60.0, 61.0, 1e9, -1.0, 0.005]
    rows = spark.createDataFrame([(v,) for v in [*values, None, math.nan]], "s double")
    found = latency.histogram(rows, "s")
    assert counts(found) == brute(values, latency.BOUNDS)
    edges = [(r["over_seconds"], r["upto_seconds"]) for r in sorted(found.collect(), key=lambda r: r["bucket"])]
    assert edges == list(zip((None, *latency.BOUNDS), (*latency.BOUNDS, None), strict=True))
    for bad in ((), (1.0, 1.0), (2.0, 1.0)):
        with pytest.raises(ValueError, match="rise"):
            latency.histogram(rows, "s", (), bad)


def test_parts_add_up_and_empty_input(spark):
    rng = random.Random(3)
    data = [(rng.choice(["a", "b", None]), rng.choice("xyz"), rng.lognormvariate(-2, 2)) for _ in range(500)]
    rows = spark.createDataFrame(data, "k string, part string, s double")
    whole = latency.histogram(rows, "s", ("k",))
    parts = latency.merged(latency.histogram(rows, "s", ("k", "part")), ("k",))
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))
    for key in ("a", "b", None):
        mine = whole.filter(F.col("k").eqNullSafe(F.lit(key)))
        assert counts(mine) == brute([s for k, _, s in data if k == key], latency.BOUNDS)
    none = rows.filter("k = 'nobody'")
    assert latency.histogram(none, "s", ("k",)).count() == 0
    assert counts(latency.histogram(none, "s")) == [0] * (len(latency.BOUNDS) + 1)


def test_quantiles_lie_in_their_bucket(spark):
    rng = random.Random(4)
    values = sorted(rng.lognormvariate(-2, 2) for _ in range(999))
    found = latency.histogram(spark.createDataFrame([(v,) for v in values], "s double"), "s")
    shares = (0.0, 0.01, 0.5, 0.9, 0.99, 1.0)
    for r in latency.quantiles(found, shares).collect():
        exact = values[max(math.ceil(r["share"] * len(values)) - 1, 0)]
        upper = min([b for b in latency.BOUNDS if exact <= b], default=None)
        if upper is None:
            assert r["seconds"] == latency.BOUNDS[-1]
        else:
            lower = max([b for b in latency.BOUNDS if b < exact], default=0.0)
            assert lower <= r["seconds"] <= upper
    empty = latency.histogram(spark.createDataFrame([], "s double"), "s")
    assert [r["seconds"] for r in latency.quantiles(empty, (0.5,)).collect()] == [None]


def test_share_within_the_target(spark):
    rows = spark.createDataFrame([(0.05,), (0.1,), (0.2,), (99.0,)], "s double")
    assert tuple(latency.within_target(latency.histogram(rows, "s")).first()) == (4, 0.5)


def test_every_batch_of_a_query_is_counted_once(spark, tmp_path):
    folder = str(tmp_path / "q")
    for n in range(3):
        add_file(folder, n, queue_of(spark, scan_rows(10 * n, 5)))
    counters = sinks.CounterTable(spark, str(tmp_path / "counters"))
    spark.streams.addListener(counters)
    try:
        started = run.start_streams(
            queue.file_stream(spark, folder, 1), str(tmp_path / "cp"), str(tmp_path / "out"),
            available_now=True, name="h-", rejects=True,
        )
        run.wait(started, counters)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        counters.await_batches({str(q.runId): q.lastProgress["batchId"] for q in started})
    finally:
        spark.streams.removeListener(counters)
    counters.flush()
    rows = spark.read.parquet(counters.path)
    assert rows.filter("duration_ms is null or duration_ms <= 0").count() == 0
    recorded = {r["query"]: r["count"] for r in rows.groupBy("query").count().collect()}
    assert recorded["h-both"] >= 3 and recorded["h-rejects"] == 3
    found = counters.latency()
    assert {r["query"]: r["n"] for r in found.groupBy("query").agg(F.sum("n").alias("n")).collect()} == recorded
    shares = {r["query"]: r for r in latency.within_target(found, ("query",)).collect()}
    assert {q: r["n_batches"] for q, r in shares.items()} == recorded
