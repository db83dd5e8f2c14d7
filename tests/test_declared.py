"""Quality, lookups, outliers, forest, store."""

import ipaddress
import math
import random
import statistics
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from logweir.operators import forest, lookup, outliers, quality
from logweir.plans import queries as Q
from logweir.settings import Thresholds
from logweir.sources import store

START = datetime(2024, 1, 15, 10, 0, tzinfo=timezone.utc)


def test_null_handling(spark):
    rows = [("t", "a", "INFO"), (None, "a", "INFO"), ("t", None, "INFO"), ("t", "a", None)]
    df = spark.createDataFrame(rows, "timestamp string, source_ip string, severity string")
    assert quality.handle_nulls(df).count() == 4
    assert quality.handle_nulls(df, "skip").count() == 1
    assert quality.handle_nulls(df.limit(1), "error").count() == 1
    with pytest.raises(Exception, match="NULL in a required field"):
        quality.handle_nulls(df, "error").count()
    with pytest.raises(ValueError):
        quality.handle_nulls(df, "other")


def test_quality_of_no_rows(spark):
    row = quality.data_quality(spark.createDataFrame([], "source_ip string, bytes_sent string")).first()
    assert (row.total_rows, row.completeness, row.quality) == (0, None, None)


def test_quality_counts_absent_columns_as_empty(spark):
    df = spark.createDataFrame([("a", "1"), ("b", "x"), (None, None)], "source_ip string, bytes_sent string")
    row = quality.data_quality(df).first()
    assert row.completeness == 4 / 45
    assert row.quality == 1 / 3
    assert (row.completeness_ok, row.quality_ok) == (False, False)


def test_late_is_strict(spark):
    rows = [(START, START + timedelta(minutes=10)), (START, START + timedelta(minutes=10, microseconds=1))]
    df = spark.createDataFrame(rows, "timestamp timestamp, ingestion_time timestamp")
    assert quality.late_logs(df).count() == 1


def test_failed_attempts_is_strict(spark):
    rows = [(START, "a", "FAILED")] * 3 + [(START, "b", "FAILED")] * 2 + [(START, "b", "OK")] * 5
    df = spark.createDataFrame(rows, "timestamp timestamp, source_ip string, connection_status string")
    out = quality.failed_attempts(df, Thresholds(connection_attempts=2)).collect()
    assert [(r.source_ip, r.failed_connections) for r in out] == [("a", 3)]


def test_store_prunes_old_partitions(spark, tmp_path):
    rows = [(START - timedelta(days=d), d) for d in (0, 89, 90, 91, 200)]
    df = spark.createDataFrame(rows, "timestamp timestamp, d int")
    store.write_logs(df, str(tmp_path / "logs"))
    kept = quality.retained(spark.read.parquet(str(tmp_path / "logs")), START)
    assert sorted(r.d for r in kept.collect()) == [0, 89, 90]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "make_date" in filters
    assert sorted(r.d for r in quality.retained(df, START).collect()) == [0, 89, 90]


def test_geo_equals_brute_force(spark):
    rng = random.Random(3)
    cidrs = ["0.0.0.0/1", "10.0.0.0/8", "10.1.0.0/16", "10.1.2.0/24", "10.1.2.7/32", "192.168.0.0/16", "junk", "1.2.3.4/40"]
    ranges = spark.createDataFrame([(c, f"at {c}") for c in cidrs], "cidr string, location string")
    ips = ["10.1.2.7", "10.1.2.8", "10.1.9.9", "10.200.0.1", "200.1.1.1", "192.168.255.255", "::1", "x", None, ""]
    ips += [".".join(str(rng.choice([0, 1, 2, 7, 10, 128, 192, 168, 255])) for _ in range(4)) for _ in range(200)]
    logs = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "i int, source_ip string")
    nets = [ipaddress.ip_network(c) for c in cidrs[:6]]

    def brute(ip):
        try:
            address = ipaddress.IPv4Address(ip)
        except (ValueError, TypeError):
            return None
        hits = [n for n in nets if address in n]
        return f"at {max(hits, key=lambda n: n.prefixlen)}" if hits else None

    out = lookup.join_geo(logs, ranges).collect()
    assert len(out) == len(ips)
    assert {r.i: r.location for r in out} == {i: brute(ip) for i, ip in enumerate(ips)}


def test_geo_without_ranges(spark):
    ranges = spark.createDataFrame([], "cidr string, location string")
    logs = spark.createDataFrame([("10.0.0.1",), (None,)], "source_ip string")
    assert [r.location for r in lookup.join_geo(logs, ranges).collect()] == [None, None]


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_lookups_with_and_without_broadcast(spark, threshold):
    """The joins give the same rows when a table is too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        rows = [("a", "b")] * 50 + [("c", "d"), (None, "b"), ("c", None), (None, None)]
        logs = spark.createDataFrame(rows, "source_ip string, destination_ip string")
        threats = spark.createDataFrame([("b",), ("b",), (None,)], "ip string")
        flagged = lookup.flag_threats(logs, threats).groupBy("is_threat").count().collect()
        assert {r["is_threat"]: r["count"] for r in flagged} == {True: 51, False: 3}
        assets = spark.createDataFrame([("a", "web")], "source_ip string, owner string")
        joined = lookup.join_assets(logs, assets)
        assert joined.count() == len(rows)
        assert joined.filter("owner = 'web'").count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def check_zscores(spark, groups):
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "source_ip string, x double")
    rows = outliers.zscores(df.repartition(5), "x").collect()
    assert len(rows) == sum(map(len, groups.values()))
    stats = {}
    for k, values in groups.items():
        middle = statistics.median(values)
        stats[k] = (
            statistics.mean(values),
            statistics.stdev(values) if len(values) > 1 else 0,
            middle,
            statistics.median(abs(v - middle) for v in values),
        )
    for r in rows:
        mean, deviation, middle, mad = stats[r.source_ip]
        z = (r.x - mean) / deviation if deviation else None
        m = 0.6745 * (r.x - middle) / mad if mad else None
        assert r.zscore == (None if z is None else pytest.approx(z, abs=1e-9))
        assert r.modified_zscore == (None if m is None else pytest.approx(m, abs=1e-9))
        assert r.is_zscore_outlier == (None if z is None else abs(z) > 3)
        assert r.is_modified_zscore_outlier == (None if m is None else abs(m) > 3.5)


def test_zscores_equal_statistics(spark):
    rng = random.Random(5)
    check_zscores(
        spark,
        {
            "odd": [float(rng.randrange(50)) for _ in range(21)],
            "even": [float(rng.randrange(50)) for _ in range(30)] + [900.0],
            None: [1.0, 2.0, 3.0, 100.0],
            "": [5.0, 6.0, 9.0],
            "flat": [4.0, 4.0, 4.0],
            "one": [7.0],
            "two": [1.0, 2.0],
        },
    )


def test_zscores_of_a_hot_key_with_distinct_values(spark):
    """Far more values than the sketch keeps, half of the rows in one key."""
    rng = random.Random(6)
    groups = {"hot": [rng.lognormvariate(0, 3) for _ in range(40001)]}
    for i in range(200):
        groups[f"s{i}"] = [rng.gauss(i, 1) for _ in range(200)]
    check_zscores(spark, groups)


def test_zscores_of_infinite_values(spark):
    """A key whose centre is not finite has no scores; the others keep theirs."""
    rows = [("inf", float("inf"))] * 5 + [("some", float("inf")), ("some", 1.0), ("some", 2.0), ("some", 4.0)]
    rows += [("ends", float("inf")), ("ends", float("-inf"))]
    df = spark.createDataFrame([(k, v) for k, v in rows] + [("ok", 1.0), ("ok", 2.0), ("ok", 9.0)], "source_ip string, log_count double")
    out = outliers.zscores(df).collect()
    assert len(out) == 14
    for r in out:
        if r.source_ip in ("inf", "ends"):
            assert r.zscore is None and r.modified_zscore is None
        if r.source_ip == "ok":
            assert r.modified_zscore == pytest.approx(0.6745 * (r.log_count - 2))
        if r.source_ip == "some" and r.log_count == 1.0:
            assert r.zscore is None and r.modified_zscore == pytest.approx(0.6745 * -2 / 1.5)


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    "spark.sql.shuffle.partitions": "24",
}


@pytest.fixture
def skewed(spark):
    """Settings under which small tables behave like large ones with a hot key."""
    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_logs(spark, n=60_000):
    source = "case when id % 3 = 0 then '10.0.0.7' when id % 3 = 1 then null else concat('10.1.', id % 200, '.', id % 97) end"
    return spark.range(n).selectExpr("id as event_id", f"{source} as source_ip", "concat('8.8.4.', id % 90) as destination_ip", "repeat('x', 40) as message")


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_addresses_are_split(skewed):
    logs = hot_logs(skewed)
    names = skewed.createDataFrame([("10.0.0.7", "a"), ("10.1.3.4", "b")], "source_ip string, owner string")
    assets = names.groupBy("source_ip").agg(F.min("owner").alias("owner"))
    threats = skewed.createDataFrame([("10.0.0.7",), ("8.8.4.8",)], "ip string")
    ranges = skewed.createDataFrame([("10.0.0.0/8", "x"), ("10.0.0.0/24", "y")], "cidr string, location string")
    # More networks than the one scan takes.
    located = lookup.join_geo(logs, ranges, most=1)
    for found in (lookup.join_assets(logs, assets), lookup.flag_threats(logs, threats), located):
        assert found.count() == 60_000
        assert "skew=true" in final_plan(found)


def test_hot_key_of_a_median_is_shuffled_anew(skewed):
    rows = skewed.range(60_000).selectExpr("case when id % 3 = 0 then '=a' else concat('=', id % 50) end as k", "cast(id * 7 % 9973 as double) as value")
    brackets = rows.groupBy("k").agg(outliers._bracket("value"))
    middle = outliers._median(rows, brackets, "value", "median")
    assert {r.k for r in middle.collect()} == {r.k for r in brackets.collect()}
    plan = final_plan(middle)
    join = plan.index("SortMergeJoin")
    grouped = [m for m in ("hashpartitioning(k#", "side#") if m in plan[:join]]
    assert len(grouped) == 2 and "Exchange" in plan[:join]


def test_season_is_found(spark):
    rows = [
        (START.replace(hour=0) + timedelta(hours=h, minutes=m), "internal")
        for h in range(24 * 12)
        for m in range(10 + (h % 24) + (40 if h == 150 else 0))
    ]
    df = spark.createDataFrame(rows, "timestamp timestamp, traffic_direction string")
    out = outliers.seasonal_residual(df).orderBy(F.abs("residual").desc()).collect()
    assert len(out) == 24 * 12
    assert out[0].hour.replace(tzinfo=timezone.utc) == START.replace(hour=0) + timedelta(hours=150)
    for r in out:
        assert r.log_count == pytest.approx(r.trend + r.seasonal + r.residual)


def forest_metrics(spark, n):
    rows = []
    for i in range(n):
        far = i % 100 == 0
        rows.append((i, "s%d" % i, 10000 + i if far else 50 + i % 7, 9000.0 if far else 100.0 + i % 11))
    df = spark.createDataFrame(rows, "i int, source_ip string, log_count bigint, avg_response_time double")
    window = F.struct(F.timestamp_seconds(F.col("i") * 60).alias("start"), F.timestamp_seconds(F.col("i") * 60 + 300).alias("end"))
    return df.select(
        "i", window.alias("window"), "source_ip", F.lit("internal").alias("traffic_direction"),
        F.lit("INFO").alias("severity"), "log_count", "avg_response_time",
    )


def test_forest_isolates_the_far_rows(spark):
    features = ("log_count", "avg_response_time")
    df = forest_metrics(spark, 2000)
    out = forest.isolation_scores(df, features, contamination=0.01, trees=50).collect()
    assert len(out) == 2000
    assert all(0 < r.isolation_score < 1 for r in out)
    far = [r.isolation_score for r in out if r.i % 100 == 0]
    near = [r.isolation_score for r in out if r.i % 100]
    assert min(far) > max(near)
    again = {r.i: r.isolation_score for r in forest.isolation_scores(df.repartition(7), features, contamination=0.01, trees=50).collect()}
    assert again == {r.i: r.isolation_score for r in out}


def drawn_rows(spark, n, trees, sample):
    df = spark.range(n).withColumn("id", F.col("id").cast("string"))
    rows = df.select("id", F.explode(forest._trees_of(min(1.0, sample / n), trees, 42)).alias("tree")).collect()
    return [{r["id"] for r in rows if r.tree == t} for t in range(trees)]


@pytest.mark.parametrize("n", [500, 20_000])
def test_trees_draw_alike_at_every_size(spark, n):
    """Below and above trees x sample rows: sizes near the sample, and independent draws."""
    trees, sample = 40, 64
    drawn = drawn_rows(spark, n, trees, sample)
    sizes = [len(d) for d in drawn]
    assert 0.8 * sample < sum(sizes) / trees < 1.2 * sample and max(sizes) < 2 * sample
    pairs = trees * (trees - 1) / 2
    overlap = sum(len(a & b) for i, a in enumerate(drawn) for b in drawn[:i])
    expected = pairs * sample * sample / n
    assert abs(overlap - expected) < 6 * expected**0.5 + 0.1 * expected


def test_every_row_when_the_sample_is_larger(spark):
    assert drawn_rows(spark, 30, 3, 64) == [{str(i) for i in range(30)}] * 3


def test_forest_groups_stay_small(spark):
    df = forest_metrics(spark, 3000).withColumn("id", F.col("source_ip"))
    sizes = [r["size"] for r in forest.grow_forest(df, ("log_count",), trees=20, sample=64).collect()]
    assert len(sizes) == 20 and max(sizes) < 2 * 64


def test_lost_trees_are_an_error(spark):
    with pytest.raises(ValueError, match="trees drew a row"):
        forest.isolation_scores(forest_metrics(spark, 2000), ("log_count",), trees=30, sample=1)


def test_nan_counts_as_null_in_the_forest(spark):
    df = forest_metrics(spark, 300)
    odd = F.when(F.col("i") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("avg_response_time"))
    scores = []
    for bad in (odd, F.when(F.isnan(odd), None).otherwise(odd)):
        rows = df.withColumn("avg_response_time", bad)
        out = forest.isolation_scores(rows, ("log_count", "avg_response_time"), trees=10).collect()
        scores.append({r.i: r.isolation_score for r in out})
    assert scores[0] == scores[1] and all(s == s for s in scores[0].values())


def test_cut_is_the_exact_quantile(spark):
    rng = random.Random(4)
    values = [rng.choice([rng.randrange(10**9 + 1), 5, 123_456_789, 10**9]) for _ in range(3001)]
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    for share in (0.0004, 0.1, 0.5, 0.9, 1.0):
        assert forest.cut_at(rows, share) == sorted(values)[math.ceil(share * len(values)) - 1]
    assert forest.cut_at(rows.limit(0), 0.5) is None


def test_path_length_by_hand():
    nodes = np.array([[0, 5.0, 1, 2, 4], [-1, 0, -1, -1, 1], [-1, 0, -1, -1, 3]])
    depth = forest._path_length(np.array([[1.0], [9.0]]), nodes)
    assert depth[0] == 1.0
    assert depth[1] == pytest.approx(1 + 2 * (np.log(2) + forest.EULER) - 4 / 3)


def test_replays_read_a_step_in_bounded_batches(spark, tmp_path, monkeypatch):
    """Batches do not grow with the table, and late logs are lost as with one batch a step."""
    sf = str(tmp_path / "sf")
    rows = [(None if i == 5 else i, i % 40, "view") for i in range(8000) for _ in range(1 + (i % 800 == 0))]
    events = spark.createDataFrame(rows, "event_id long, user_id long, event_type string")
    events.write.parquet(f"{sf}/events.parquet")

    def read():
        seen = []
        plain = Q.run.wait

        def watched(queries, *args):
            plain(queries, *args)
            seen.extend(p["numInputRows"] for q in queries for p in q.recentProgress if p["numInputRows"])

        monkeypatch.setattr(Q.run, "wait", watched)
        rows = sorted(map(str, Q.stream_late(spark, sf).collect()))
        monkeypatch.setattr(Q.run, "wait", plain)
        return seen, rows

    seen, whole = read()
    assert len(seen) == Q.REPLAYS and sum(seen) == 7925  # every 97th has no source
    monkeypatch.setattr(Q, "BATCH_LOGS", 900)
    seen, parts = read()
    assert sum(seen) == 7925 and max(seen) < 1800 and len(seen) >= 8
    assert parts == whole and len(whole) > 10


def test_balanced_pieces():
    assert Q.balanced([], 10) == [(0, 0)]
    assert Q.balanced([(3, 5), (4, 5), (5, 5), (6, 5)], 10) == [(3, 4), (5, 6)]
    assert Q.balanced([(0, 90), (1, 1), (2, 1)], 10) == [(0, 0), (1, 2)]
