"""Lookups on frames of any columns, in one scan or by shuffled joins."""

import ipaddress
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from logweir.operators import lookup, outliers

SCHEMA = (
    "id long, source_ip string, destination_ip string, headers map<string, binary>, "
    "nested struct<a: array<map<string, int>>>, `dotted.name` int"
)


@pytest.fixture(scope="module")
def logs(spark):
    rows = [
        (i, None if i % 3 == 0 else f"10.0.0.{i % 5}", "8.8.8.8", {"k": bytes([i % 256])}, ([{"x": i}],), i)
        for i in range(60)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_frames_with_maps(spark, logs):
    assets = spark.createDataFrame([("10.0.0.1", "me"), ("10.0.0.2", "you")], "source_ip string, owner string")
    found = lookup.join_assets(logs, assets)
    assert found.columns == [*logs.columns, "owner"]
    rows = {r["id"]: r for r in found.collect()}
    assert len(rows) == 60
    for i, r in rows.items():
        assert r["owner"] == ({1: "me", 2: "you"}.get(i % 5) if i % 3 else None)
        assert r["headers"] == {"k": bytes([i % 256])} and r["nested"]["a"] == [{"x": i}]
    threats = spark.createDataFrame([("10.0.0.3",), (None,)], "ip string")
    flagged = lookup.flag_threats(logs, threats)
    assert {r["id"] for r in flagged.filter("is_threat").collect()} == {i for i in range(60) if i % 3 and i % 5 == 3}


def test_rows_without_an_address_are_spread(spark, logs):
    spread = logs.filter("source_ip is null").select(F.xxhash64(*lookup._hashable(logs)).alias("h"))
    assert spread.distinct().count() == 20


RANGES = [
    ("10.0.0.0/8", "eight"), ("10.0.0.0/24", "twenty-four"), ("10.0.0.2/32", "one"), ("10.0.1.0/24", None),
    ("0.0.0.0/0", "any"), ("bad", "x"), ("10.0.0.0/40", "x"), ("10.0.0.0/24", "zz"), (None, "x"), ("172.16.0.0/12", "b"),
]


def brute(ip, ranges):
    try:
        address = ipaddress.ip_address(ip)
    except ValueError:
        return None
    best = (-1, None)
    for cidr, location in ranges:
        try:
            net = ipaddress.ip_network(cidr, strict=False)
        except (ValueError, TypeError):
            continue
        if address in net and (net.prefixlen > best[0] or net.prefixlen == best[0] and location and location < (best[1] or "~")):
            best = (net.prefixlen, location)
    return best[1]


@pytest.mark.parametrize("most", [lookup.NETWORKS, 3])
def test_locations_in_one_scan_and_by_joins(spark, most):
    rng = random.Random(2)
    ips = [f"10.{rng.choice([0, 0, 1])}.{rng.randrange(3)}.{rng.randrange(4)}" for _ in range(150)]
    ips += ["172.17.0.1", "9.9.9.9", None, "not an address", "", "10.0.0.2"]
    logs = spark.createDataFrame([(i, ip, {"k": b"v"}) for i, ip in enumerate(ips)], "id long, source_ip string, headers map<string, binary>")
    # A range without a location has none in the joined form either, but hides shorter ones.
    ranges = [r for r in RANGES if r[1] is not None] if most == 3 else RANGES
    found = lookup.join_geo(logs, spark.createDataFrame(ranges, "cidr string, location string"), most)
    assert found.columns == [*logs.columns, "location"]
    assert {r["id"]: r["location"] for r in found.collect()} == {
        i: brute(ip, ranges) if ip else None for i, ip in enumerate(ips)
    }


def test_one_scan_of_the_logs(spark, tmp_path):
    logs = spark.createDataFrame([(1, "10.0.0.1")], "id long, source_ip string")
    logs.write.parquet(str(tmp_path / "logs"))
    stored = spark.read.parquet(str(tmp_path / "logs"))
    found = lookup.join_geo(stored, spark.createDataFrame(RANGES, "cidr string, location string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_no_ranges(spark):
    logs = spark.createDataFrame([(1, "10.0.0.1"), (2, None)], "id long, source_ip string")
    none = spark.createDataFrame([], "cidr string, location string")
    assert [r["location"] for r in lookup.join_geo(logs, none).collect()] == [None, None]


def test_empty_hours_count_nothing(spark):
    """Ten hours a day for three days: the trend of the calendar spans the silence."""
    start = datetime(2024, 1, 1)
    rows = [
        (start + timedelta(days=d, hours=h, minutes=m), k)
        for d in range(3)
        for h in range(10)
        for k, n in (("a", 2), (None, 1))
        for m in range(n)
    ]
    logs = spark.createDataFrame(rows, "timestamp timestamp, traffic_direction string")
    found = outliers.seasonal_residual(logs, rows=4, empty_hours=True)
    series = {}
    for r in found.orderBy("hour").collect():
        series.setdefault(r["traffic_direction"], []).append(r)
    assert {k: len(v) for k, v in series.items()} == {"a": 58, None: 58}  # the first hour to the last
    counts = [r["log_count"] for r in series["a"]]
    assert counts == ([2] * 10 + [0] * 14) * 2 + [2] * 10
    for k, r in enumerate(series["a"]):
        part = counts[max(k - 2, 0) : k + 2]
        assert r["trend"] == pytest.approx(sum(part) / len(part))
    plain = outliers.seasonal_residual(logs, rows=4)
    assert plain.count() == 60 and plain.filter("log_count = 0").count() == 0
    assert {r["trend"] for r in plain.filter("traffic_direction = 'a'").collect()} == {2.0}
    assert outliers.seasonal_residual(logs.limit(0), empty_hours=True).count() == 0
