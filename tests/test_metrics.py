"""Window metrics, anomaly scores, alerts."""

import itertools
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from logweir.operators import alerts as A
from logweir.operators import anomaly, metrics
from logweir.settings import DECLARED_LEVELS, Thresholds, WindowSpec

START = datetime(2024, 1, 15, 10, 0, tzinfo=timezone.utc)
SCHEMA = (
    "timestamp timestamp, source_ip string, destination_ip string, destination_port int, severity string, "
    "traffic_direction string, bytes_sent bigint, bytes_received bigint, response_time_ms double, "
    "connection_status string, risk_score double"
)


def random_logs(spark, n, seed, start=START, span=7200):
    """A third of the rows and more belong to one source."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        rows.append(
            (
                rng.choice([None, start + timedelta(seconds=rng.randrange(span))] + [start + timedelta(seconds=rng.randrange(span))] * 20),
                rng.choice(["hot", "hot", "hot", "a", "b", None]),
                rng.choice(["d%d" % rng.randrange(9), None]),
                rng.choice([rng.randrange(5), None]),
                rng.choice(["INFO", None]),
                rng.choice(["internal", "external"]),
                rng.choice([rng.randrange(1000), None]),
                rng.randrange(1000),
                rng.choice([float(rng.randrange(1000)), None]),
                rng.choice(["FAILED", "SUCCESS", None]),
                rng.choice([0.25, 0.5, None]),
            )
        )
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize(
    "spec",
    [WindowSpec(), WindowSpec(60, 60), WindowSpec(1800, 60), WindowSpec(120, 7), WindowSpec(600, 10), WindowSpec(90, 30)],
)
@pytest.mark.parametrize("start", [START, datetime(1969, 12, 31, 23, 30, tzinfo=timezone.utc)])
def test_panes_equal_plain_windows(spark, spec, start):
    """Also over the ends of a stretch of bits and before the epoch."""
    logs = random_logs(spark, 400, spec.duration + spec.slide, start).cache()
    plain = metrics._by_window(logs, spec, metrics.KEYS, metrics.MEASURES).select(
        *metrics.finished(metrics.KEYS, metrics.MEASURES)
    )
    fast = metrics.window_metrics(logs, spec)
    assert fast.columns == plain.columns
    assert fast.dtypes == plain.dtypes
    key = str
    assert sorted(fast.collect(), key=key) == sorted(plain.collect(), key=key)


def test_brute_force(spark):
    logs = random_logs(spark, 300, 7, span=1200)
    rows = [r for r in logs.collect() if r.timestamp is not None]
    expected = {}
    for r in rows:
        minute = int(r.timestamp.replace(tzinfo=timezone.utc).timestamp()) // 60
        for w in range(minute - 4, minute + 1):
            expected.setdefault((w * 60, r.source_ip, r.traffic_direction, r.severity), []).append(r)
    found = metrics.window_metrics(logs).withColumn("start", F.unix_timestamp("window.start")).collect()
    assert len(found) == len(expected)
    for row in found:
        group = expected[(row.start, row.source_ip, row.traffic_direction, row.severity)]
        assert row.log_count == len(group)
        assert row.unique_destinations == len({r.destination_ip for r in group} - {None})
        assert row.unique_ports == len({r.destination_port for r in group} - {None})
        assert row.failed_connections == sum(r.connection_status == "FAILED" for r in group)
        times = [r.response_time_ms for r in group if r.response_time_ms is not None]
        assert row.avg_response_time == (sum(times) / len(times) if times else None)
        assert row.max_response_time == (max(times) if times else None)
        sent = [r.bytes_sent for r in group if r.bytes_sent is not None]
        assert row.total_bytes_sent == (sum(sent) if sent else None)


def test_raw_rows_are_grouped_once(spark):
    """Raw rows meet no window expansion: the distinct step shuffles bits, not copies."""
    logs = random_logs(spark, 10, 1)
    plan = metrics.window_metrics(logs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "Join" not in plan
    assert plan.count("Aggregate [") == 2


def test_simple_metrics(spark):
    rows = [(START + timedelta(seconds=s), "a", float(s)) for s in (0, 30, 90)]
    logs = spark.createDataFrame(rows, "timestamp timestamp, source_ip string, response_time double")
    out = metrics.simple_metrics(logs).orderBy("window").collect()
    assert [r.log_count for r in out] == [2, 3, 3, 3, 3, 1]
    assert out[0].avg_response_time == 15.0 and out[1].max_response_time == 90.0


METRIC = (
    "window struct<start:timestamp,end:timestamp>, source_ip string, traffic_direction string, severity string, "
    "log_count bigint, avg_response_time double, failure_rate double, total_bytes_sent bigint, "
    "unique_destinations bigint, unique_ports bigint, max_risk_score double"
)


def metric(spark, *rows):
    window = (START, START + timedelta(minutes=5))
    return spark.createDataFrame([(window, *r) for r in rows], METRIC)


def combination(flags, source="s"):
    volume, latency, failure, bytes_sent, ports, risk = flags
    return (
        source, "outbound", "INFO",
        1001 if volume else 1000,
        5000.5 if latency else 5000.0,
        0.11 if failure else 0.1,
        10485761 if bytes_sent else 10485760,
        1,
        51 if ports else 50,
        1.0 if risk else 0.8,
    )


def test_all_64_scores(spark):
    combos = list(itertools.product([False, True], repeat=6))
    rows = anomaly.detect(metric(spark, *[combination(c, str(i)) for i, c in enumerate(combos)])).collect()
    for row in rows:
        flags = combos[int(row.source_ip)]
        assert tuple(row[name] for name in anomaly.FLAGS) == flags
        score = 0.0
        for on, weight in zip(flags, (0.2, 0.15, 0.25, 0.3, 0.05, 0.05)):
            score = score + int(on) * weight
        assert row.anomaly_score == score
        assert row.is_anomaly == (score > 0.3)
        level = "CRITICAL" if score > 0.7 else "HIGH" if score > 0.5 else "MEDIUM" if score > 0.3 else "LOW"
        assert row.anomaly_level == level


def test_one_combination_is_above_its_decimal_sum(spark):
    row = anomaly.detect(metric(spark, combination((1, 1, 1, 0, 1, 1)))).first()
    assert row.anomaly_score == 0.7000000000000001 and row.anomaly_level == "CRITICAL"
    row = anomaly.detect(metric(spark, combination((0, 0, 0, 1, 0, 0)))).first()
    assert (row.is_anomaly, row.anomaly_level) == (False, "LOW")


def test_null_metric_is_no_anomaly(spark):
    row = list(combination((1, 1, 1, 1, 1, 1)))
    row[4] = None
    found = anomaly.detect(metric(spark, tuple(row)))
    first = found.first()
    assert (first.anomaly_score, first.is_anomaly, first.anomaly_level) == (None, None, "LOW")
    assert A.alerts(found).count() == 0


def test_thresholds_are_parameters(spark):
    t = Thresholds(unique_ports=10, levels=DECLARED_LEVELS)
    row = anomaly.detect(metric(spark, combination((1, 1, 1, 0, 0, 0))), t).first()
    assert row.port_scanning_anomaly and row.anomaly_level == "MEDIUM"


def test_alert_row(spark):
    found = anomaly.detect(metric(spark, combination((1, 1, 1, 1, 0, 0)), combination((0,) * 6)), now=START)
    (row,) = A.alerts(found).collect()
    assert row.alert_message == "Network anomaly detected from s - Level: CRITICAL - Score: 0.8999999999999999"
    assert A.alerts(found).columns[:6] == [
        "window_start", "window_end", "source_ip", "traffic_direction", "severity", "log_count"
    ]
    assert len(row) == 22
    again = A.alerts(found).first()
    assert row.alert_id == again.alert_id and len(row.alert_id) == 64


def test_null_source_has_id_but_no_message(spark):
    row = A.alerts(anomaly.detect(metric(spark, combination((1,) * 6, None)))).first()
    assert row.alert_message is None and row.alert_id is not None


def test_actions_and_channels(spark):
    found = anomaly.detect(
        metric(spark, combination((1, 1, 1, 1, 1, 1), "c"), combination((0, 0, 1, 1, 0, 0), "h")), now=START
    )
    alerts = A.alerts(found)
    names = {r.alert_id: r.source_ip for r in alerts.collect()}
    acts = sorted((names[r.alert_id], r.action) for r in A.actions(alerts).collect())
    assert acts == [
        ("c", "autoscale"), ("c", "dashboard"), ("c", "notification"), ("h", "dashboard"), ("h", "notification")
    ]
    assert {r.channel for r in A.channels(alerts).collect()} == {"log"}
    critical = alerts.withColumn("severity", F.lit("CRITICAL"))
    assert [r.channel for r in A.channels(critical.limit(1)).collect()] == ["log", "email", "slack", "sms", "autoscale"]
    trace = alerts.withColumn("severity", F.lit("TRACE")).limit(1)
    assert [r.channel for r in A.channels(trace).collect()] == ["log"]


def test_simple_actions(spark):
    rows = metric(spark, ("a", "x", "INFO", 5000, 1.0, 0.0, 0, 0, 0, 0.0), ("b", "x", "INFO", 5001, 1.0, 0.0, 0, 0, 0, 0.0))
    acts = sorted((r.source_ip, r.action) for r in A.simple_actions(rows).collect())
    assert acts == [("a", "dashboard"), ("b", "autoscale"), ("b", "dashboard")]


def test_latest_verdict_wins(spark):
    """By the time it was written, then by batch; one that is no anomaly ends its alert."""
    rows = [("x", 1, 1, "LOW", True), ("x", 1, 10, "HIGH", True), ("x", 1, 9, "MEDIUM", True), ("y", 2, 0, "LOW", True)]
    rows += [("y", 1, 7, "HIGH", True), ("z", 1, 1, "LOW", True), ("z", 2, 0, None, False), (None, 1, 1, "LOW", False)]
    history = spark.createDataFrame(
        rows, "alert_id string, written_at int, batch_id int, anomaly_level string, is_anomaly boolean"
    )
    assert sorted(tuple(r) for r in A.latest(history).collect()) == [("x", 1, 10, "HIGH"), ("y", 2, 0, "LOW")]


def test_a_null_key_has_an_id_of_its_own(spark):
    rows = metric(spark, (None, "x", "INFO", 5000, 9e9, 1.0, 10**9, 0, 0, 0.0), ("-", "x", "INFO", 5000, 9e9, 1.0, 10**9, 0, 0, 0.0))
    found = A.alerts(anomaly.detect(rows)).collect()
    assert len({r.alert_id for r in found}) == len(found) == 2
