"""Streams: replay equals batch, late logs, restarts, sinks."""

import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from logweir.operators import anomaly, metrics, quality, records
from logweir.plans import queries as Q
from logweir.schema import QUEUE
from logweir.sources import queue
from logweir.streaming import metrics as stream
from logweir.streaming import run, sinks

DAY = datetime(2024, 1, 15, tzinfo=timezone.utc)


def add_file(folder, n, df):
    """One Parquet file, older files first in the source's order."""
    os.makedirs(folder, exist_ok=True)
    path = f"{folder}/part-{n:03d}.parquet"
    df.toPandas().to_parquet(path, coerce_timestamps="us", index=False)
    os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))


def queue_of(spark, rows):
    """(time, source, port, status) as queue records."""
    out = []
    for i, (time, source, port, status) in enumerate(rows):
        value = {
            "timestamp": time.isoformat(), "source_ip": source, "destination_ip": "d", "destination_port": port,
            "severity": "INFO", "traffic_direction": "internal", "bytes_sent": 1, "bytes_received": 1,
            "response_time_ms": 1.0, "connection_status": status, "risk_score": 0.0,
        }
        out.append(("t", 0, i, DAY, "k", json.dumps(value)))
    return spark.createDataFrame(out, QUEUE)


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Test events over 25 minutes as four queue files in time order, and their logs."""
    folder = str(tmp_path_factory.mktemp("queue"))
    logs = Q.raw_logs(spark, "/root/testdata/sf0.001")
    logs = logs.withColumn("timestamp", F.timestamp_micros(F.unix_micros("timestamp") + F.col("event_id") * 1_440_000))
    whole = Q.queue(logs).drop("headers").withColumn("value", F.col("value").cast("string")).cache()
    for n in range(4):
        add_file(folder, n, whole.filter((F.col("event_id") / 250).cast("int") == n).drop("event_id"))
    return folder, records.parse(whole).cache()


def once(writer):
    query = writer.trigger(availableNow=True).start()
    run.wait([query])
    return query


def rows_of(df):
    names = ("avg_response_time", "avg_risk_score", "failure_rate", "bytes_per_second")
    return sorted(map(str, Q.rounded(Q.flat(df), *[n for n in names if n in df.columns]).collect()))


def closed(df, logs, seconds=120):
    last = logs.agg(F.max("timestamp")).first()[0]
    return df.filter(F.col("window.end") <= F.lit(last - timedelta(seconds=seconds)))


def test_append_replay_equals_batch(spark, files, tmp_path):
    folder, logs = files
    measured = stream.log_metrics(records.parse(queue.file_stream(spark, folder, 1), stream.LOG_INPUT))
    query = once(sinks.metrics_sink(measured, str(tmp_path / "out"), str(tmp_path / "cp")))
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == 4
    expected = closed(metrics.log_metrics(logs), logs)
    assert expected.count() > 1000
    assert rows_of(spark.read.parquet(str(tmp_path / "out")).select(*expected.columns)) == rows_of(expected)


def test_update_replay_ends_at_batch(spark, files, tmp_path):
    """All windows, open ones too: the last state of each equals the batch."""
    folder, logs = files
    measured = stream.log_metrics(records.parse(queue.file_stream(spark, folder, 1), stream.LOG_INPUT), mode="update")
    states = str(tmp_path / "states")

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{states}/batch_id={batch_id}")

    once(measured.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "cp")))
    history = spark.read.parquet(states)
    keys = ["window", *metrics.KEYS]
    rest = [c for c in history.columns if c not in keys]
    last = history.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("last")).select(*keys, "last.*")
    expected = metrics.log_metrics(logs)
    assert history.count() > last.count()
    assert rows_of(last.select(*expected.columns)) == rows_of(expected)


def test_approximate_counts_are_close(spark, files, tmp_path):
    folder, logs = files
    parsed = records.parse(queue.file_stream(spark, folder, 1), stream.LOG_INPUT)
    measured = stream.window_metrics(parsed, approximate=True)
    once(sinks.metrics_sink(measured, str(tmp_path / "out"), str(tmp_path / "cp")))
    keys = ["window", *metrics.KEYS]
    exact = closed(metrics.window_metrics(logs), logs).select(*keys, F.col("unique_destinations").alias("exact"))
    both = spark.read.parquet(str(tmp_path / "out")).join(exact.na.fill("-"), keys)
    assert both.count() > 500
    assert both.filter(F.abs(F.col("unique_destinations") - F.col("exact")) > 0.2 * F.col("exact") + 1).count() == 0


LATE_FILES = (
    [(timedelta(), 1), (timedelta(minutes=20), 1)],
    [(timedelta(seconds=30), 2), (timedelta(minutes=21), 2), (timedelta(minutes=16, seconds=30), 2)],
)


def late_runs(spark, folder, start):
    """One run per file: each ends with the batch that moves the watermark on."""
    for n, rows in enumerate(LATE_FILES):
        add_file(folder, n, queue_of(spark, [(DAY + t, "a", port, "OK") for t, port in rows]))
        start(records.parse(queue.file_stream(spark, folder, 1), stream.LOG_INPUT))


def minutes(df, *columns):
    start = (F.unix_seconds("window.start") - int(DAY.timestamp())) / 60
    return sorted(tuple(r) for r in df.select(start.cast("int"), *columns).collect())


def test_late_logs_are_cut_per_window(spark, tmp_path):
    """Watermark 00:18: the log of 00:00:30 is too late for all its windows, the one
    of 00:16:30 only for those that end by then."""

    def start(logs):
        measured = stream.window_metrics(logs)
        once(sinks.metrics_sink(measured, str(tmp_path / "out"), str(tmp_path / "cp"), partitioned=True))

    late_runs(spark, str(tmp_path / "q"), start)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.year, r.month, r.day, r.hour) for r in out.collect()} == {(2024, 1, 14, 23), (2024, 1, 15, 0)}
    assert minutes(out, "log_count", "unique_ports") == [(m, 1, 1) for m in (-4, -3, -2, -1, 0, 14)]


def test_late_logs_in_update_mode(spark, tmp_path):
    runs = []

    def keep(batch, batch_id):
        runs[-1].extend(minutes(batch, "log_count", "unique_ports"))

    def start(logs):
        runs.append([])
        measured = stream.window_metrics(logs, mode="update")
        once(measured.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", str(tmp_path / "cp")))

    late_runs(spark, str(tmp_path / "q"), start)
    assert sorted(runs[0]) == [(m, 1, 1) for m in (-4, -3, -2, -1, 0, 16, 17, 18, 19, 20)]
    # New are [00:14, 00:19), [00:15, 00:20) and [00:21, 00:26); [00:16, 00:21) got
    # the log of 00:16:30; the rest, still open, hold both ports.
    assert sorted(runs[1]) == [
        (14, 1, 1), (15, 1, 1), (16, 2, 2), (17, 2, 2), (18, 2, 2), (19, 2, 2), (20, 2, 2), (21, 1, 1)
    ]


def scan_rows(minute, n):
    """A burst that scans ports, fails and moves nothing else."""
    return [(DAY + timedelta(minutes=minute, seconds=i % 60), "scanner", 1000 + i, "FAILED") for i in range(n)]


def alert_run(spark, folder, out, cp):
    found = run.verdict_stream(records.parse(queue.file_stream(spark, folder, 1), stream.LOG_INPUT))
    run.wait([sinks.alerts_sink(found, out, cp, available_now=True).start()])


def counts_by_minute(alerts):
    return minutes(alerts.withColumn("window", F.struct(F.col("window_start").alias("start"))), "log_count")


def test_alerts_survive_restart_and_retry(spark, tmp_path):
    """More logs for a window raise its alert again; the store keeps one last state."""
    folder, out, cp = (str(tmp_path / x) for x in ("q", "out", "cp"))
    add_file(folder, 0, queue_of(spark, scan_rows(0, 1100)))
    alert_run(spark, folder, out, cp)
    assert sinks.stored_alerts(spark, out).count() == 5
    add_file(folder, 1, queue_of(spark, scan_rows(1, 1200)))
    alert_run(spark, folder, out, cp)
    history, latest = sinks.stored_alerts(spark, out), sinks.latest_alerts(spark, out)
    assert history.count() == 5 + 5
    assert latest.count() == 6
    assert counts_by_minute(latest) == [(-4, 1100), (-3, 2300), (-2, 2300), (-1, 2300), (0, 2300), (1, 1200)]
    assert sinks.latest_alerts(spark, out, F.lit(DAY)).count() == 2
    alert_run(spark, folder, out, cp)
    assert sinks.stored_alerts(spark, out).count() == 10

    # A batch that is written twice, as after a lost driver, counts once.
    again = history.filter("batch_id = 0").drop("run", "batch_id", "day", "written_at")
    kept = spark.createDataFrame(again.collect(), again.schema)
    for _ in range(2):
        sinks.alert_writer(f"{out}-again")(kept, 0)
    assert sinks.stored_alerts(spark, f"{out}-again").count() == 5

    # An action is stored with each state of its alert and read once.
    assert spark.read.parquet(f"{out}/actions").count() > 12
    actions = sinks.stored_actions(spark, out)
    assert actions.count() == 12 == actions.select("alert_id", "action").distinct().count()


def test_alerts_that_no_longer_hold_end(spark, tmp_path):
    """A few failures of much data are an anomaly until many successes make them normal."""
    folder, out, cp = (str(tmp_path / x) for x in ("q", "out", "cp"))

    def sent(n, status, size, first=0):
        rows = queue_of(spark, [(DAY + timedelta(seconds=i % 60), "a", 80, status) for i in range(n)])
        value = F.regexp_replace("value", '"bytes_sent": 1,', f'"bytes_sent": {size},')
        return rows.withColumn("value", value).withColumn("offset", F.col("offset") + first)

    first, second = sent(10, "FAILED", 2_000_000), sent(900, "OK", 1, 10)
    add_file(folder, 0, first)
    alert_run(spark, folder, out, cp)
    assert sinks.latest_alerts(spark, out).count() == 5
    add_file(folder, 1, second)
    alert_run(spark, folder, out, cp)
    logs = records.parse(first.union(second), stream.LOG_INPUT)
    batch = anomaly.detect(metrics.log_metrics(logs)).filter("is_anomaly").count()
    assert batch == sinks.latest_alerts(spark, out).count() == 0
    assert sinks.stored_alerts(spark, out).count() == 10


def test_new_checkpoint_on_the_same_output(spark, tmp_path):
    """Batch numbers begin anew; older batches stay and newer states win."""
    out = str(tmp_path / "out")
    for n, size in ((1, 1100), (2, 1300)):
        folder = str(tmp_path / f"q{n}")
        add_file(folder, 0, queue_of(spark, scan_rows(0, size)))
        alert_run(spark, folder, out, str(tmp_path / f"cp{n}"))
    assert sinks.stored_alerts(spark, out).count() == 10
    assert counts_by_minute(sinks.latest_alerts(spark, out)) == [(m, 1300) for m in (-4, -3, -2, -1, 0)]


def test_start_streams(spark, files, tmp_path):
    folder, logs = files
    source = queue.file_stream(spark, folder)
    windows = closed(metrics.log_metrics(logs), logs)
    found = anomaly.detect(windows, now=DAY)
    alerts = found.filter("is_anomaly").count()

    # By default alerts of closed windows share one query with the metrics.
    out = str(tmp_path / "out")
    both = run.start_streams(
        source, str(tmp_path / "cp"), out, console=True, available_now=True, now=DAY, name="x-", rejects=True,
        publish=sinks.record_writer(f"{out}/records"),
    )
    # Another pipeline in the same session.
    two = run.start_streams(
        source, str(tmp_path / "cp2"), str(tmp_path / "out2"), alert_mode="update", available_now=True, name="y-"
    )
    assert [q.name for q in both + two] == ["x-both", "x-console", "x-rejects", "y-alerts"]
    run.wait(both + two)
    run.stop(both + two)
    latest = sinks.latest_alerts(spark, out)
    assert latest.count() == alerts > 0
    assert {r.detected_at.replace(tzinfo=timezone.utc) for r in latest.collect()} == {DAY}
    stored = spark.read.parquet(f"{out}/metrics").select(*windows.columns)
    assert rows_of(stored) == rows_of(windows)
    published = spark.read.parquet(f"{out}/records").groupBy("topic").count().collect()
    assert {r.topic: r["count"] for r in published} == {
        records.METRICS_TOPIC: windows.count(), records.ALERTS_TOPIC: alerts
    }
    assert sinks.latest_alerts(spark, str(tmp_path / "out2")).count() >= alerts
    stored = spark.read.parquet(str(tmp_path / "out2/metrics")).select(*windows.columns)
    assert rows_of(stored) == rows_of(windows)
    with pytest.raises(ValueError, match="published"):
        run.start_streams(source, out, out, alert_mode="update", publish=sinks.record_writer(out))


def test_trigger_keeps_the_query_running(spark, tmp_path):
    """By interval a query stays active and takes new files; one file a batch is the rate limit."""
    folder = str(tmp_path / "q")
    for n in range(2):
        add_file(folder, n, queue_of(spark, [(DAY + timedelta(hours=n), "a", 1, "OK")]))
    logs = records.parse(queue.file_stream(spark, folder, 1), stream.LOG_INPUT)
    seen = []

    def count(batch, batch_id):
        seen.append(batch.count())

    query = sinks.batch_sink(logs, count, str(tmp_path / "cp"), "steady", "append", "1 second").start()
    try:
        query.processAllAvailable()
        add_file(folder, 2, queue_of(spark, [(DAY, "b", 1, "OK")] * 3))
        query.processAllAvailable()
        assert query.isActive and [n for n in seen if n] == [1, 1, 3]
    finally:
        query.stop()


def test_unreadable_records_are_kept(spark, tmp_path):
    folder, out = str(tmp_path / "q"), str(tmp_path / "out")
    rows = queue_of(spark, [(DAY, "a", 1, "OK")] * 3).withColumn(
        "value", F.when(F.col("offset") == 1, "not json").otherwise(F.col("value"))
    )
    add_file(folder, 0, rows)
    source = queue.file_stream(spark, folder)
    run.wait(run.start_streams(source, str(tmp_path / "cp"), out, available_now=True, name="r-", rejects=True))
    assert [(r.value, r.parse_reason) for r in spark.read.parquet(f"{out}/rejects").collect()] == [("not json", "not_json")]


def test_wait_raises_the_failure_of_any_query(spark, files, tmp_path):
    def fail(batch, batch_id):
        raise RuntimeError("sink is down")

    rows = queue.file_stream(spark, files[0])
    bad = rows.writeStream.foreachBatch(fail).option("checkpointLocation", str(tmp_path / "cp"))
    endless = rows.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp2"))
    started = [endless.trigger(processingTime="1 hour").start(), bad.trigger(availableNow=True).start()]
    try:
        with pytest.raises(Exception, match="sink is down"):
            run.wait(started)
    finally:
        run.stop(started)


def test_simple_alert_stream(spark, tmp_path):
    rows = [
        ("network-logs", 0, i, DAY, "a", json.dumps({"timestamp": (DAY + timedelta(seconds=s)).isoformat(), "source_ip": src, "response_time": t}))
        for i, (s, src, t) in enumerate([(0, "slow", 6000.0), (0, "fast", 10.0), (3600, "fast", 10.0)])
    ]
    add_file(str(tmp_path / "q"), 0, spark.createDataFrame(rows, QUEUE))
    source = queue.file_stream(spark, str(tmp_path / "q"))
    run.wait([run.start_simple_stream(source, str(tmp_path / "cp"), str(tmp_path / "out"), available_now=True)])
    out = spark.read.parquet(str(tmp_path / "out/alerts")).collect()
    assert len(out) == 5 and {r.source_ip for r in out} == {"slow"}
    actions = sinks.stored_actions(spark, str(tmp_path / "out"))
    assert {r.action for r in actions.collect()} == {"dashboard"} and actions.count() == 5


def test_failed_attempts_on_a_stream(spark, tmp_path):
    folder = str(tmp_path / "q")
    add_file(folder, 0, queue_of(spark, scan_rows(0, 150) + [(DAY, "calm", 1, "FAILED")] * 100))
    # Spark filters before it marks, so only failures move the watermark on.
    add_file(folder, 1, queue_of(spark, [(DAY + timedelta(hours=1), "other", 1, "FAILED")]))
    logs = records.parse(queue.file_stream(spark, folder, 1), stream.LOG_INPUT)
    found = quality.failed_attempts(logs, watermark=60)
    once(sinks.metrics_sink(found, str(tmp_path / "out"), str(tmp_path / "cp"), name="attempts"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.source_ip, r.failed_connections) for r in rows] == [("scanner", 150)]


@pytest.mark.parametrize("mode", ["append", "update"])
def test_counters(spark, tmp_path, mode):
    folder, table = str(tmp_path / "q"), str(tmp_path / "counters")
    add_file(folder, 0, queue_of(spark, scan_rows(0, 1100)))
    later = [(DAY + timedelta(hours=1), "other", 1, "OK")]
    add_file(folder, 1, queue_of(spark, later))
    counters = sinks.CounterTable(spark, table)
    spark.streams.addListener(counters)
    try:
        started = run.start_streams(
            queue.file_stream(spark, folder, 1), str(tmp_path / "cp"), str(tmp_path / "out"),
            store_metrics=mode == "append", alert_mode=mode, available_now=True, name=f"{mode}-",
        )
        run.wait(started, counters)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        counters.await_batches({str(q.runId): q.lastProgress["batchId"] for q in started})
    finally:
        spark.streams.removeListener(counters)
    counters.flush()
    counters.flush()
    rows = spark.read.parquet(table).collect()
    assert {r["query"] for r in rows} == {"append-both" if mode == "append" else "update-alerts"}
    assert [sum(r[n] for r in rows) for _, n in sinks.COUNTERS] == [1101, 5, 5]


def test_no_state_row_holds_a_set(spark, files):
    """Exact distinct counts on a stream must not collect values in one row."""
    logs = records.parse(queue.file_stream(spark, files[0]), stream.LOG_INPUT)
    for mode in ("append", "update"):
        plan = stream.window_metrics(logs, mode=mode)._jdf.queryExecution().analyzed().toString()
        assert "collect_set" not in plan and "collect_list" not in plan
