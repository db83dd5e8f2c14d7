"""Assembly of the streaming queries."""

from __future__ import annotations

import time
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from logweir.operators import alerts as A
from logweir.operators import anomaly, records
from logweir.operators.metrics import derive
from logweir.schema import SIMPLE_LOG
from logweir.settings import Thresholds, WindowSpec
from logweir.streaming import metrics as M
from logweir.streaming import sinks


def verdict_stream(
    logs: DataFrame,
    spec: WindowSpec = WindowSpec(),
    thresholds: Thresholds = Thresholds(),
    mode: str = "update",
    now: Column | datetime | None = None,
    approximate: bool = False,
) -> DataFrame:
    """Parsed logs to the verdict on each window that changed, for the alert store."""
    measured = M.log_metrics(sinks.observe_logs(logs), spec, thresholds, mode, approximate)
    found = sinks.observe_anomalies(anomaly.detect(measured, thresholds, now))
    return sinks.observe_alerts(A.verdicts(found))


def start_streams(
    queue: DataFrame,
    checkpoint: str,
    output: str,
    spec: WindowSpec = WindowSpec(),
    thresholds: Thresholds = Thresholds(),
    store_metrics: bool = True,
    console: bool = False,
    alert_mode: str = "append",
    available_now: bool = False,
    approximate: bool = False,
    now: Column | datetime | None = None,
    name: str = "",
    rejects: bool = False,
    publish: sinks.Writer | None = None,
) -> list[StreamingQuery]:
    """Start the queries of a pipeline; ``name`` goes before their names.

    ``alert_mode="append"`` alerts once, when a window is closed, and one query scans the
    source for metrics and alerts. ``"update"`` alerts while a window is open and again when
    it changes, and stores its metrics when it is closed; one query scans the source once, and
    its batch function keeps the panes of open windows. (With ``approximate`` the counts are sketches
    that only Spark's state can hold, and metrics need a query of their own.) ``rejects`` stores unreadable records; ``publish`` gets metrics and alerts as records
    for the queue (append mode with metrics).
    """
    if publish is not None and not (alert_mode == "append" and store_metrics):
        raise ValueError("records are published by the query that stores metrics in append mode")
    logs = records.parse(queue, M.LOG_INPUT)
    if alert_mode == "append" and store_metrics:

        def judge(metrics: DataFrame) -> DataFrame:
            return A.verdicts(anomaly.detect(metrics, thresholds, now))

        measured = M.log_metrics(sinks.observe_logs(logs), spec, thresholds, "append", approximate)
        found = sinks.observe_anomalies(anomaly.detect(measured, thresholds, now))
        counted = sinks.observe_alerts(found).select(measured.columns)
        write = sinks.metrics_and_alerts_writer(output, judge, publish)
        writers = [
            sinks.batch_sink(
                counted, write, f"{checkpoint}/both", f"{name}both", "append", available_now=available_now
            )
        ]
    elif alert_mode == "update" and not approximate:
        def judged(measures: DataFrame) -> DataFrame:
            return A.verdicts(anomaly.detect(derive(measures, spec, thresholds), thresholds, now))

        def closed(measures: DataFrame) -> DataFrame:
            return derive(measures, spec, thresholds)

        write = sinks.open_windows_writer(output, judged, closed if store_metrics else None, spec)
        writers = [
            sinks.batch_sink(
                sinks.observe_logs(logs), write, f"{checkpoint}/alerts", f"{name}alerts", "update",
                available_now=available_now,
            )
        ]
    else:
        found = verdict_stream(logs, spec, thresholds, alert_mode, now, approximate)
        writers = [
            sinks.alerts_sink(
                found, output, f"{checkpoint}/alerts", alert_mode, available_now, f"{name}alerts", spec.watermark
            )
        ]
        if store_metrics:
            measured = M.log_metrics(logs, spec, thresholds, "append", approximate)
            writers.append(
                sinks.metrics_sink(
                    measured, f"{output}/metrics", f"{checkpoint}/metrics", available_now, name=f"{name}metrics"
                )
            )
    if console:
        shown = A.raised(A.verdicts(anomaly.detect(M.log_metrics(logs, spec, thresholds, alert_mode, approximate), thresholds, now)))
        writers.append(sinks.console_sink(shown, f"{checkpoint}/console", alert_mode, available_now, f"{name}console"))
    if rejects:
        bad = records.parse_rejects(queue)
        writers.append(
            sinks.rejects_sink(bad, f"{output}/rejects", f"{checkpoint}/rejects", available_now, f"{name}rejects")
        )
    return [writer.start() for writer in writers]


def simple_alert_stream(queue: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """The one-topic variant: parsed simple records to anomalous windows."""
    return anomaly.simple_anomalies(M.simple_metrics(records.parse(queue, SIMPLE_LOG)), thresholds)


def start_simple_stream(
    queue: DataFrame,
    checkpoint: str,
    output: str,
    thresholds: Thresholds = Thresholds(),
    available_now: bool = False,
    name: str = "",
) -> StreamingQuery:
    """The one-topic variant with its actions, each closed window once."""
    write = sinks.alert_writer(output, A.simple_actions)
    found = simple_alert_stream(queue, thresholds)
    return sinks.batch_sink(
        found, write, checkpoint, f"{name}simple", "append", sinks.SIMPLE_TRIGGER, available_now
    ).start()


def wait(queries: Sequence[StreamingQuery], counters: sinks.CounterTable | None = None) -> None:
    """Until all queries have ended; the first failure of any of them is raised at once.

    ``counters`` are flushed about once a minute.
    """
    waiting = list(queries)
    turns = 0
    while waiting:
        for query in list(waiting):
            if query.awaitTermination(1):
                waiting.remove(query)
        turns += 1
        if counters is not None and turns % 60 == 0:
            counters.flush()


def stop(queries: Sequence[StreamingQuery]) -> None:
    """At once: a batch in flight is broken off and done again after a restart."""
    for query in queries:
        query.stop()


def drain(queries: Sequence[StreamingQuery], seconds: float = 600.0) -> None:
    """Let every query end the batch in flight, with its commit, and stop it before the next.

    A query that writes by a batch function refuses its next batch, however closely batches
    follow each other; any query is stopped when no batch is running. What is not done within
    ``seconds`` is stopped at once. The batch that was refused is the first after a restart.
    """
    waiting = list(queries)
    end = time.monotonic() + seconds
    sinks.draining.update(q.id for q in waiting)
    try:
        while waiting and time.monotonic() < end:
            for query in list(waiting):
                if not query.isActive:
                    waiting.remove(query)
                    failure = query.exception()
                    if failure is not None and sinks.Drained.__name__ not in str(failure):
                        raise failure
                elif not query.status["isTriggerActive"]:
                    query.stop()
            time.sleep(0.05)
        stop(waiting)
    finally:
        sinks.draining.difference_update(q.id for q in queries)
