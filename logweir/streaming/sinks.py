"""Stream sinks: Parquet metrics, replay-safe alert batches, console, counters."""

from __future__ import annotations

import time
from collections import deque
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from logweir.operators import alerts as A
from logweir.operators import latency as L
from logweir.operators import records as R
from logweir.operators.metrics import KEYS, MEASURES, MICROS, finished
from logweir.operators.quality import PARTITIONS, with_partitions
from logweir.schema import ACTIONS, ALERTS, OPEN_ALERTS
from logweir.settings import WindowSpec
from logweir.sources import compaction
from logweir.streaming.metrics import merged_panes, pane_windows

# Trigger intervals.
ALERT_TRIGGER = "30 seconds"
METRICS_TRIGGER = "1 minute"
CONSOLE_TRIGGER = "30 seconds"
SIMPLE_TRIGGER = "10 seconds"


def triggered(writer: DataStreamWriter, interval: str, available_now: bool) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)


Writer = Callable[[DataFrame, int], None]


class Drained(Exception):
    """Ends a query that is to stop before it begins another batch."""


#: Ids of queries that end before their next batch (see ``run.drain``).
draining: set[str] = set()


def _query_id(batch: DataFrame) -> str | None:
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def _drained(write: Writer) -> Writer:
    """A batch in flight is written to its end; the next one writes nothing and stays to be done."""

    def unless_draining(batch: DataFrame, batch_id: int) -> None:
        if _query_id(batch) in draining:
            raise Drained(f"stopped before batch {batch_id}")
        write(batch, batch_id)

    return unless_draining


def _place(batch: DataFrame, batch_id: int) -> str:
    """A batch's folder. The query's id lies in the checkpoint: it is the same after a restart
    and another one with a new checkpoint, whose batch numbers begin anew."""
    return f"run={_query_id(batch) or 'batch'}/batch_id={batch_id}"


def _store(batch: DataFrame, folder: str, batch_id: int, day: Column | None = None) -> DataFrame:
    """A batch's rows in its own folder, read back. A batch that is run again
    replaces its folder and so adds nothing."""
    path = f"{folder}/{_place(batch, batch_id)}"
    rows = batch if day is None else batch.withColumn("day", F.to_date(day))
    writer = rows.hint("rebalance").write.mode("overwrite")
    (writer if day is None else writer.partitionBy("day")).parquet(path)
    return batch.sparkSession.read.schema(batch.schema).parquet(path)


def _read(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A store's rows; before its first file, no rows of the given schema."""
    try:
        return spark.read.option("basePath", folder).parquet(folder)
    except AnalysisException as missing:
        if missing.getCondition() not in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}:
            raise
        return spark.createDataFrame([], schema)


def _slot(batch: DataFrame, path: str, batch_id: int) -> str:
    """Where a batch leaves the open alerts: two places in turn, so the one before stays until
    the batch is done."""
    return f"{path}/open/{_place(batch, batch_id % 2).replace('batch_id', 'slot')}"


def _open_before(batch: DataFrame, path: str, batch_id: int) -> DataFrame:
    spark = batch.sparkSession
    if batch_id == 0:
        return spark.createDataFrame([], OPEN_ALERTS)
    rows = _read(spark, _slot(batch, path, batch_id - 1), OPEN_ALERTS).filter(F.col("batch") == batch_id - 1)
    return rows.filter(F.col("alert_id").isNotNull())


def _marked(rows: DataFrame, batch_id: int) -> DataFrame:
    """Rows a batch leaves, and one with nothing but its number: none may be open."""
    number = F.lit(batch_id).cast("bigint").alias("batch")
    return rows.withColumn("batch", number).unionByName(rows.sparkSession.range(1).select(number), allowMissingColumns=True)


def transitions(verdicts: DataFrame, opened: DataFrame) -> DataFrame:
    """Verdicts that raise, change or clear an alert, with their ``transition``.

    ``opened`` has the ``alert_id`` of every alert raised so far. A cleared alert keeps its id
    and the start of its window; a window that was normal and stays so has no row.
    """
    raised = opened.select(F.col("alert_id").alias("__id"), F.lit(True).alias("__raised"))
    met = verdicts.join(raised, F.col("alert_id") == F.col("__id"), "left").drop("__id")
    kind = (
        F.when(~F.col("is_anomaly"), A.CLEAR).when(F.col("__raised").isNull(), A.RAISE).otherwise(A.CHANGE)
    )
    kept = met.filter(F.col("is_anomaly") | F.col("__raised")).withColumn("transition", kind).drop("__raised")
    keys = ("alert_id", "is_anomaly", "transition", A.WINDOW_START)
    return kept.withColumns({c: F.when(F.col("is_anomaly"), F.col(c)) for c in kept.columns if c not in keys})


def alert_writer(
    path: str,
    act: Callable[[DataFrame], DataFrame] = A.actions,
    mode: str = "append",
    lateness: int = WindowSpec().watermark,
) -> Writer:
    """A batch function for verdicts and the actions of those that are alerts.

    In append mode every window comes once, so its alerts are stored as raised. In update mode
    the alerts raised in windows that are still open are kept beside the store, one small row
    each, and a verdict is stored only if it raises, changes or clears one; windows that never
    were anomalous leave nothing. An open alert goes when ``lateness`` seconds have passed its
    window, by the latest window seen: Spark's watermark lets no later row into it.

    Rows carry the time they were written, which orders them across checkpoints. Actions are
    made from the stored rows: the stream's plan runs once per batch, and no row passes the
    driver. A batch that is run again reads what the batch before it left and replaces its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        start = F.col(A.WINDOW_START) if A.WINDOW_START in batch.columns else F.col("window.start")
        if mode == "append":
            rows = batch.filter("is_anomaly") if "is_anomaly" in batch.columns else batch
            _stored(rows.withColumns({"is_anomaly": F.lit(True), "transition": F.lit(A.RAISE)}), start, batch_id)
            return
        verdicts = batch.persist()
        try:
            opened = _open_before(batch, path, batch_id)
            stored = _stored(transitions(verdicts, opened), start, batch_id)
            latest = verdicts.agg(F.max(A.WINDOW_START).alias("latest"))
            latest = F.lit(latest.first()["latest"]).cast("timestamp")
            # By what was seen before this batch: its own rows may still change such a window.
            closed = F.col(A.WINDOW_END) <= F.col("latest") - F.make_dt_interval(secs=F.lit(lateness))
            left = opened.filter(~closed).join(stored.select("alert_id"), "alert_id", "left_anti").drop("batch")
            made = stored.filter("is_anomaly").select("alert_id", A.WINDOW_END, latest.alias("latest"))
            still = left.unionByName(made).withColumn("latest", F.greatest("latest", latest))
            _marked(still, batch_id).hint("rebalance").write.mode("overwrite").parquet(_slot(batch, path, batch_id))
        finally:
            verdicts.unpersist()

    def _stored(rows: DataFrame, start: Column, batch_id: int) -> DataFrame:
        timed = rows.withColumn("written_at", F.current_timestamp())
        stored = _store(timed, f"{path}/alerts", batch_id, start)
        _store(act(A.raised(stored).drop("transition")), f"{path}/actions", batch_id)
        return stored

    return write


#: Alerts of a batch whose windows are judged by its batch function, by (query id, batch), until
#: the query's progress is heard; of each query the last KEPT_REPORTS are kept.
reported: dict[tuple[str | None, int], dict[str, int]] = {}
KEPT_REPORTS = 100


def _report(query: str | None, batch_id: int, alerts: int) -> None:
    reported[query, batch_id] = {"anomalies": alerts, "alerts": alerts}
    reported.pop((query, batch_id - KEPT_REPORTS), None)


def open_windows_writer(
    path: str,
    judge: Callable[[DataFrame], DataFrame],
    close: Callable[[DataFrame], DataFrame] | None = None,
    spec: WindowSpec = WindowSpec(),
    act: Callable[[DataFrame], DataFrame] = A.actions,
) -> Writer:
    """A batch function for parsed logs: alerts of open windows, metrics of closed ones.

    The panes of open windows (``metrics.merged_panes``) are kept beside the stores in two
    places in turn. A batch adds its logs to what the batch before left, judges the
    windows that changed (``judge``: measures to verdicts), stores the verdicts that raise,
    change or clear an alert, and, with ``close`` (measures to metrics), stores a window's metrics
    once, when it is closed: when ``spec.watermark`` seconds have passed its end, by the latest
    event time up to and with this batch. A later batch's logs count in no closed window. A batch
    that is run again reads the same place and replaces its own folders.
    """
    late, duration, slide = (n * MICROS for n in (spec.watermark, spec.duration, spec.slide))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        opened = None
        if batch_id:
            schema = merged_panes(None, batch, spec).schema.add("batch", "long")
            opened = spark.read.schema(schema).parquet(_slot(batch, f"{path}/panes", batch_id - 1))
            opened = opened.filter(F.col("batch") == batch_id - 1).drop("batch")
        rows = merged_panes(opened, batch, spec).persist()
        windows = None
        try:
            # The row without a pane has the latest time of the batches before.
            seen = F.max(F.when(F.col("pane").isNull(), F.col("last_event")))
            known = rows.agg(seen.alias("seen"), F.max("last_event").alias("latest"), F.count_if("changed").alias("changed"))
            known = known.first()
            before, now = (None if known[c] is None else known[c] - late for c in ("seen", "latest"))
            windows = pane_windows(rows, spec, after=before).persist()
            alerted = _open_before(batch, path, batch_id)
            held, alerts = alerted.drop("batch"), 0
            if known["changed"]:
                judged = judge(windows.filter("changed").select(*finished(KEYS, MEASURES)))
                made = transitions(judged, alerted).withColumn("written_at", F.current_timestamp())
                stored = _store(made, f"{path}/alerts", batch_id, F.col(A.WINDOW_START))
                raised = A.raised(stored)
                _store(act(raised.drop("transition")), f"{path}/actions", batch_id)
                alerts = raised.count()
                latest = F.timestamp_micros(F.lit(known["latest"])).alias("latest")
                held = held.join(stored.select("alert_id"), "alert_id", "left_anti")
                held = held.unionByName(raised.select("alert_id", A.WINDOW_END, latest))

            def is_open(end: Column) -> Column:
                return F.lit(True) if now is None else end > now

            if close is not None:
                ended = close(windows.filter(~is_open(F.unix_micros("window.end"))).select(*finished(KEYS, MEASURES)))
                _store(ended, f"{path}/metrics", batch_id)
            held = _marked(held.filter(is_open(F.unix_micros(A.WINDOW_END))), batch_id)
            held.hint("rebalance").write.mode("overwrite").parquet(_slot(batch, path, batch_id))
            # A pane stays until the last window that it lies in is closed.
            end = F.col("pane") - F.pmod(F.col("pane"), F.lit(slide)) + duration
            left = rows.filter(F.col("pane").isNotNull() & is_open(end))
            mark = spark.range(1).select(F.lit(known["latest"]).cast("bigint").alias("last_event"))
            left = left.unionByName(mark, allowMissingColumns=True).withColumn("batch", F.lit(batch_id).cast("bigint"))
            place = _slot(batch, f"{path}/panes", batch_id)
            left.hint("rebalance").write.mode("overwrite").parquet(place)
            _report(_query_id(batch), batch_id, alerts)
        finally:
            rows.unpersist()
            if windows is not None:
                windows.unpersist()

    return write


def record_writer(path: str) -> Writer:
    """A batch function for result records, a folder per topic as a file queue has."""

    def write(batch: DataFrame, batch_id: int) -> None:
        place = f"{path}/{_place(batch, batch_id)}"
        batch.hint("rebalance").write.mode("overwrite").partitionBy("topic").parquet(place)

    return write


def metrics_and_alerts_writer(
    path: str, judge: Callable[[DataFrame], DataFrame], publish: Writer | None = None
) -> Writer:
    """A batch function for metrics, the verdicts that follow from them, and, as asked, both
    as records for the queue."""
    write_alerts = alert_writer(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        metrics = _store(batch, f"{path}/metrics", batch_id)
        judged = judge(metrics)
        write_alerts(judged, batch_id)
        if publish is not None:
            measured = R.result_records(metrics, R.METRICS_TOPIC)
            publish(measured.unionByName(R.result_records(A.raised(judged), R.ALERTS_TOPIC)), batch_id)

    return write


def stored_alerts(spark: SparkSession, path: str, since: Column | None = None) -> DataFrame:
    """Every stored verdict with its batch; ``since`` a time leaves out older days unread."""
    rows = compaction.read(spark, f"{path}/alerts")
    rows = spark.createDataFrame([], ALERTS) if rows is None else rows
    return rows if since is None else rows.filter(F.col("day") >= F.to_date(since))


def latest_alerts(spark: SparkSession, path: str, since: Column | None = None) -> DataFrame:
    """The alerts that hold: the last verdict of each window, if it is one of anomaly."""
    return A.latest(stored_alerts(spark, path, since)).drop("transition")


def open_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The alerts raised in windows that are still open, as the last batch of each run left them."""
    kind = f"{OPEN_ALERTS}, run string, slot int"
    rows = _read(spark, f"{path}/open", kind).select("run", "batch", "alert_id", A.WINDOW_END)
    last = rows.groupBy("run").agg(F.max("batch").alias("batch"))
    rows = rows.join(last, ["run", "batch"], "left_semi").filter(F.col("alert_id").isNotNull())
    return rows.drop("batch")


def stored_actions(spark: SparkSession, path: str) -> DataFrame:
    """Each action of an alert once, however often its window was emitted."""
    return _read(spark, f"{path}/actions", ACTIONS).drop("run", "batch_id").distinct()


def alerts_sink(
    verdicts: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "update",
    available_now: bool = False,
    name: str = "alerts",
    lateness: int = WindowSpec().watermark,
) -> DataStreamWriter:
    write = alert_writer(path, mode=mode, lateness=lateness)
    return batch_sink(verdicts, write, checkpoint, name, mode, available_now=available_now)


def batch_sink(
    df: DataFrame,
    write: Writer,
    checkpoint: str,
    name: str,
    mode: str,
    interval: str = ALERT_TRIGGER,
    available_now: bool = False,
) -> DataStreamWriter:
    writer = df.writeStream.queryName(name).outputMode(mode).foreachBatch(_drained(write))
    return triggered(writer.option("checkpointLocation", checkpoint), interval, available_now)


def metrics_sink(
    metrics: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    partitioned: bool = False,
    name: str = "metrics",
) -> DataStreamWriter:
    """Closed windows to Parquet, each exactly once; ``partitioned`` by the hour they start in."""
    rows = with_partitions(metrics, F.col("window.start")) if partitioned else metrics
    writer = rows.writeStream.queryName(name).outputMode("append").format("parquet").option("path", path)
    if partitioned:
        writer = writer.partitionBy(*PARTITIONS)
    return triggered(writer.option("checkpointLocation", checkpoint), METRICS_TRIGGER, available_now)


def console_sink(
    alerts: DataFrame, checkpoint: str, mode: str = "update", available_now: bool = False, name: str = "console"
) -> DataStreamWriter:
    writer = alerts.writeStream.queryName(name).outputMode(mode).format("console").option("truncate", False)
    return triggered(writer.option("checkpointLocation", checkpoint), CONSOLE_TRIGGER, available_now)


def observe_logs(logs: DataFrame) -> DataFrame:
    return logs.observe("logs", F.count(F.lit(1)).alias("logs_processed"))


def observe_anomalies(anomalies: DataFrame) -> DataFrame:
    return anomalies.observe("anomalies", F.count_if("is_anomaly").alias("anomalies_detected"))


def rejects_sink(
    rejects: DataFrame, path: str, checkpoint: str, available_now: bool = False, name: str = "rejects"
) -> DataStreamWriter:
    """Records that could not be read, with the reason."""
    writer = rejects.writeStream.queryName(name).outputMode("append").format("parquet").option("path", path)
    return triggered(writer.option("checkpointLocation", checkpoint), METRICS_TRIGGER, available_now)


def observe_alerts(verdicts: DataFrame) -> DataFrame:
    return verdicts.observe("alerts", F.count_if("is_anomaly").alias("alerts_sent"))


COUNTERS = (
    ("logs", "logs_processed"),
    ("anomalies", "anomalies_detected"),
    ("alerts", "alerts_sent"),
)


class CounterTable(StreamingQueryListener):
    """Keeps the observed counts and the duration of each batch; ``flush`` appends them to a
    Parquet table.

    The listener's thread starts no job. What was not flushed when the driver is lost is lost.
    """

    SCHEMA = (
        "query string, run string, batch_id bigint, "
        + ", ".join(f"{n} bigint" for _, n in COUNTERS)
        + ", duration_ms bigint"
    )

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self.rows: deque[tuple] = deque()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics
        told = reported.pop((str(p.id), p.batchId), {})
        if seen or told or p.numInputRows:
            counts = [seen[group][name] if group in seen else told.get(group) for group, name in COUNTERS]
            self.rows.append((p.name, str(p.runId), p.batchId, *counts, p.durationMs.get("triggerExecution")))

    def await_batches(self, last: dict[str, int], seconds: float = 30.0) -> None:
        """Until the counts of each run's last batch are here; they come by another thread."""
        end = time.monotonic() + seconds
        while time.monotonic() < end:
            if all(any(r[1] == run and r[2] >= batch for r in list(self.rows)) for run, batch in last.items()):
                return
            time.sleep(0.1)

    def flush(self) -> None:
        rows = [self.rows.popleft() for _ in range(len(self.rows))]
        if rows:
            self.spark.createDataFrame(rows, self.SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def latency(self, bounds: Sequence[float] = L.BOUNDS) -> DataFrame:
        """The histogram of batch durations of each query, over all that was flushed."""
        rows = self.spark.read.schema(self.SCHEMA).parquet(self.path)
        return L.histogram(rows.withColumn("seconds", F.col("duration_ms") / 1000), "seconds", ("query",), bounds)
