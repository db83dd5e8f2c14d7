"""Named queries over the test tables, one per operator.

Times come out as epoch microseconds, so results do not depend on a session's
time zone, and means of risk scores rounded, since their last bits depend on the
order of addition.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.functions import network
from logweir.operators import alerts as A
from logweir.operators import anomaly, forest, ingest, latency, lookup, metrics, outliers, quality, records
from logweir.operators import enrich as E
from logweir.settings import DECLARED_LEVELS, Thresholds, configure, materialize, work_folder
from logweir.sources import compaction
from logweir.sources import events as S
from logweir.sources import queue as file_queue
from logweir.sources import store
from logweir.streaming import metrics as stream
from logweir.streaming import run, sinks

# 2024-01-15 12:00:00 UTC
NOW_MICROS = 1_705_320_000_000_000
HOST = "collector"
AS_OF = datetime(2024, 4, 14, 12, 0, 0, tzinfo=timezone.utc)
SALT = "pepper"
# Denser logs for the cuts that the table's own density never reaches.
DENSE_MICROS, DENSE_COPIES = 15_000, 4
# A forest of few trees besides the declared one.
FEW_TREES, FEW_SAMPLE = 5, 64
# Hours of a day of whose logs the series with gaps has none.
SILENT_HOURS = (2, 3, 4)
# Files in which the streams replay the queue, and every which event comes late.
REPLAYS, LATE_EVERY, LATE_EVENT = 4, 50, 7
# Logs of a batch at most, about; the pieces that it is put together of, and its files.
BATCH_LOGS, PIECES, BATCH_FILES = 500_000, 8, 16
PARTITIONS = 6
DIGITS = 9


def now() -> Column:
    return F.timestamp_micros(F.lit(NOW_MICROS))


def raw_logs(spark: SparkSession, sf: str, **options) -> DataFrame:
    return S.raw_logs(S.table(configure(spark), sf, "events"), **options)


def enriched(spark: SparkSession, sf: str, **options) -> DataFrame:
    return E.logs(raw_logs(spark, sf, **options), now=now(), hostname=HOST)


def flat(df: DataFrame) -> DataFrame:
    """Window bounds and other times as microseconds."""
    out = []
    for field in df.schema.fields:
        if field.name == "window":
            out += [F.unix_micros(f"window.{edge}").alias(f"window_{edge}") for edge in ("start", "end")]
        elif isinstance(field.dataType, T.TimestampType):
            out.append(F.unix_micros(field.name).alias(field.name))
        else:
            out.append(F.col(field.name))
    return df.select(*out)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, DIGITS) for n in names})


# ---- ingest


def enrich_logs(spark, sf):
    return flat(E.enrich(raw_logs(spark, sf), now=now(), hostname=HOST, carry=("event_id",)))


def ingest_rejects(spark, sf):
    rows = E.rejected(raw_logs(spark, sf, text_bytes=True))
    return rows.select("event_id", "source_ip", "bytes_sent", "reject_reason")


def internal_ip(spark, sf):
    return raw_logs(spark, sf).select(
        "event_id",
        network.is_internal_ip(F.col("source_ip")).alias("source_internal"),
        network.is_internal_ip(F.col("destination_ip")).alias("destination_internal"),
    )


def traffic_direction(spark, sf):
    direction = network.traffic_direction(F.col("source_ip"), F.col("destination_ip"))
    return raw_logs(spark, sf).select("event_id", direction.alias("traffic_direction"))


def risk_score(spark, sf):
    risk = network.risk_score(
        F.col("destination_port"), F.col("source_ip"), F.col("bytes_sent"), F.col("connection_status")
    )
    return raw_logs(spark, sf).select("event_id", risk.alias("risk_score"))


def topic_routing(spark, sf):
    return raw_logs(spark, sf).select("event_id", network.topic_for(F.col("severity")).alias("topic"))


def partition_key(spark, sf):
    return raw_logs(spark, sf).select("event_id", network.partition_key(F.col("source_ip")).alias("key"))


def producer_records(spark, sf):
    return records.producer_records(raw_logs(spark, sf), now=now(), hostname=HOST, carry=("event_id",))


def producer_records_simple(spark, sf):
    return records.simple_records(raw_logs(spark, sf), now=now())


def ingest_summary(spark, sf):
    return ingest.summary(raw_logs(spark, sf, text_bytes=True), now=now(), hostname=HOST)


def ingest_by_topic(spark, sf):
    return ingest.by_topic(raw_logs(spark, sf, text_bytes=True), now=now(), hostname=HOST)


# ---- queue


def queue(raw: DataFrame) -> DataFrame:
    """Producer records as a queue scan would deliver them."""
    sent = records.producer_records(raw, now=now(), hostname=HOST, carry=("event_id",))
    header = F.struct(F.lit("trace").alias("key"), F.col("topic").cast("binary").alias("value"))
    return sent.select(
        "event_id",
        "topic",
        (F.col("event_id") % PARTITIONS).cast("int").alias("partition"),
        F.expr(f"event_id div {PARTITIONS}").alias("offset"),
        F.timestamp_micros(F.lit(S.ORIGIN_MICROS) + F.col("event_id") * S.EVENT_MICROS).alias("timestamp"),
        "key",
        F.col("value").cast("binary").alias("value"),
        F.when(F.col("event_id") % 5 == 0, F.array(header)).alias("headers"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """The same records with some values broken in each way a reader must survive."""
    value = F.col("value").cast("string")
    late = F.replace(value, F.lit('"timestamp":"2024'), F.lit('"timestamp":"soon'))
    broken = (
        F.when(F.col("event_id") % 71 == 0, F.substring(value, 1, 20))
        .when(F.col("event_id") % 73 == 0, "[]")
        .when(F.col("event_id") % 79 == 0, F.lit(None))
        .when(F.col("event_id") % 67 == 0, late)
        .when(F.col("event_id") % 61 == 0, '{"severity":"INFO"}')
        .otherwise(value)
    )
    return rows.withColumn("value", broken)


def parse_logs(spark, sf):
    return flat(records.parse(damaged(queue(raw_logs(spark, sf)))))


def parse_rejects(spark, sf):
    rows = records.parse_rejects(damaged(queue(raw_logs(spark, sf))))
    return rows.select("partition", "offset", "value", "parse_reason")


def consumed_records(spark, sf):
    rows = records.consumed_records(queue(raw_logs(spark, sf)))
    trace = F.try_element_at("headers", F.lit("trace")).cast("string")
    return flat(rows.withColumn("n_headers", F.size("headers")).withColumn("trace", trace).drop("headers"))


def consumed_simple(spark, sf):
    rows = records.simple_consumed(queue(raw_logs(spark, sf)))
    return flat(rows.select("partition", "offset", "data.*"))


# ---- metrics, anomalies, alerts


def log_metrics(spark, sf):
    return metrics.log_metrics(enriched(spark, sf))


def windowed_metrics(spark, sf):
    rows = metrics.window_metrics(enriched(spark, sf))
    return rounded(flat(rows), "avg_response_time", "avg_risk_score")


def derived_metrics(spark, sf):
    rows = log_metrics(spark, sf).select(
        "window",
        *metrics.KEYS,
        "failure_rate",
        "bytes_per_second",
        "is_high_volume",
        "is_high_latency",
        "is_suspicious_failure_rate",
    )
    return rounded(flat(rows), "failure_rate", "bytes_per_second")


def anomaly_flags(spark, sf):
    rows = anomaly.with_flags(log_metrics(spark, sf))
    return flat(rows.select("window", *metrics.KEYS, *anomaly.FLAGS))


def anomaly_scores(spark, sf):
    rows = anomaly.detect(log_metrics(spark, sf), now=now())
    return flat(rows.select("window", *metrics.KEYS, "anomaly_score", "is_anomaly", "anomaly_level"))


def declared_levels(spark, sf):
    """The same scores under the other set of level cuts."""
    rows = anomaly.detect(log_metrics(spark, sf), Thresholds(levels=DECLARED_LEVELS), now=now())
    return flat(rows.select("window", *metrics.KEYS, "anomaly_score", "anomaly_level"))


def alert_rows(spark, sf):
    return A.alerts(anomaly.detect(log_metrics(spark, sf), now=now()))


def alerts(spark, sf):
    return rounded(flat(alert_rows(spark, sf)), "failure_rate", "avg_response_time")


def alert_actions(spark, sf):
    return A.actions(alert_rows(spark, sf))


def alert_channels(spark, sf):
    return A.channels(alert_rows(spark, sf))


def simple_rows(spark, sf):
    return metrics.simple_metrics(raw_logs(spark, sf))


def simple_metrics(spark, sf):
    return rounded(flat(simple_rows(spark, sf)), "avg_response_time")


def simple_anomalies(spark, sf):
    return rounded(flat(anomaly.simple_anomalies(simple_rows(spark, sf))), "avg_response_time")


def simple_alert_actions(spark, sf):
    logs = raw_logs(spark, sf, spacing=DENSE_MICROS, copies=DENSE_COPIES)
    return flat(A.simple_actions(anomaly.simple_anomalies(metrics.simple_metrics(logs))))


def read_records(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Result records with every field of their JSON."""
    value = F.from_json(F.col("value").cast("string"), schema, records.READ_OPTIONS).alias("value")
    read = flat(rows.select("topic", "key", value).select("topic", "key", "value.*"))
    names = ("avg_response_time", "avg_risk_score", "failure_rate", "bytes_per_second")
    return rounded(read, *[n for n in names if n in read.columns])


def metrics_records(spark, sf):
    """Metrics and alerts encoded for the queue, read back from their JSON."""
    measured, alerted = log_metrics(spark, sf), alert_rows(spark, sf)
    return read_records(records.result_records(measured, records.METRICS_TOPIC), measured.schema).unionByName(
        read_records(records.result_records(alerted, records.ALERTS_TOPIC), alerted.schema), allowMissingColumns=True
    )


# ---- declared operators


def null_skip(spark, sf):
    rows = quality.handle_nulls(raw_logs(spark, sf), "skip")
    return flat(rows.select("event_id", "timestamp", "source_ip", "severity"))


def null_default(spark, sf):
    rows = quality.handle_nulls(raw_logs(spark, sf), "default")
    return flat(E.logs(rows, now=now(), hostname=HOST, carry=("event_id",)))


def schema_check(spark, sf):
    """What is wrong with a frame that lacks a field and has bytes as text, and for how many rows."""
    rows = raw_logs(spark, sf, text_bytes=True).drop("hostname")
    problems = F.array(*[F.lit(p) for p in E.schema_problems(rows)])
    return rows.agg(F.count(F.lit(1)).alias("n_rows")).select(F.explode(problems).alias("problem"), "n_rows")


def data_quality(spark, sf):
    return quality.data_quality(raw_logs(spark, sf, text_bytes=True))


def late_logs(spark, sf):
    received = F.timestamp_micros(
        F.unix_micros("timestamp") + (F.col("event_id") % 15) * F.lit(60_000_000)
    )
    rows = E.enrich(raw_logs(spark, sf), now=received, hostname=HOST, carry=("event_id",))
    return flat(quality.late_logs(rows).select("event_id", "timestamp", "ingestion_time"))


def failed_attempts(spark, sf):
    return flat(quality.failed_attempts(enriched(spark, sf, spacing=DENSE_MICROS)))


def partition_columns(spark, sf):
    rows = quality.with_partitions(raw_logs(spark, sf, real_time=True))
    return flat(rows.select("event_id", "timestamp", *quality.PARTITIONS))


def retention(spark, sf):
    rows = quality.retained(raw_logs(spark, sf, real_time=True), AS_OF)
    return flat(rows.select("event_id", "timestamp"))


def stored_retention(spark, sf):
    """The same from a store partitioned by hour, which skips older folders."""
    path = work_folder(spark, "log-store")
    store.write_logs(E.enrich(raw_logs(spark, sf, real_time=True), now=now(), carry=("event_id",)), path)
    kept = quality.retained(spark.read.parquet(path), AS_OF)
    return flat(kept.select("event_id", "timestamp", *quality.PARTITIONS))


def compacted_store(spark, sf):
    """Logs stored in two appends, whose closed hours are packed into one file each."""
    path = work_folder(spark, "log-store")
    logs = E.enrich(raw_logs(spark, sf, real_time=True), now=now(), carry=("event_id",))
    for n in range(2):
        store.write_logs(logs.filter(F.col("event_id") % 2 == n), path)
    store.compact_logs(spark, path, AS_OF - timedelta(days=quality.RETENTION_DAYS))
    compaction.clean(spark, path, 0)
    return flat(store.read_logs(spark, path).select("event_id", "timestamp", *quality.PARTITIONS))


def latency_histogram(spark, sf):
    """Response times in fixed buckets, counted by status and added up by direction."""
    seconds = enriched(spark, sf).withColumn("seconds", F.col("response_time_ms") / 1000)
    parts = latency.histogram(seconds, "seconds", ("traffic_direction", "connection_status"))
    return latency.merged(parts, ("traffic_direction",))


def zscore_outliers(spark, sf):
    stored = materialize(metrics.window_metrics(enriched(spark, sf)), "metrics")
    rows = outliers.zscores(stored).select(
        "window",
        *metrics.KEYS,
        "log_count",
        "zscore",
        "modified_zscore",
        "is_zscore_outlier",
        "is_modified_zscore_outlier",
    )
    return rounded(flat(rows), "zscore", "modified_zscore")


def seasonal_residual(spark, sf):
    rows = outliers.seasonal_residual(enriched(spark, sf, real_time=True))
    return rounded(flat(rows), "trend", "seasonal", "residual")


def seasonal_calendar(spark, sf):
    """The same with hours that have no logs, which count 0."""
    logs = enriched(spark, sf, real_time=True).filter(~F.hour("timestamp").isin(*SILENT_HOURS))
    rows = outliers.seasonal_residual(logs, empty_hours=True)
    return rounded(flat(rows), "trend", "seasonal", "residual")


def grown_forest(spark, sf, trees, sample):
    stored = materialize(log_metrics(spark, sf), "metrics")
    rows = forest.isolation_scores(stored, trees=trees, sample=sample)
    return flat(rows.select("window", *metrics.KEYS, *forest.FEATURES, "isolation_score", "is_isolated"))


def isolation_forest(spark, sf):
    """The forest of the declared size."""
    return grown_forest(spark, sf, forest.TREES, forest.SAMPLE)


def isolation_forest_few(spark, sf):
    """A forest of few small trees."""
    return grown_forest(spark, sf, FEW_TREES, FEW_SAMPLE)


def assets(spark, sf):
    address = "concat('10.1.', cast(c_custkey % 8 as string), '.', cast(c_custkey % 200 + 1 as string))"
    customers = S.table(configure(spark), sf, "customer").withColumn("source_ip", F.expr(address))
    return customers.groupBy("source_ip").agg(
        F.min("c_name").alias("owner"), F.min("c_mktsegment").alias("segment")
    )


def asset_join(spark, sf):
    rows = lookup.join_assets(raw_logs(spark, sf), assets(spark, sf))
    return rows.select("event_id", "source_ip", "owner", "segment")


def geo_ranges(spark, sf):
    nations = S.table(configure(spark), sf, "nation")
    regions = S.table(spark, sf, "region")
    return (
        nations.selectExpr("concat('10.1.', cast(n_nationkey as string), '.0/24') as cidr", "n_name as location")
        .union(nations.selectExpr("concat('172.', cast(n_nationkey as string), '.0.0/16')", "n_name"))
        .union(regions.selectExpr("concat(cast(r_regionkey + 9 as string), '.0.0.0/8')", "r_name"))
    )


def geo_join(spark, sf):
    rows = lookup.join_geo(raw_logs(spark, sf), geo_ranges(spark, sf))
    return rows.select("event_id", "source_ip", "location")


def threat_list(spark, sf):
    address = """case when s_suppkey % 2 = 0
        then concat('10.1.', cast(s_suppkey % 8 as string), '.', cast(s_suppkey % 200 + 1 as string))
        else concat('8.8.', cast(s_suppkey % 4 as string), '.8') end as ip"""
    return S.table(configure(spark), sf, "supplier").selectExpr(address)


def threat_flag(spark, sf):
    rows = lookup.flag_threats(raw_logs(spark, sf), threat_list(spark, sf))
    return rows.select("event_id", "source_ip", "destination_ip", "is_threat")


def ip_masking(spark, sf):
    rows = raw_logs(spark, sf).select(
        "event_id",
        "source_ip",
        "destination_ip",
        F.col("source_ip").alias("source_hash"),
        F.col("destination_ip").alias("destination_hash"),
    )
    return quality.anonymized(quality.masked(rows), SALT, ("source_hash", "destination_hash"))


def pii_flags(spark, sf):
    documents = S.table(configure(spark), sf, "documents")
    return quality.pii_flags(documents, "text").select("doc_id", "has_email", "has_phone", "has_card")


# ---- streams


def replays(spark: SparkSession, sf: str, folder: str, late: bool = False) -> Iterator[DataFrame]:
    """The queue as a file stream that grows: each step adds files in time order.

    With ``late`` some events come with the last step, whatever their time. The steps are runs
    of their own, so the queries that read the stream stop and start again between them. A step
    is read in batches of about ``BATCH_LOGS`` in time order, however large the table is, so
    that state and hash tables hold a batch and the open windows. In this order no log is late
    for what the batches of its own step have seen.
    """
    last = S.table(spark, sf, "events").agg(F.max("event_id")).first()[0] or 0
    part = F.expr(f"event_id * {REPLAYS} div {last + 1}")
    if late:
        part = F.when(F.col("event_id") % LATE_EVERY == LATE_EVENT, REPLAYS - 1).otherwise(part)
    part = part.cast("int").alias("step")
    count = raw_logs(spark, sf).count()
    # Pieces in time order, written once; each batch is some of them that follow one another.
    pieces = max(-(-count * PIECES // BATCH_LOGS), 1)
    logs = raw_logs(spark, sf).select("*", part).filter(F.col("step").between(0, REPLAYS - 1))
    sent = queue(logs.repartitionByRange(pieces, "step", "event_id")).drop("headers")
    sent = sent.withColumn("value", F.col("value").cast("string")).select("*", part).drop("event_id")
    dealt, path = sent.withColumn("piece", F.spark_partition_id()), work_folder(spark, "queue")
    dealt.write.partitionBy("step", "piece").parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)
    sizes: dict[int, list[tuple[int, int]]] = {n: [] for n in range(REPLAYS)}
    for row in dealt.groupBy("step", "piece").count().orderBy("step", "piece").collect():
        sizes[row["step"]].append((row["piece"], row["count"]))
    # Spark takes files in the order in which they were written, so many a batch.
    files, known = min(max(count * BATCH_FILES // BATCH_LOGS, 1), BATCH_FILES), 0
    for n, found in sizes.items():
        batches = balanced(found, BATCH_LOGS)
        for first, end in batches:
            rows = dealt.filter((F.col("step") == n) & F.col("piece").between(first, end)).drop("step", "piece")
            rows.repartition(files).write.mode("append").parquet(folder)
            now_known = len(file_queue.file_batch(spark, folder).inputFiles())
            # A batch in fewer files must be the last of its run, or files of the next would fill it.
            if (first, end) == batches[-1] or now_known - known != files:
                yield file_queue.file_stream(spark, folder, files)
            known = now_known


def balanced(sizes: Sequence[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """(first, last) number of successive pieces with about as many rows, at least one pair;
    ``sizes`` are (number, rows)."""
    total = sum(rows for _, rows in sizes)
    parts, before = -(-total // most), 0
    found: dict[int, tuple[int, int]] = {}
    for number, rows in sizes:
        at = (2 * before + rows) * parts // (2 * total)
        found[at] = (found.get(at, (number, 0))[0], number)
        before += rows
    return [*found.values()] or [(0, 0)]


#: Columns whose last bits depend on the order of addition.
MEANS = ("avg_response_time", "avg_risk_score", "failure_rate", "bytes_per_second")


def stored_metrics(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return rounded(flat(spark.read.schema(schema).parquet(path)), *MEANS)


def replayed_metrics(spark: SparkSession, sf: str, late: bool) -> DataFrame:
    folder = work_folder(spark, "stream-metrics")
    for source in replays(spark, sf, f"{folder}/queue", late):
        measured = stream.log_metrics(records.parse(source, stream.LOG_INPUT))
        sink = sinks.metrics_sink(measured, f"{folder}/out", f"{folder}/checkpoint", True, name=f"m{uuid.uuid4().hex}")
        run.wait([sink.start()])
    return stored_metrics(spark, f"{folder}/out", measured.schema)


def stream_metrics(spark, sf):
    """Events through the queue into the metrics store, over several batches and restarts."""
    return replayed_metrics(spark, sf, late=False)


def stream_late(spark, sf):
    """The same with late logs, which are lost for the windows that are closed by then."""
    return replayed_metrics(spark, sf, late=True)


def stream_alerts(spark, sf):
    """Events through the queue into the alert store: the alerts that hold at the end."""
    folder = work_folder(spark, "stream-alerts")
    for source in replays(spark, sf, f"{folder}/queue"):
        updated(source, folder, store_metrics=False)
    latest = sinks.latest_alerts(spark, f"{folder}/out").select(*A.COLUMNS, "alert_id", "alert_message")
    return rounded(flat(latest), "failure_rate", "avg_response_time")


def updated(source: DataFrame, folder: str, store_metrics: bool = True) -> None:
    """The pipeline that alerts while windows are open, over one more step of the queue."""
    started = run.start_streams(
        source,
        f"{folder}/checkpoint",
        f"{folder}/out",
        store_metrics=store_metrics,
        alert_mode="update",
        available_now=True,
        now=now(),
        name=f"a{uuid.uuid4().hex}-",
    )
    run.wait(started)


def stream_open_windows(spark, sf):
    """Metrics as that pipeline stores them when a window is closed; some logs come late."""
    folder = work_folder(spark, "stream-open")
    for source in replays(spark, sf, f"{folder}/queue", late=True):
        updated(source, folder)
    return rounded(flat(spark.read.parquet(f"{folder}/out/metrics").drop("run", "batch_id")), *MEANS)


def stream_simple(spark, sf):
    """The simple variant on a stream: anomalous closed windows per source."""
    folder = work_folder(spark, "stream-simple")
    for source in replays(spark, sf, f"{folder}/queue"):
        found = anomaly.simple_anomalies(stream.simple_metrics(simple_logs(source)))
        sink = sinks.metrics_sink(found, f"{folder}/out", f"{folder}/checkpoint", True, name=f"s{uuid.uuid4().hex}")
        run.wait([sink.start()])
    stored = spark.read.schema(found.schema).parquet(f"{folder}/out")
    return rounded(flat(stored), "avg_response_time")


def simple_logs(source: DataFrame) -> DataFrame:
    """Response times under the name that the simple variant reads."""
    return records.parse(source, stream.LOG_INPUT).withColumn("response_time", F.col("response_time_ms"))


def pipeline(spark: SparkSession, sf: str, folder: str) -> sinks.CounterTable:
    """The assembled pipeline over the replays: one query, its records published to files."""
    counters = sinks.CounterTable(spark, f"{folder}/counters")
    spark.streams.addListener(counters)
    try:
        for source in replays(spark, sf, f"{folder}/queue"):
            started = run.start_streams(
                source,
                f"{folder}/checkpoint",
                f"{folder}/out",
                available_now=True,
                now=now(),
                name=f"p{uuid.uuid4().hex}-",
                rejects=True,
                publish=sinks.record_writer(f"{folder}/records"),
            )
            run.wait(started, counters)
            ended = {str(q.runId): q.lastProgress["batchId"] for q in started[:1] if q.lastProgress}
            counters.await_batches(ended)
    finally:
        spark.streams.removeListener(counters)
    counters.flush()
    return counters


def stream_records(spark, sf):
    """Metrics and alerts of closed windows as the pipeline publishes them."""
    folder = work_folder(spark, "stream-records")
    pipeline(spark, sf, folder)
    rows = spark.read.schema("topic string, key string, value string").parquet(f"{folder}/records")
    read = [
        read_records(rows.filter(F.col("topic") == topic), schema)
        for topic, schema in (
            (records.METRICS_TOPIC, log_metrics(spark, sf).schema),
            (records.ALERTS_TOPIC, alert_rows(spark, sf).schema),
        )
    ]
    return read[0].unionByName(read[1], allowMissingColumns=True)


def stream_counters(spark, sf):
    """Logs read, windows found anomalous and alerts sent by the pipeline, over all batches."""
    folder = work_folder(spark, "stream-counters")
    counters = pipeline(spark, sf, folder)
    rows = spark.read.schema(counters.SCHEMA).parquet(counters.path)
    return rows.agg(*[F.sum(n).alias(n) for _, n in sinks.COUNTERS])


ALL = (
    enrich_logs,
    ingest_rejects,
    internal_ip,
    traffic_direction,
    risk_score,
    topic_routing,
    partition_key,
    producer_records,
    producer_records_simple,
    ingest_summary,
    ingest_by_topic,
    parse_logs,
    parse_rejects,
    consumed_records,
    consumed_simple,
    windowed_metrics,
    derived_metrics,
    anomaly_flags,
    anomaly_scores,
    alerts,
    alert_actions,
    alert_channels,
    simple_metrics,
    simple_anomalies,
    simple_alert_actions,
    declared_levels,
    metrics_records,
    null_skip,
    null_default,
    schema_check,
    data_quality,
    late_logs,
    failed_attempts,
    partition_columns,
    retention,
    stored_retention,
    compacted_store,
    latency_histogram,
    zscore_outliers,
    seasonal_residual,
    seasonal_calendar,
    isolation_forest,
    isolation_forest_few,
    asset_join,
    geo_join,
    threat_flag,
    ip_masking,
    pii_flags,
    stream_metrics,
    stream_late,
    stream_alerts,
    stream_open_windows,
    stream_simple,
    stream_records,
    stream_counters,
)


def catalog() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in ALL}
