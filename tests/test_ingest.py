"""Enrichment, rejects, queue records, accounting."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from logweir.operators import enrich as E
from logweir.operators import ingest, records
from logweir.schema import LOG, LOG_FIELDS, QUEUE, RAW
from logweir.sources import queue

NOW = datetime(2024, 1, 15, 12, 0, 0, 123456, tzinfo=timezone.utc)
# A record of our own: an internal source that talks to the outside without any risk.
SAMPLE = {
    "timestamp": "2024-01-15T10:30:00Z",
    "source_ip": "172.20.7.41",
    "destination_ip": "198.51.100.3",
    "source_port": 40022,
    "destination_port": 8443,
    "protocol": "UDP",
    "severity": "INFO",
    "message": "name lookup answered",
    "bytes_sent": 77,
    "bytes_received": 612,
    "response_time": 3.25,
    "connection_status": "SUCCESS",
    "log_source": "resolver",
}


def raw(spark, *rows):
    return spark.createDataFrame([tuple(r.get(n) for n in RAW.fieldNames()) for r in rows], RAW)


def test_enrich_sample(spark):
    out = E.enrich(raw(spark, SAMPLE), now=NOW, hostname="h")
    assert out.columns == list(LOG_FIELDS)
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in LOG.fields]
    row = out.first().asDict()
    for name in ("source_ip", "destination_ip", "source_port", "severity", "message", "log_source"):
        assert row[name] == SAMPLE[name]
    assert row["response_time_ms"] == 3.25
    assert row["processing_date"] == "2024-01-15"
    assert row["data_version"] == "1.0"
    assert (row["is_internal_ip"], row["traffic_direction"], row["risk_score"]) == (True, "outbound", 0.0)


def test_enrich_defaults(spark):
    row = E.enrich(raw(spark, {"source_ip": "10.0.0.1"}), now=NOW, hostname="h").first().asDict()
    assert row["severity"] == row["log_level"] == "INFO"
    assert row["protocol"] == "TCP"
    assert row["bytes_sent"] == row["bytes_received"] == 0
    assert row["response_time_ms"] == 0.0
    assert row["connection_status"] == "UNKNOWN"
    assert (row["log_source"], row["hostname"], row["message"]) == ("unknown", "h", "")
    assert row["timestamp"] == row["ingestion_time"]


def test_enrich_absent_columns_equal_nulls(spark):
    narrow = spark.createDataFrame([("10.0.0.1",)], "source_ip string")
    wide = raw(spark, {"source_ip": "10.0.0.1"})
    options = {"now": NOW, "hostname": "h"}
    assert E.enrich(narrow, **options).collect() == E.enrich(wide, **options).collect()


def test_status_keeps_its_case(spark):
    row = E.enrich(raw(spark, {**SAMPLE, "connection_status": "failed", "protocol": "icmp"})).first()
    assert (row.connection_status, row.protocol) == ("failed", "ICMP")


def test_unreadable_time_is_not_now(spark):
    row = E.enrich(raw(spark, {**SAMPLE, "timestamp": "yesterday"}), now=NOW).first()
    assert row.timestamp is None


TEXT = "source_ip string, bytes_sent string, bytes_received string, response_time string"


@pytest.mark.parametrize(
    "row,reason",
    [
        (("10.0.0.1", "12", "0", "1.5"), None),
        (("10.0.0.1", " 12 ", None, " 1e3 "), None),
        (("10.0.0.1", "1.5", "0", "1"), "bad_bytes_sent"),
        (("10.0.0.1", "abc", "x", "y"), "bad_bytes_sent"),
        (("10.0.0.1", "1", "", "1"), "bad_bytes_received"),
        (("10.0.0.1", "1", "1", "abc"), "bad_response_time"),
        (("10.0.0.1", "1", "1", "1d"), "bad_response_time"),
        (("10.0.0.1", "1", "1", "nan"), None),
        ((None, "1", "1", "1"), "missing_source_ip"),
        ((None, "x", "1", "1"), "bad_bytes_sent"),
        (("", None, None, None), None),
    ],
)
def test_reject_reasons(spark, row, reason):
    df = spark.createDataFrame([row], TEXT)
    rejected = E.rejected(df).collect()
    assert [r.reject_reason for r in rejected] == ([] if reason is None else [reason])
    assert E.accepted(df).count() == (reason is None)


def test_numbers_as_numbers(spark):
    df = spark.createDataFrame([("10.0.0.1", 1.9), ("10.0.0.1", float("nan"))], "source_ip string, bytes_sent double")
    assert [r.reject_reason for r in E.rejected(df).collect()] == ["bad_bytes_sent"]
    assert E.logs(df).first().bytes_sent == 1


def test_schema_problems(spark):
    assert E.schema_problems(raw(spark, SAMPLE)) == []
    df = spark.createDataFrame([("10.0.0.1", "1")], "source_ip string, bytes_sent string")
    problems = E.schema_problems(df)
    assert "bytes_sent: string instead of bigint" in problems
    assert "protocol: absent" in problems


def test_producer_record(spark):
    rows = records.producer_records(raw(spark, SAMPLE, {**SAMPLE, "source_ip": None}), now=NOW).collect()
    assert [(r.topic, r.key) for r in rows] == [("network-logs-info", "41")]
    value = json.loads(rows[0].value)
    assert list(value) == list(LOG_FIELDS)
    assert value["timestamp"] == "2024-01-15T10:30:00.000000Z"
    assert value["ingestion_time"].endswith(".123456Z")


def test_null_fields_are_written(spark):
    value = json.loads(records.producer_records(raw(spark, {"source_ip": "a"})).first().value)
    assert value["destination_ip"] is None and "source_port" in value


def test_empty_address_has_null_key(spark):
    assert records.producer_records(raw(spark, {"source_ip": ""})).first().key is None


def test_simple_record(spark):
    rows = records.simple_records(raw(spark, SAMPLE, {}), now=NOW).collect()
    assert [r.key for r in rows] == ["172.20.7.41", "default"]
    assert {r.topic for r in rows} == {"network-logs"}
    assert list(json.loads(rows[0].value)) == ["timestamp", "source_ip", "severity", "message", "ingestion_time"]


def test_simple_record_without_the_fields(spark):
    (row,) = records.simple_records(spark.createDataFrame([("a",)], "source_ip string"), now=NOW).collect()
    assert row.key == "a" and json.loads(row.value)["message"] is None


def test_summary_counts(spark):
    good, bad = SAMPLE, {**SAMPLE, "source_ip": None}
    row = ingest.summary(raw(spark, good, good, good)).first()
    assert (row.total, row.success, row.failed, row.success_rate) == (3, 3, 0, 1.0)
    row = ingest.summary(raw(spark, good, bad)).first()
    assert (row.total, row.success, row.failed, row.success_rate) == (2, 1, 1, 0.5)
    row = ingest.summary(raw(spark)).first()
    assert (row.total, row.success, row.failed, row.bytes_sent, row.success_rate) == (0, 0, 0, 0, 0.0)


def test_send_batch_writes_and_counts_in_one_job(spark, tmp_path):
    path = str(tmp_path / "queue")
    result = ingest.send_batch(
        raw(spark, SAMPLE, {**SAMPLE, "severity": "critical"}, {**SAMPLE, "source_ip": None}),
        lambda df: queue.write_files(df, path),
    )
    assert (result["total"], result["success"], result["failed"]) == (3, 2, 1)
    assert result["throughput_msg_sec"] > 0 and result["processing_time"] > 0
    stored = spark.read.parquet(path)
    assert sorted(r.topic for r in stored.collect()) == ["network-logs-critical", "network-logs-info"]
    assert result["bytes_sent"] == stored.agg(F.sum(F.octet_length("value"))).first()[0]


def test_partial_success_rate(spark):
    rows = [SAMPLE] * 100 + [{**SAMPLE, "source_ip": None}] * 5
    assert ingest.summary(raw(spark, *rows)).first().success_rate == pytest.approx(100 / 105)


def queue_rows(spark, *values):
    rows = [("t", 0, i, NOW, "k", v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, QUEUE)


GOOD_TIME = '"timestamp":"2024-01-15T10:30:00Z"'


@pytest.mark.parametrize(
    "value,reason",
    [
        (None, "null_value"),
        ("not json", "not_json"),
        ('{"timestamp":"2024-01-15T10:', "not_json"),
        ("[]", "not_an_object"),
        ("7", "not_an_object"),
        ("{}", "missing_timestamp"),
        ('{"timestamp":null}', "missing_timestamp"),
        ('{"timestamp":"yesterday"}', "bad_timestamp"),
    ],
)
def test_dropped_values(spark, value, reason):
    df = queue_rows(spark, value)
    assert records.parse(df).count() == 0
    assert [r.parse_reason for r in records.parse_rejects(df).collect()] == [reason]


@pytest.mark.parametrize(
    "value,field,expected",
    [
        ("{%s}" % GOOD_TIME, "source_ip", None),
        ('{%s,"bytes_sent":"12"}' % GOOD_TIME, "bytes_sent", None),
        ('{%s,"bytes_sent":12.7}' % GOOD_TIME, "bytes_sent", None),
        ('{%s,"destination_port":"22"}' % GOOD_TIME, "destination_port", None),
        ('{%s,"risk_score":"5"}' % GOOD_TIME, "risk_score", None),
        ('{%s,"is_internal_ip":"true"}' % GOOD_TIME, "is_internal_ip", None),
        ('{%s,"source_ip":7}' % GOOD_TIME, "source_ip", "7"),
        ('{%s,"bytes_sent":12,"risk_score":0.5}' % GOOD_TIME, "bytes_sent", 12),
    ],
)
def test_kept_values(spark, value, field, expected):
    df = queue_rows(spark, value)
    assert records.parse(df).first()[field] == expected
    assert records.parse_rejects(df).count() == 0


@pytest.mark.parametrize(
    "text,micros",
    [
        ('"2024-01-15T10:30:00Z"', 1705314600000000),
        ('"2024-01-15T10:30:00+05:30"', 1705294800000000),
        ('"2024-01-15T10:30:00.123456"', 1705314600123456),
        ('"2024-01-15"', 1705276800000000),
        ("1705314600", 1705314600000000),
    ],
)
def test_time_texts(spark, text, micros):
    parsed = records.parse(queue_rows(spark, '{"timestamp":%s}' % text))
    assert parsed.select(F.unix_micros("timestamp")).first()[0] == micros


def test_parse_reads_each_record_once(spark, tmp_path):
    """The event-time filter must stay above the JSON parser."""
    path = str(tmp_path / "q")
    queue_rows(spark, "{%s}" % GOOD_TIME).write.parquet(path)
    plan = records.parse(queue.file_batch(spark, path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_round_trip(spark):
    rows = raw(spark, SAMPLE, {"source_ip": "10.0.0.1", "timestamp": "2024-01-15 10:00:00.5"})
    logs = E.logs(rows, now=NOW, hostname="h")
    sent = records.to_records(logs).selectExpr(
        "topic", "0 as partition", "0L as offset", "current_timestamp() as timestamp", "key", "value"
    )
    assert sorted(records.parse(sent).select(*LOG_FIELDS).collect()) == sorted(logs.collect())


def test_consumed_records(spark):
    schema = "topic string, partition int, offset bigint, timestamp timestamp, key binary, value binary, headers array<struct<key:string,value:binary>>"
    df = spark.createDataFrame(
        [
            ("t", 0, 7, NOW, b"41", b'{"n": 1}', [("origin", b"a"), ("hops", b"2")]),
            ("t", 2, 31, NOW, None, b'{"n": 2}', None),
            ("t", 2, 32, NOW, b"", b"[]", []),
        ],
        schema,
    )
    first, second, third = records.consumed_records(df).orderBy("offset").collect()
    assert (first.key, first.value) == ("41", '{"n": 1}')
    assert first.headers == {"origin": bytearray(b"a"), "hops": bytearray(b"2")}
    assert (second.key, second.headers) == (None, {})
    assert third.key is None


def test_broker_options():
    read = queue.read_options("a:1,b:2", ["x", "y"], {"kafka.session.timeout.ms": "1"})
    assert read["subscribe"] == "x,y"
    assert read["kafka.session.timeout.ms"] == "1"
    assert read["kafka.fetch.max.bytes"] == "52428800"
    write = queue.write_options("a:1", {"kafka.batch.size": "64000", "kafka.acks": "1"})
    assert (write["kafka.batch.size"], write["kafka.acks"], write["kafka.retries"]) == ("64000", "1", "5")


def test_cut_values_are_parsed_or_rejected(spark):
    """Every prefix of a record, and the record: one or the other, whatever fields are read."""
    value = records.producer_records(raw(spark, SAMPLE), now=NOW).first().value
    df = queue_rows(spark, *[value[:n] for n in range(len(value) + 1)])
    kept = [r.offset for r in records.parse(df).collect()]
    assert kept == [len(value)]
    assert [r.offset for r in records.parse(df, records.fields("severity")).collect()] == kept
    assert records.parse_rejects(df).count() == len(value)


def test_accepted_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw(spark, SAMPLE).write.parquet(path)
    plan = E.logs(spark.read.parquet(path), now=NOW)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(source_ip)]" in plan


def test_topics_and_ports_are_parameters(spark, tmp_path):
    rows = raw(spark, {**SAMPLE, "severity": "audit", "destination_port": 8080})
    topics = {"AUDIT": "audit-logs"}
    assert ingest.by_topic(rows, topics=topics).first().topic == "audit-logs"
    path = str(tmp_path / "q")
    ingest.send_batch(rows, lambda df: queue.write_files(df, path), topics=topics)
    assert spark.read.parquet(path).first().topic == "audit-logs"
    assert E.enrich(rows).first().risk_score == 0.0
    assert E.enrich(rows, risky_ports=(8080,)).first().risk_score == 0.3
