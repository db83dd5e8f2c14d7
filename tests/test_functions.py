"""Scalar rules on hand-made values."""

import itertools

import pytest
from pyspark.sql import functions as F

from logweir.functions import network, text


def one(spark, values, types, column):
    df = spark.createDataFrame([tuple(values)], types)
    return df.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "ip,expected",
    [
        ("192.168.1.1", True),
        ("10.0.0.1", True),
        ("172.16.0.1", True),
        ("172.31.255.255", True),
        ("172.15.0.1", False),
        ("172.32.0.1", False),
        ("8.8.8.8", False),
        ("1.1.1.1", False),
        ("173.16.0.1", False),
        ("127.0.0.1", False),
        ("10.junk", True),
        ("110.0.0.1", False),
        (None, False),
        ("", False),
        ("invalid", False),
    ],
)
def test_internal_ip(spark, ip, expected):
    assert one(spark, [ip], "ip string", network.is_internal_ip(F.col("ip"))) is expected


@pytest.mark.parametrize(
    "src,dst,expected",
    [
        ("192.168.1.1", "10.0.0.1", "internal"),
        ("192.168.1.1", "8.8.8.8", "outbound"),
        ("8.8.8.8", "192.168.1.1", "inbound"),
        ("8.8.8.8", "1.1.1.1", "external"),
        (None, "10.0.0.1", "inbound"),
        ("10.0.0.1", None, "outbound"),
        (None, None, "external"),
    ],
)
def test_direction(spark, src, dst, expected):
    column = network.traffic_direction(F.col("s"), F.col("d"))
    assert one(spark, [src, dst], "s string, d string", column) == expected


@pytest.mark.parametrize(
    "port,src,sent,status,expected",
    [
        (80, "192.168.1.1", 1024, "SUCCESS", 0.0),
        (22, "8.8.8.8", 2_000_000, "FAILED", 1.0),
        (3306, "10.0.0.1", 0, "SUCCESS", 0.3),
        (None, None, None, None, 0.2),
        (80, "10.0.0.1", 1_000_000, "failed", 0.0),
        (80, "10.0.0.1", 1_000_001, "FAILED", 0.5),
        (5432, "8.8.8.8", 0, "FAILED", 0.8),
    ],
)
def test_risk(spark, port, src, sent, status, expected):
    column = network.risk_score(F.col("p"), F.col("s"), F.col("b"), F.col("c"))
    assert one(spark, [port, src, sent, status], "p int, s string, b bigint, c string", column) == expected


def test_risk_takes_nine_values(spark):
    rows = list(itertools.product([22, 80], ["10.0.0.1", "8.8.8.8"], [0, 2_000_000], ["FAILED", "OK"]))
    df = spark.createDataFrame(rows, "p int, s string, b bigint, c string")
    risk = network.risk_score(F.col("p"), F.col("s"), F.col("b"), F.col("c"))
    seen = {r[0] for r in df.select(risk).collect()}
    assert seen == {0.0, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 1.0}


@pytest.mark.parametrize(
    "severity,expected",
    [
        ("CRITICAL", "network-logs-critical"),
        ("ERROR", "network-logs-error"),
        ("WARNING", "network-logs-warning"),
        ("INFO", "network-logs-info"),
        ("DEBUG", "network-logs-debug"),
        ("critical", "network-logs-critical"),
        ("Critical", "network-logs-critical"),
        ("UNKNOWN", "network-logs-info"),
        ("", "network-logs-info"),
        (None, "network-logs-info"),
    ],
)
def test_topic(spark, severity, expected):
    assert one(spark, [severity], "s string", network.topic_for(F.col("s"))) == expected


def test_topic_table_can_be_extended(spark):
    topics = {**network.TOPICS, "CUSTOM": "custom-logs"}
    assert one(spark, ["custom"], "s string", network.topic_for(F.col("s"), topics)) == "custom-logs"


@pytest.mark.parametrize(
    "ip,expected",
    [("192.168.1.100", "100"), ("localhost", "localhost"), (None, "unknown"), ("", None), ("10.", None)],
)
def test_partition_key(spark, ip, expected):
    assert one(spark, [ip], "ip string", network.partition_key(F.col("ip"))) == expected


@pytest.mark.parametrize(
    "ip,expected",
    [
        ("0.0.0.0", 0),
        ("10.0.0.7", 167772167),
        ("255.255.255.255", 4294967295),
        ("256.1.1.1", None),
        ("1.2.3", None),
        ("1.2.3.4.5", None),
        ("::1", None),
        (None, None),
    ],
)
def test_ipv4_number(spark, ip, expected):
    assert one(spark, [ip], "ip string", network.ipv4_number(F.col("ip"))) == expected


@pytest.mark.parametrize(
    "ip,expected",
    [("10.1.2.3", "10.1.2.0"), ("203.0.113.255", "203.0.113.0"), ("::1", "::1"), ("a.b.c.d", "a.b.c.d"), (None, None)],
)
def test_mask(spark, ip, expected):
    assert one(spark, [ip], "ip string", text.mask_ip(F.col("ip"))) == expected


def test_anonymize_is_stable_and_salted(spark):
    a, b, c = (
        one(spark, [ip], "ip string", text.anonymize(F.col("ip"), salt))
        for ip, salt in (("10.0.0.1", "x"), ("10.0.0.1", "x"), ("10.0.0.1", "y"))
    )
    assert a == b != c
    assert one(spark, [None], "ip string", text.anonymize(F.col("ip"), "x")) is None


@pytest.mark.parametrize(
    "value,email,phone,card",
    [
        ("write to a.b@mail.example.org now", True, False, False),
        ("no@mail", False, False, False),
        ("x" * 300 + "@example.org", True, False, False),
        ("call 415-555-0199.", False, True, False),
        ("call (415) 555 0199\n", False, True, False),
        ("order 1415-555-01990", False, False, False),
        ("4111 1111 1111 1111", False, False, True),
        ("4111-1111-1111-1111!", False, False, True),
        ("41111111111111112", False, False, False),
        ("", False, False, False),
        (None, False, False, False),
    ],
)
def test_pii(spark, value, email, phone, card):
    c = F.col("t")
    column = F.array(text.has_email(c), text.has_phone(c), text.has_card(c))
    assert one(spark, [value], "t string", column) == [email, phone, card]
