"""Address, risk and routing rules as Column functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Private ranges as text prefixes (not CIDR arithmetic), risky
# ports, risk terms, topics, and the topic of an unknown severity.
PRIVATE_PREFIX = r"^(10\.|192\.168\.|172\.(1[6-9]|2[0-9]|3[01])\.)"
RISKY_PORTS = (22, 23, 3389, 1433, 3306, 5432)
RISKY_BYTES = 1_000_000
PORT_RISK = 0.3
EXTERNAL_RISK = 0.2
VOLUME_RISK = 0.2
FAILURE_RISK = 0.3
MAX_RISK = 1.0
FAILED = "FAILED"
TOPICS = {
    "CRITICAL": "network-logs-critical",
    "ERROR": "network-logs-error",
    "WARNING": "network-logs-warning",
    "INFO": "network-logs-info",
    "DEBUG": "network-logs-debug",
}
DEFAULT_TOPIC = "network-logs-info"
UNKNOWN_KEY = "unknown"


def is_internal_ip(ip: Column) -> Column:
    """True for text that starts like a private IPv4 address; NULL is external."""
    return F.coalesce(ip.rlike(PRIVATE_PREFIX), F.lit(False))


def traffic_direction(source: Column, destination: Column) -> Column:
    src, dst = is_internal_ip(source), is_internal_ip(destination)
    return (
        F.when(src, F.when(dst, "internal").otherwise("outbound"))
        .when(dst, "inbound")
        .otherwise("external")
    )


def risk_score(
    destination_port: Column,
    source_ip: Column,
    bytes_sent: Column,
    status: Column,
    ports: Sequence[int] = RISKY_PORTS,
) -> Column:
    """Sum of four terms in doubles; a missing source counts as external."""

    def term(condition: Column, weight: float) -> Column:
        return F.when(condition, weight).otherwise(0.0)

    total = (
        term(destination_port.isin(*ports), PORT_RISK)
        + term(~is_internal_ip(source_ip), EXTERNAL_RISK)
        + term(bytes_sent > RISKY_BYTES, VOLUME_RISK)
        + term(status == FAILED, FAILURE_RISK)
    )
    return F.least(total, F.lit(MAX_RISK))


def topic_for(severity: Column, topics: Mapping[str, str] = TOPICS) -> Column:
    """Topic of a severity in any letter case; unknown ones share the default."""
    table = F.create_map(*[F.lit(x) for pair in topics.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.upper(severity)), F.lit(DEFAULT_TOPIC))


def partition_key(ip: Column) -> Column:
    """Text after the last dot; an empty key is NULL, an absent address ``unknown``."""
    last = F.substring_index(F.coalesce(ip, F.lit(UNKNOWN_KEY)), ".", -1)
    return F.nullif(last, F.lit(""))


def ipv4_number(ip: Column) -> Column:
    """A dotted IPv4 address as a number, NULL for anything else."""
    part = [F.try_element_at(F.split(ip, "[.]"), F.lit(i)).try_cast("bigint") for i in range(1, 5)]
    value = part[0] * 16777216 + part[1] * 65536 + part[2] * 256 + part[3]
    valid = ip.rlike(r"^[0-9]{1,3}([.][0-9]{1,3}){3}$") & (F.greatest(*part) <= 255)
    return F.when(valid, value)
