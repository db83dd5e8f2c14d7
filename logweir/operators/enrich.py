"""Raw log records to the fixed 21-column log, and the rows that cannot get there."""

from __future__ import annotations

import socket
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.functions import network
from logweir.schema import LOG, RAW, RAW_FIELDS

# Defaults of absent fields.
DEFAULT_PROTOCOL = "TCP"
DEFAULT_SEVERITY = "INFO"
DEFAULT_LOG_LEVEL = "INFO"
DEFAULT_STATUS = "UNKNOWN"
DEFAULT_LOG_SOURCE = "unknown"
DATA_VERSION = "1.0"

# Decimal text a float may be written in; Java alone would also take "1d" or "0x1p3".
FLOAT_TEXT = r"^\s*[+-]?(([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?|(?i:nan|inf|infinity))\s*$"


def field(raw: DataFrame, name: str) -> Column:
    """A raw field; one the frame does not have is NULL, as is an absent key."""
    return F.col(name) if name in raw.columns else F.lit(None).cast(RAW[name].dataType)


def _number(raw: DataFrame, name: str, kind: str) -> Column:
    """A numeric field; text that is no number gives NULL instead of failing the job."""
    value = field(raw, name)
    number = value.try_cast(kind)
    if kind == "double" and name in raw.columns and raw.schema[name].dataType.typeName() == "string":
        number = F.when(value.rlike(FLOAT_TEXT), number)
    return number


def _or_zero(raw: DataFrame, name: str, kind: str) -> Column:
    """Zero when absent. A value that is no number stays NULL: it is a reject."""
    return F.when(field(raw, name).isNull(), F.lit(0).cast(kind)).otherwise(_number(raw, name, kind))


# Types whose every value is a number of the wanted kind.
WHOLE = ("tinyint", "smallint", "int", "bigint")
SAFE = {"bigint": WHOLE, "double": (*WHOLE, "float", "double")}
NUMBERS = {"bytes_sent": "bigint", "bytes_received": "bigint", "response_time": "double"}


def _unreadable(raw: DataFrame) -> dict[str, Column]:
    """The numeric fields that can hold something else, and when they do."""
    types = dict(raw.dtypes)
    return {
        name: field(raw, name).isNotNull() & _number(raw, name, kind).isNull()
        for name, kind in NUMBERS.items()
        if name in types and types[name] not in SAFE[kind]
    }


def reject_reason(raw: DataFrame) -> Column:
    """Why a record cannot be sent, in the order the checks apply; NULL if it can."""
    checks = [(f"bad_{name}", bad) for name, bad in _unreadable(raw).items()]
    checks.append(("missing_source_ip", field(raw, "source_ip").isNull()))
    return F.coalesce(*[F.when(failed, reason) for reason, failed in checks])


def accepted(raw: DataFrame) -> DataFrame:
    """Rows without a reject reason, as plain conditions that a scan can apply."""
    rows = raw.filter(field(raw, "source_ip").isNotNull())
    for bad in _unreadable(raw).values():
        rows = rows.filter(~bad)
    return rows


def rejected(raw: DataFrame) -> DataFrame:
    """The complement of :func:`accepted`, with a ``reject_reason`` column."""
    return raw.withColumn("reject_reason", reject_reason(raw)).filter(F.col("reject_reason").isNotNull())


def as_time(now: Column | datetime | None) -> Column:
    if now is None:
        return F.current_timestamp()
    return now if isinstance(now, Column) else F.lit(now)


def enrich(
    raw: DataFrame,
    now: Column | datetime | None = None,
    hostname: str | None = None,
    carry: Sequence[str] = (),
    risky_ports: Sequence[int] = network.RISKY_PORTS,
) -> DataFrame:
    """Defaults, normalisation, metadata and derived fields in one projection.

    ``now`` and ``hostname`` make the result repeatable; ``carry`` names raw
    columns to keep in front. An unreadable timestamp text becomes NULL and is
    dropped by the reader, it does not become ``now``.
    """
    time = as_time(now)
    source, destination = field(raw, "source_ip"), field(raw, "destination_ip")
    port = field(raw, "destination_port").try_cast("int")
    sent = _or_zero(raw, "bytes_sent", "bigint")
    status = field(raw, "connection_status")

    def text(name: str, default: str) -> Column:
        return F.coalesce(field(raw, name), F.lit(default))

    stamp = field(raw, "timestamp")
    columns = {
        "timestamp": F.when(stamp.isNull(), time).otherwise(stamp.try_cast("timestamp")),
        "source_ip": source,
        "destination_ip": destination,
        "source_port": field(raw, "source_port").try_cast("int"),
        "destination_port": port,
        "protocol": F.upper(text("protocol", DEFAULT_PROTOCOL)),
        "severity": F.upper(text("severity", DEFAULT_SEVERITY)),
        "message": text("message", ""),
        "log_level": F.upper(text("log_level", DEFAULT_LOG_LEVEL)),
        "bytes_sent": sent,
        "bytes_received": _or_zero(raw, "bytes_received", "bigint"),
        "response_time_ms": _or_zero(raw, "response_time", "double"),
        "connection_status": text("connection_status", DEFAULT_STATUS),
        "ingestion_time": time,
        "processing_date": F.date_format(time, "yyyy-MM-dd"),
        "log_source": text("log_source", DEFAULT_LOG_SOURCE),
        "hostname": text("hostname", hostname if hostname is not None else socket.gethostname()),
        "data_version": F.lit(DATA_VERSION),
        "is_internal_ip": network.is_internal_ip(source),
        "traffic_direction": network.traffic_direction(source, destination),
        "risk_score": network.risk_score(port, source, sent, status, risky_ports),
    }
    return raw.select(
        *carry, *[columns[field.name].cast(field.dataType).alias(field.name) for field in LOG.fields]
    )


def logs(raw: DataFrame, **options) -> DataFrame:
    """The records that can be sent, enriched."""
    return enrich(accepted(raw), **options)


def schema_problems(raw: DataFrame) -> list[str]:
    """Raw fields that are absent or of a type other than the raw schema's."""
    types = dict(raw.dtypes)
    wanted = {field.name: field.dataType.simpleString() for field in RAW.fields}
    problems = []
    for name in RAW_FIELDS:
        if name not in types:
            problems.append(f"{name}: absent")
        elif types[name] != wanted[name] and not (name == "timestamp" and types[name] == "timestamp"):
            problems.append(f"{name}: {types[name]} instead of {wanted[name]}")
    return problems
