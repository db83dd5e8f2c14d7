"""Queue records: encode logs for the queue, decode and check what comes back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.functions import network
from logweir.operators import enrich as E
from logweir.schema import LOG, LOG_FIELDS

# Fixed values of the one-topic producer.
SIMPLE_TOPIC = "network-logs"
SIMPLE_KEY = "default"
# Topics of results.
METRICS_TOPIC = "processed-metrics"
ALERTS_TOPIC = "network-alerts"

# Microseconds and a zone in the text, whatever the session's zone is.
WRITE_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timeZone": "UTC",
}
READ_OPTIONS = {"timeZone": "UTC"}


def encode(*columns: Column | str) -> Column:
    """One JSON object; NULL fields are written as null."""
    return F.to_json(F.struct(*columns), WRITE_OPTIONS)


def to_records(
    logs: DataFrame, topics: Mapping[str, str] = network.TOPICS, carry: Sequence[str] = ()
) -> DataFrame:
    """Enriched logs in the shape of a queue sink."""
    return logs.select(
        *carry,
        network.topic_for(F.col("severity"), topics).alias("topic"),
        network.partition_key(F.col("source_ip")).alias("key"),
        encode(*LOG_FIELDS).alias("value"),
    )


def producer_records(
    raw: DataFrame,
    now: Column | datetime | None = None,
    hostname: str | None = None,
    topics: Mapping[str, str] = network.TOPICS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Raw logs to (topic, key, value); records that cannot be sent are left out."""
    return to_records(E.logs(raw, now=now, hostname=hostname, carry=carry), topics, carry)


def simple_records(raw: DataFrame, now: Column | datetime | None = None) -> DataFrame:
    """The one-topic variant: whole address as key, five fields, no defaults."""
    fields = [E.field(raw, name).alias(name) for name in ("timestamp", "source_ip", "severity", "message")]
    return raw.select(
        F.lit(SIMPLE_TOPIC).alias("topic"),
        F.coalesce(E.field(raw, "source_ip"), F.lit(SIMPLE_KEY)).alias("key"),
        encode(*fields, E.as_time(now).alias("ingestion_time")).alias("value"),
    )


def result_records(rows: DataFrame, topic: str) -> DataFrame:
    """Metrics or alerts in the shape of a queue sink, keyed like the logs."""
    return rows.select(
        F.lit(topic).alias("topic"),
        network.partition_key(F.col("source_ip")).alias("key"),
        encode(*rows.columns).alias("value"),
    )


def consumed_records(queue: DataFrame) -> DataFrame:
    """Records with their queue metadata; absent headers are an empty map."""
    empty = F.create_map().cast("map<string,binary>")
    if "headers" not in queue.columns:
        headers = empty
    elif isinstance(queue.schema["headers"].dataType, T.MapType):
        headers = F.coalesce(F.col("headers"), empty)
    else:
        headers = F.coalesce(F.map_from_entries("headers"), empty)
    return queue.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.nullif(F.col("key").cast("string"), F.lit("")).alias("key"),
        F.col("value").cast("string").alias("value"),
        headers.alias("headers"),
    )


def simple_consumed(queue: DataFrame, schema: T.StructType = LOG) -> DataFrame:
    """Partition, offset and the decoded record."""
    return queue.select("partition", "offset", _decode(queue, schema).alias("data"))


def _decode(queue: DataFrame, schema: T.StructType) -> Column:
    return F.from_json(F.col("value").cast("string"), schema, READ_OPTIONS)


def fields(*names: str, schema: T.StructType = LOG) -> T.StructType:
    """The part of a schema a reader needs; the event time is always in it."""
    return T.StructType([f for f in schema.fields if f.name == "timestamp" or f.name in names])


def parse(queue: DataFrame, schema: T.StructType = LOG) -> DataFrame:
    """Queue records to typed logs. Rows without a readable event time are dropped.

    A plain projection would let the filter move below it and parse every record
    twice, once to test it and once to keep it; ``inline`` holds the filter above.
    """
    return queue.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.inline(F.array(_decode(queue, schema))),
    ).filter(F.col("timestamp").isNotNull())


def parse_rejects(queue: DataFrame, schema: T.StructType = LOG) -> DataFrame:
    """The complement of :func:`parse`: raw value and why it was dropped.

    The reasons are worked out after the filter, for the dropped rows only.
    """
    value = F.col("value").cast("string")
    time = _decode(queue, fields(schema=schema))["timestamp"]
    dropped = queue.filter(time.isNull()).withColumn("value", value)
    json = F.try_parse_json("value")
    reason = (
        F.when(F.col("value").isNull(), "null_value")
        .when(json.isNull(), "not_json")
        .when(~F.schema_of_variant(json).startswith("OBJECT"), "not_an_object")
        .when(F.try_variant_get(json, "$.timestamp", "string").isNull(), "missing_timestamp")
        .otherwise("bad_timestamp")
    )
    return dropped.withColumn("parse_reason", reason)
