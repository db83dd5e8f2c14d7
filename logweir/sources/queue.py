"""Queue scans and sinks: a Kafka broker, or files of the same shape.

The Kafka connector (``spark-sql-kafka-0-10``) must be on the class path for the
first kind. Files serve where there is no broker.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from logweir.schema import QUEUE

# Offsets per trigger, and the client settings passed through to
# the broker; the caller's own settings win.
MAX_OFFSETS = 10_000
PRODUCER = {
    "kafka.batch.size": "32768",
    "kafka.linger.ms": "5",
    "kafka.buffer.memory": "67108864",
    "kafka.acks": "all",
    "kafka.retries": "5",
    "kafka.retry.backoff.ms": "100",
    "kafka.request.timeout.ms": "30000",
    "kafka.compression.type": "snappy",
}
CONSUMER = {
    "kafka.session.timeout.ms": "30000",
    "kafka.max.poll.records": "1000",
    "kafka.fetch.max.bytes": "52428800",
}


def read_options(servers: str, topics: Sequence[str], options: Mapping[str, str] | None = None) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "includeHeaders": "true",
        **CONSUMER,
        **(options or {}),
    }


def write_options(servers: str, options: Mapping[str, str] | None = None) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, **PRODUCER, **(options or {})}


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str],
    starting: str = "latest",
    max_offsets: int | None = MAX_OFFSETS,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Unbounded scan of the topics. ``max_offsets=None`` reads all there is at each trigger."""
    rate = {"startingOffsets": starting}
    if max_offsets is not None:
        rate["maxOffsetsPerTrigger"] = str(max_offsets)
    settings = read_options(servers, topics, {**rate, **(options or {})})
    return spark.readStream.format("kafka").options(**settings).load()


def kafka_batch(
    spark: SparkSession, servers: str, topics: Sequence[str], options: Mapping[str, str] | None = None
) -> DataFrame:
    """Bounded scan: everything in the topics now."""
    bounds = {"startingOffsets": "earliest", "endingOffsets": "latest"}
    settings = read_options(servers, topics, {**bounds, **(options or {})})
    return spark.read.format("kafka").options(**settings).load()


def write_kafka(records: DataFrame, servers: str, options: Mapping[str, str] | None = None) -> None:
    """(topic, key, value) rows to the broker; the row names its topic."""
    records.write.format("kafka").options(**write_options(servers, options)).save()


def stream_to_kafka(
    records: DataFrame, servers: str, checkpoint: str, options: Mapping[str, str] | None = None
) -> DataStreamWriter:
    writer = records.writeStream.format("kafka").options(**write_options(servers, options))
    return writer.option("checkpointLocation", checkpoint)


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Unbounded scan of queue records kept as Parquet files."""
    reader = spark.readStream.schema(QUEUE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def file_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QUEUE).parquet(path)


def write_files(records: DataFrame, path: str) -> None:
    """(topic, key, value) rows as Parquet, one folder per topic."""
    records.write.mode("append").partitionBy("topic").parquet(path)
