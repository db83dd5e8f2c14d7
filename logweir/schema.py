"""Schemas shared by the batch and the streaming side."""

from pyspark.sql import types as T

# Fields of raw and of enriched logs.
RAW = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("source_ip", T.StringType()),
        T.StructField("destination_ip", T.StringType()),
        T.StructField("source_port", T.IntegerType()),
        T.StructField("destination_port", T.IntegerType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("log_level", T.StringType()),
        T.StructField("bytes_sent", T.LongType()),
        T.StructField("bytes_received", T.LongType()),
        T.StructField("response_time", T.DoubleType()),
        T.StructField("connection_status", T.StringType()),
        T.StructField("log_source", T.StringType()),
        T.StructField("hostname", T.StringType()),
    ]
)

LOG = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("source_ip", T.StringType()),
        T.StructField("destination_ip", T.StringType()),
        T.StructField("source_port", T.IntegerType()),
        T.StructField("destination_port", T.IntegerType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("log_level", T.StringType()),
        T.StructField("bytes_sent", T.LongType()),
        T.StructField("bytes_received", T.LongType()),
        T.StructField("response_time_ms", T.DoubleType()),
        T.StructField("connection_status", T.StringType()),
        T.StructField("ingestion_time", T.TimestampType()),
        T.StructField("processing_date", T.StringType()),
        T.StructField("log_source", T.StringType()),
        T.StructField("hostname", T.StringType()),
        T.StructField("data_version", T.StringType()),
        T.StructField("is_internal_ip", T.BooleanType()),
        T.StructField("traffic_direction", T.StringType()),
        T.StructField("risk_score", T.DoubleType()),
    ]
)

# The five fields of the one-topic producer, with the raw field the simple
# metrics read.
SIMPLE_LOG = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("source_ip", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("ingestion_time", T.TimestampType()),
        T.StructField("response_time", T.DoubleType()),
    ]
)

# What a queue scan delivers. ``value`` is text here and binary from a broker;
# readers cast it.
QUEUE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
    ]
)

RAW_FIELDS = tuple(RAW.fieldNames())
LOG_FIELDS = tuple(LOG.fieldNames())


# ---- stores of the streams

#: The actions of alerts as stored, and those of the simple variant.
ACTIONS = "alert_id string, action string, run string, batch_id bigint"
#: The verdicts of the alert store.
ALERTS = (
    "window_start timestamp, window_end timestamp, source_ip string, traffic_direction string, severity string, "
    "log_count bigint, failure_rate double, avg_response_time double, total_bytes_sent bigint, "
    "unique_destinations bigint, unique_ports bigint, anomaly_score double, anomaly_level string, "
    "detected_at timestamp, high_volume_anomaly boolean, high_latency_anomaly boolean, "
    "high_failure_rate_anomaly boolean, data_exfiltration_anomaly boolean, port_scanning_anomaly boolean, "
    "high_risk_anomaly boolean, alert_id string, alert_message string, is_anomaly boolean, transition string, "
    "written_at timestamp, run string, batch_id bigint, day date"
)
#: Alerts that are raised in windows still open; ``latest`` is the start of the latest window seen.
OPEN_ALERTS = "alert_id string, window_end timestamp, latest timestamp, batch bigint"
