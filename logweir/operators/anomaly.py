"""Anomaly flags, score and level of a metrics row: projections only."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.operators.enrich import as_time
from logweir.settings import Thresholds

# The flags and their order.
FLAGS = (
    "high_volume_anomaly",
    "high_latency_anomaly",
    "high_failure_rate_anomaly",
    "data_exfiltration_anomaly",
    "port_scanning_anomaly",
    "high_risk_anomaly",
)


def with_flags(metrics: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    t = thresholds
    conditions = (
        F.col("log_count") > t.log_count,
        F.col("avg_response_time") > t.avg_response_ms,
        F.col("failure_rate") > t.failure_rate,
        F.col("total_bytes_sent") > t.bytes_sent,
        F.col("unique_ports") > t.unique_ports,
        F.col("max_risk_score") > t.risk,
    )
    return metrics.select("*", *[c.alias(name) for name, c in zip(FLAGS, conditions)])


def score(thresholds: Thresholds = Thresholds()) -> Column:
    """Weighted sum in doubles, added in the order of the flags.

    The order matters in the last bit: one flag combination ends just above 0.7.
    A NULL flag makes the score NULL.
    """
    w = thresholds.weights
    weights = (w.volume, w.latency, w.failure, w.exfiltration, w.ports, w.risk)
    terms = [F.col(flag).cast("int") * weight for flag, weight in zip(FLAGS, weights)]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def level(score: Column, thresholds: Thresholds = Thresholds()) -> Column:
    (name, cut), *rest = thresholds.levels
    chain = F.when(score > cut, name)
    for name, cut in rest:
        chain = chain.when(score > cut, name)
    return chain.otherwise(thresholds.base_level)


def detect(
    metrics: DataFrame, thresholds: Thresholds = Thresholds(), now: Column | datetime | None = None
) -> DataFrame:
    """All metric columns, six flags, score, verdict, level and detection time."""
    return (
        with_flags(metrics, thresholds)
        .withColumn("anomaly_score", score(thresholds))
        .withColumn("is_anomaly", F.col("anomaly_score") > thresholds.anomaly_score)
        .withColumn("anomaly_level", level(F.col("anomaly_score"), thresholds))
        .withColumn("detected_at", as_time(now))
    )


def simple_anomalies(metrics: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """The simple variant: keep rows of high volume or high latency."""
    return metrics.filter(
        (F.col("log_count") > thresholds.log_count)
        | (F.col("avg_response_time") > thresholds.avg_response_ms)
    )
