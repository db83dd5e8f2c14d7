"""Null handling, quality measures, late logs, partition columns, retention, privacy.

The reference material only declares these by a parameter; the meaning given in
each docstring is the plain reading of that parameter.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.functions import text
from logweir.functions.network import FAILED
from logweir.operators.enrich import reject_reason
from logweir.schema import RAW_FIELDS
from logweir.settings import Thresholds

# Fixed values.
QUALITY_THRESHOLD = 0.90
COMPLETENESS_THRESHOLD = 0.85
LATE_SECONDS = 600
RETENTION_DAYS = 90
REQUIRED = ("timestamp", "source_ip", "severity")
PARTITIONS = ("year", "month", "day", "hour")


def handle_nulls(raw: DataFrame, mode: str = "default", required: Sequence[str] = REQUIRED) -> DataFrame:
    """``default`` leaves NULLs to the defaults of enrichment, ``skip`` drops rows
    with a NULL required field, ``error`` fails the job on the first such row."""
    if mode == "default":
        return raw
    if mode == "skip":
        return raw.dropna(subset=list(required))
    if mode == "error":
        whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
        failure = F.raise_error(F.lit(f"NULL in a required field of {', '.join(required)}"))
        return raw.filter(F.when(whole, F.lit(True)).otherwise(failure.cast("boolean")))
    raise ValueError(f"unknown null handling: {mode}")


def data_quality(
    raw: DataFrame,
    quality: float = QUALITY_THRESHOLD,
    completeness: float = COMPLETENESS_THRESHOLD,
) -> DataFrame:
    """One row: share of non-NULL raw fields, share of rows not rejected, and verdicts."""
    present = [F.count(c) for c in RAW_FIELDS if c in raw.columns]
    filled = reduce(lambda a, b: a + b, present, F.lit(0).cast("bigint"))
    total = F.count(F.lit(1))
    shares = raw.agg(
        total.alias("total_rows"),
        F.try_divide(filled.cast("double"), total * len(RAW_FIELDS)).alias("completeness"),
        F.try_divide(F.count_if(reject_reason(raw).isNull()).cast("double"), total).alias("quality"),
    )
    return shares.withColumn("completeness_ok", F.col("completeness") >= completeness).withColumn(
        "quality_ok", F.col("quality") >= quality
    )


def late_logs(logs: DataFrame, seconds: int = LATE_SECONDS) -> DataFrame:
    """Logs that came in more than ``seconds`` after their event time."""
    delay = F.unix_micros("ingestion_time") - F.unix_micros("timestamp")
    return logs.filter(delay > seconds * 1_000_000)


def failed_attempts(
    logs: DataFrame, thresholds: Thresholds = Thresholds(), watermark: int | None = None
) -> DataFrame:
    """Minutes in which a source failed to connect more often than allowed.

    On a stream ``watermark`` (seconds) says how late a failure may come after others; minutes
    are emitted when they are closed.
    """
    marked = logs if watermark is None else logs.withWatermark("timestamp", f"{watermark} seconds")
    return (
        marked.filter(F.col("connection_status") == FAILED)
        .groupBy(F.window("timestamp", "1 minute").alias("window"), "source_ip")
        .agg(F.count(F.lit(1)).alias("failed_connections"))
        .filter(F.col("failed_connections") > thresholds.connection_attempts)
    )


def with_partitions(df: DataFrame, time: Column | str = "timestamp") -> DataFrame:
    """Year, month, day and hour of the event time, for a partitioned store."""
    time = F.col(time) if isinstance(time, str) else time
    parts = (F.year(time), F.month(time), F.dayofmonth(time), F.hour(time))
    return df.withColumns(dict(zip(PARTITIONS, parts)))


def retained(df: DataFrame, as_of: datetime, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows of the last ``days`` days. On a store partitioned by
    :func:`with_partitions` older partitions are not read at all."""
    cutoff = F.lit(as_of).cast("timestamp") - F.make_dt_interval(days=F.lit(days))
    kept = df.filter(F.col("timestamp") >= cutoff)
    if set(PARTITIONS) <= set(df.columns):
        kept = kept.filter(F.make_date("year", "month", "day") >= F.to_date(cutoff))
    return kept


def masked(logs: DataFrame, columns: Sequence[str] = ("source_ip", "destination_ip")) -> DataFrame:
    """Addresses with a zero last octet."""
    return logs.withColumns({c: text.mask_ip(F.col(c)) for c in columns})


def anonymized(
    logs: DataFrame, salt: str, columns: Sequence[str] = ("source_ip", "destination_ip")
) -> DataFrame:
    """Addresses replaced by salted hashes, equal addresses by equal hashes."""
    return logs.withColumns({c: text.anonymize(F.col(c), salt) for c in columns})


def pii_flags(df: DataFrame, column: str = "message") -> DataFrame:
    """Whether the whole text has an e-mail address, a phone or a card number."""
    value = F.col(column)
    return df.withColumns(
        {
            "has_email": text.has_email(value),
            "has_phone": text.has_phone(value),
            "has_card": text.has_card(value),
        }
    )
