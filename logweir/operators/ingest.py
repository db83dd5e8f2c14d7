"""Accounting of what was accepted, rejected and written."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from logweir.functions import network
from logweir.operators import enrich as E
from logweir.operators import records


def _checked(
    raw: DataFrame,
    now: Column | datetime | None,
    hostname: str | None,
    topics: Mapping[str, str] = network.TOPICS,
) -> DataFrame:
    """Every raw row as a queue record with its reject reason: one projection."""
    marked = raw.withColumn("reject_reason", E.reject_reason(raw))
    enriched = E.enrich(marked, now=now, hostname=hostname, carry=("reject_reason",))
    return records.to_records(enriched, topics, carry=("reject_reason",))


def _counts() -> dict[str, Column]:
    ok = F.col("reject_reason").isNull()
    return {
        "total": F.count(F.lit(1)),
        "success": F.count_if(ok),
        "failed": F.count_if(~ok),
        "bytes_sent": F.coalesce(F.sum(F.when(ok, F.octet_length("value"))), F.lit(0)),
    }


def summary(raw: DataFrame, now: Column | datetime | None = None, hostname: str | None = None) -> DataFrame:
    """One row: total, success, failed, bytes of JSON, success rate (0 for no rows)."""
    counts = _checked(raw, now, hostname).agg(*[c.alias(n) for n, c in _counts().items()])
    rate = F.when(F.col("total") > 0, F.col("success") / F.col("total")).otherwise(0.0)
    return counts.withColumn("success_rate", rate)


def by_topic(
    raw: DataFrame,
    now: Column | datetime | None = None,
    hostname: str | None = None,
    topics: Mapping[str, str] = network.TOPICS,
) -> DataFrame:
    """Accepted records and bytes per topic."""
    sent = records.producer_records(raw, now=now, hostname=hostname, topics=topics)
    return sent.groupBy("topic").agg(
        F.count(F.lit(1)).alias("success"), F.sum(F.octet_length("value")).alias("bytes_sent")
    )


def send_batch(
    raw: DataFrame,
    write: Callable[[DataFrame], None],
    now: Column | datetime | None = None,
    hostname: str | None = None,
    topics: Mapping[str, str] = network.TOPICS,
) -> dict[str, float]:
    """Write the accepted records with ``write`` in one job and count on the way.

    ``write`` gets a (topic, key, value) frame and must run exactly one action.
    """
    seen = Observation()
    checked = _checked(raw, now, hostname, topics).observe(seen, *[c.alias(n) for n, c in _counts().items()])
    start = time.monotonic()
    write(checked.filter(F.col("reject_reason").isNull()).drop("reject_reason"))
    elapsed = time.monotonic() - start
    result = dict(seen.get)
    result["success_rate"] = result["success"] / result["total"] if result["total"] else 0.0
    result["processing_time"] = elapsed
    result["throughput_msg_sec"] = result["total"] / elapsed if elapsed > 0 else 0.0
    return result
