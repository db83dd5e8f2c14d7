"""The partitioned Parquet store of logs, and the compaction of the stores."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.operators.quality import PARTITIONS, with_partitions
from logweir.sources import compaction


def write_logs(logs: DataFrame, path: str, mode: str = "append") -> None:
    """Append logs by year, month, day and hour of their event time.

    The rebalance hint makes whole files per hour; adaptive execution cuts an
    hour with many rows into several tasks instead of one.
    """
    parts = with_partitions(logs).hint("rebalance", *PARTITIONS)
    parts.write.mode(mode).partitionBy(*PARTITIONS).parquet(path)


def read_logs(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored logs, packed or not; None before the first."""
    return compaction.read(spark, path)


def compact_logs(spark: SparkSession, path: str, before: datetime, **limits) -> compaction.Result:
    """Pack the hours that end by ``before``."""
    hour = F.make_timestamp("year", "month", "day", "hour", F.lit(0), F.lit(0))
    closed = hour + F.expr("interval 1 hour") <= F.lit(before)
    return compaction.compact(spark, path, closed, PARTITIONS, **limits)


def compact_alerts(spark: SparkSession, path: str, before: date, **limits) -> compaction.Result:
    """Pack the alert store's days before a date.

    The last batch of each run is left alone: it may be written again.
    """
    folder = f"{path}/alerts"
    stored = compaction.read(spark, folder)
    if stored is None:
        return compaction.Result(None)
    last = stored.groupBy("run").agg(F.max("batch_id").alias("last")).collect()
    closed = reduce(
        lambda a, r: a & ~((F.col("run") == r["run"]) & (F.col("batch_id") == r["last"])),
        last,
        F.col("day") < F.lit(before),
    )
    return compaction.compact(spark, folder, closed, ("day",), **limits)
