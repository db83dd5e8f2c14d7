"""Parameters of the analytics, session settings, and the shared work folder."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Level cuts on the anomaly score, highest first.
LEVELS = (("CRITICAL", 0.7), ("HIGH", 0.5), ("MEDIUM", 0.3))
# The other set of cuts the configuration declares. Pass it as
# Thresholds(levels=DECLARED_LEVELS).
DECLARED_LEVELS = (("CRITICAL", 0.8), ("HIGH", 0.7), ("MEDIUM", 0.5))


@dataclass(frozen=True)
class Weights:
    """Share of each flag in the anomaly score."""

    volume: float = 0.2
    latency: float = 0.15
    failure: float = 0.25
    exfiltration: float = 0.3
    ports: float = 0.05
    risk: float = 0.05


@dataclass(frozen=True)
class Thresholds:
    """Every comparison is strictly greater than the value given here.

    ``log_count`` applies to the whole window, not to a minute of it.
    """

    log_count: int = 1000
    avg_response_ms: float = 5000.0
    failure_rate: float = 0.1
    bytes_sent: int = 10_485_760
    unique_ports: int = 50
    risk: float = 0.8
    weights: Weights = Weights()
    anomaly_score: float = 0.3
    levels: tuple[tuple[str, float], ...] = LEVELS
    base_level: str = "LOW"
    connection_attempts: int = 100


@dataclass(frozen=True)
class WindowSpec:
    """Event-time window in seconds; ``watermark`` acts on streams only."""

    duration: int = 300
    slide: int = 60
    watermark: int = 120

    @property
    def panes(self) -> int | None:
        """Slides per window, or None when the slide does not divide the window."""
        return None if self.duration % self.slide else self.duration // self.slide


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def configure(
    spark: SparkSession, shuffle_partitions: int | None = None, rocksdb: bool = False
) -> SparkSession:
    """Event times are UTC everywhere. Sizes belong to the submit command.

    Set ``shuffle_partitions`` before the first start of a stream: its checkpoint
    keeps the number. ``rocksdb`` holds stream state on disk instead of the heap.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if rocksdb:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that every executor can reach: under ``spark.checkpoint.dir``, else
    under the checkpoint folder of the context, else under the warehouse. On a cluster the
    warehouse is taken only if it is no folder of the driver's own machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir", None)
        local = base and base.split(":")[0] in ("file", base)
        if not base or local and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write once, read back: for a frame whose plan several branches would repeat."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
