"""What several corpus operators share: tables, words, stored intermediate results."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.settings import configure, materialize, work_folder

__all__ = ["flat_bytes", "materialize", "own_columns", "pieces", "prepare", "table", "utf8", "work_folder"]

#: Rows of an Arrow batch: with texts of a megabyte a batch stays within a worker's memory.
BATCH_ROWS = 500


_sent: set[str] = set()


def send_package(spark: SparkSession) -> None:
    """Let Spark hand this package to the executors, which need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _sent:
        return
    package = Path(__file__).resolve().parent.parent
    folder = tempfile.mkdtemp(prefix="logweir-")
    atexit.register(shutil.rmtree, folder, True)  # Spark hands it out until the application ends
    path = Path(folder) / "logweir-package.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(path))
    _sent.add(context.applicationId)


def prepare(spark: SparkSession) -> None:
    """Settings of the corpus queries: UTC and small Arrow batches; code for the executors."""
    send_package(spark)
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: str) -> Column:
    """The text's bytes; null is empty."""
    return F.coalesce(F.col(text).cast("binary"), F.lit(b""))


def own_columns(df: DataFrame, made: list[str]) -> list[str]:
    """The caller's columns except those that the operator makes anew."""
    taken = {c.lower() for c in made}
    return [c for c in df.columns if c.lower() not in taken]


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the binary ``column`` holds at most ``most`` bytes, or one row.

    Nulls are not allowed in the column; empty batches are left out.
    """
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch[column]).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(ends):
            before = int(ends[start - 1]) if start else 0
            stop = max(int(np.searchsorted(ends, before + most, side="right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary array without nulls; views, the first offset is 0."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets.astype(np.int64) - int(offsets[0])
