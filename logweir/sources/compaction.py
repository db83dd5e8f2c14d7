"""Compaction of Parquet stores that gather many small files.

A store is a folder that jobs and streams append to. Compaction packs the small files of closed
parts (days, hours) into few large ones and publishes them by a manifest that readers follow:

    store/...               what the writers append
    store/_compact/<id>/    packed files of one run, by part
    store/_manifest/version=<n>/   one small file: which packed folders and files are live, and
                            which files they replace

The names begin with an underscore, so a plain read of the store skips them. A version is a
single file, committed by a rename: it is there whole or not at all. A run that fails before
leaves the version before, and its packed files are never read. Files that come late into a part
that was packed are no one's replacement: readers see them at once, and the next run packs them.

Replaced files stay until ``clean`` removes them, so readers that follow an older version end
well. The manifest has a row for each packed folder and each replaced file not yet removed; a run
takes MOST_FILES small files at most, of the parts that sort first, and the next one goes on.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from logweir.settings import materialize

TARGET_BYTES = 128 << 20
MOST_FILES = 100_000
GRACE_SECONDS = 3600
FOLDER, REPLACED = "folder", "replaced"
MANIFEST = "kind string, place string, at timestamp"
FILE, SIZE = "__file", "__size"


@dataclass(frozen=True)
class Result:
    """What a run did; ``version`` is None if there was nothing to pack."""

    version: int | None
    files_before: int = 0
    files_after: int = 0
    rows: int = 0


def _exists(reader, *paths: str) -> DataFrame | None:
    try:
        return reader.parquet(*paths)
    except AnalysisException as missing:
        if missing.getCondition() not in {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}:
            raise
        return None


def manifest(spark: SparkSession, path: str) -> tuple[int, list[Row]]:
    """(version, rows) of the latest manifest; version 0 has none."""
    rows = _exists(spark.read.schema(f"{MANIFEST}, version bigint"), f"{path}/_manifest")
    version = None if rows is None else rows.agg(F.max("version")).first()[0]
    if version is None:
        return 0, []
    return version, rows.filter(F.col("version") == version).collect()


def _publish(spark: SparkSession, path: str, version: int, rows: Sequence[Row | tuple]) -> None:
    """The switch. It fails if another run has published this version."""
    content = [tuple(r)[:3] for r in rows]
    spark.createDataFrame(content, MANIFEST).coalesce(1).write.mode("error").parquet(f"{path}/_manifest/version={version}")


def _live(spark: SparkSession, path: str, rows: Sequence[Row]) -> DataFrame | None:
    """All rows of the store by a manifest, with the file each comes from and its size."""
    replaced = [r.place for r in rows if r.kind == REPLACED]
    parts = [_exists(spark.read.option("basePath", path), path)]
    parts += [_exists(spark.read.option("basePath", r.place), r.place) for r in rows if r.kind == FOLDER]
    found = None
    for part in parts:
        if part is None:
            continue
        part = part.withColumns({FILE: F.col("_metadata.file_path"), SIZE: F.col("_metadata.file_size")})
        found = part if found is None else found.unionByName(part, allowMissingColumns=True)
    if found is None or not replaced:
        return found
    return found.filter(~F.col(FILE).isin(replaced))


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The store's rows, each once, whatever was packed; None before the first file."""
    found = _live(spark, path, manifest(spark, path)[1])
    return None if found is None else found.drop(FILE, SIZE)


def _small_files(live: DataFrame, closed: Column, parts: Sequence[str], target: int, most: int) -> DataFrame:
    """Files to pack, with the number of the packed file (``bin``) each goes to.

    Per part, the files in falling order of size fill bins one after the other; a part that
    would not get fewer files is left alone. Parts are taken in order until ``most`` files.
    """
    files = live.filter(closed).select(*parts, FILE, SIZE).distinct()
    in_part = Window.partitionBy(*parts)
    before = in_part.orderBy(F.desc(SIZE), FILE).rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum(SIZE).over(before), F.lit(0))
    packed = files.withColumn("fill", F.floor(filled / target))
    counted = packed.withColumns(
        {"files": F.count(F.lit(1)).over(in_part), "fills": F.max("fill").over(in_part)}
    )
    fewer = counted.filter(F.col("files") > F.col("fills") + 1)
    # One row a part: where its files lie in the order of all.
    sizes = fewer.groupBy(*parts).agg(F.max("files").alias("n"))
    ordered = sizes.withColumn("upto", F.sum("n").over(Window.orderBy(*parts)))
    taken = ordered.filter((F.col("upto") <= most) | (F.col("upto") == F.col("n"))).select(*parts)
    return fewer.join(taken, on=[fewer[p].eqNullSafe(taken[p]) for p in parts], how="left_semi")


def compact(
    spark: SparkSession,
    path: str,
    closed: Column,
    parts: Sequence[str],
    target_bytes: int = TARGET_BYTES,
    most_files: int = MOST_FILES,
) -> Result:
    """Pack the small files of the parts that ``closed`` (a condition on columns) selects.

    ``parts`` are the columns that packed files are laid out by. No writer may replace files
    of a closed part; it may add some.
    """
    version, rows = manifest(spark, path)
    live = _live(spark, path, rows)
    if live is None:
        return Result(None)
    files = materialize(_small_files(live, closed, parts, target_bytes, most_files), "small-files")
    # Dense numbers: each packed file is written by one task and is one file of its part.
    number = F.dense_rank().over(Window.orderBy(*parts, "fill")) - 1
    bins = materialize(files.select(F.col(FILE).alias("__place"), number.alias("__bin")), "small-file-bins")
    before, after = bins.count(), bins.select("__bin").distinct().count()
    if not before:
        return Result(None)
    folder = f"{path}/_compact/{uuid.uuid4().hex}"
    moved = live.join(bins, F.col(FILE) == F.col("__place")).drop(FILE, SIZE, "__place")
    moved.repartitionById(after, F.col("__bin")).drop("__bin").write.partitionBy(*parts).parquet(folder)
    packed = spark.read.option("basePath", folder).parquet(folder).count()
    wanted = live.join(bins, F.col(FILE) == F.col("__place"), "left_semi").count()
    if packed != wanted:
        raise ValueError(f"{packed} rows were packed, not {wanted}; nothing is switched")
    now = spark.range(1).select(F.current_timestamp()).first()[0]
    replaced = [(REPLACED, r[0], now) for r in bins.select("__place").collect()]
    _publish(spark, path, version + 1, [*rows, (FOLDER, folder, now), *replaced])
    return Result(version + 1, before, after, packed)


def clean(spark: SparkSession, path: str, grace_seconds: float = GRACE_SECONDS) -> int:
    """Remove files that were replaced ``grace_seconds`` ago; returns how many.

    After it, rows are only complete for readers that follow the manifest.
    """
    version, rows = manifest(spark, path)
    since = F.current_timestamp() - F.make_dt_interval(secs=F.lit(grace_seconds))
    before = spark.range(1).select(since).first()[0]
    gone = [r for r in rows if r.kind == REPLACED and r.at <= before]
    context = spark.sparkContext
    for r in gone:
        file = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(r.place))
        file.getFileSystem(context._jsc.hadoopConfiguration()).delete(file, False)
    if gone:
        _publish(spark, path, version + 1, [r for r in rows if r not in gone])
    return len(gone)
