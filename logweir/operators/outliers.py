"""Statistical outliers of window metrics and of hourly series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.settings import materialize

# Fixed values.
Z_THRESHOLD = 3.0
MODIFIED_Z_THRESHOLD = 3.5
MODIFIED_Z_FACTOR = 0.6745
TREND_ROWS = 100
# The sketch errs by a ten-thousandth of the ranks; the bracket is ten times as wide.
ACCURACY = 10_000
BRACKET = 0.001
# Parts into which the rows of each key are dealt; a constant, whatever the size of the data.
SALTS = 16


def _bracket(value: str) -> Column:
    """Two values between which the median lies, from a sketch of fixed size."""
    shares = [0.5 - BRACKET, 0.5 + BRACKET]
    return F.percentile_approx(value, shares, ACCURACY).alias("bracket")


def _salted(rows: DataFrame, of_key: DataFrame, value: str) -> DataFrame:
    """Rows with what ``of_key`` says of their ``k``.

    Each key is dealt into ``SALTS`` parts by value and the other side repeated as often, so a
    key with a third of all rows is not one partition, and what follows is shuffled anew.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(value), F.lit(SALTS)).cast("int"))
    return salted.join(of_key.withColumn("salt", salts), ["k", "salt"]).drop("salt")


def _median(rows: DataFrame, brackets: DataFrame, value: str, name: str) -> DataFrame:
    """Exact median per ``k``, NULL where it is not finite.

    ``brackets`` has two values per key between which the median lies. Values outside only
    count, as one row on either side, so of a key that owns a third of all rows a
    five-hundredth part is sorted in one place. Counts are combined before they are shuffled.
    """
    low, high = F.col("bracket")[0], F.col("bracket")[1]
    side = F.when(F.col(value) < low, -1).when(F.col(value) > high, 1).otherwise(0)
    ordered = Window.partitionBy("k").orderBy("side", "inside")
    upto, n, total = F.col("upto"), F.col("n"), F.col("total")

    def at(rank: Column, field: str) -> Column:
        return F.max(F.when((upto >= rank) & (upto - n < rank), F.col(field)))

    ranks = F.floor((total + 1) / 2), F.floor((total + 2) / 2)
    middle = (at(ranks[0], "inside") + at(ranks[1], "inside")) / 2
    missed = at(ranks[0], "side") * at(ranks[0], "side") + at(ranks[1], "side") * at(ranks[1], "side")
    failure = F.raise_error(F.lit("the median lies outside its bracket")).cast("double")
    finite = ~F.isnan("middle") & (F.abs("middle") < float("inf"))
    return (
        _salted(rows, brackets, value)
        .select("k", side.alias("side"), F.when(side == 0, F.col(value)).alias("inside"))
        .groupBy("k", "side", "inside")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(ordered))
        .withColumn("total", F.sum("n").over(Window.partitionBy("k")))
        .groupBy("k")
        .agg(middle.alias("middle"), missed.alias("missed"))
        .select("k", F.when(F.col("missed") > 0, failure).when(finite, F.col("middle")).alias(name))
    )


def zscores(
    metrics: DataFrame,
    metric: str = "log_count",
    key: str = "source_ip",
    z: float = Z_THRESHOLD,
    modified_z: float = MODIFIED_Z_THRESHOLD,
) -> DataFrame:
    """Standard and median-based z-scores of a metric within each key.

    Zero spread gives NULL, and so does a score that is not finite. ``metrics`` is read several
    times: pass a stored table.
    """
    # A NULL key is a group of its own; the prefix keeps it apart from any text.
    name = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("-")).alias("k")
    rows = metrics.select(name, F.col(metric).cast("double").alias("value")).filter(
        F.col("value").isNotNull() & ~F.isnan("value")
    )
    # One row per key each, stored since several branches read them.
    moments = rows.groupBy("k").agg(
        F.avg("value").alias("mean"), F.stddev("value").alias("deviation"), _bracket("value")
    )
    moments = materialize(moments, "zscore-moments")
    middle = _median(rows, moments.select("k", "bracket"), "value", "median")
    center = materialize(moments.drop("bracket").join(middle, "k"), "zscore-center")
    distances = (
        _salted(rows, center.select("k", "median"), "value")
        .select("k", F.abs(F.col("value") - F.col("median")).alias("distance"))
        .filter(F.col("distance").isNotNull())
    )
    brackets = distances.groupBy("k").agg(_bracket("distance"))
    spread = _median(distances, brackets, "distance", "mad")
    stats = materialize(center.join(spread, "k", "left"), "zscore-stats")

    def over(numerator: Column, scale: Column) -> Column:
        score = F.try_divide(numerator, scale)
        return F.when((scale > 0) & ~F.isnan(score) & (F.abs(score) < float("inf")), score)

    current = F.col(metric).cast("double")
    standard = over(current - F.col("mean"), F.col("deviation"))
    robust = over((current - F.col("median")) * MODIFIED_Z_FACTOR, F.col("mad"))
    return (
        metrics.withColumn("k", name)
        .join(stats, "k", "left")
        .withColumn("zscore", standard)
        .withColumn("modified_zscore", robust)
        .withColumn("is_zscore_outlier", F.abs("zscore") > z)
        .withColumn("is_modified_zscore_outlier", F.abs("modified_zscore") > modified_z)
        .drop("k", "mean", "median", "deviation", "mad")
    )


def with_empty_hours(hourly: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hourly counts with a zero for every hour between a series' first and last that has none."""
    stored = materialize(hourly, "hourly")
    spans = stored.groupBy(*keys).agg(F.min("hour").alias("first"), F.max("hour").alias("last"))
    hours = F.explode(F.sequence("first", "last", F.expr("interval 1 hour"))).alias("hour")
    calendar = spans.select(*keys, hours, F.lit(0).cast("bigint").alias("log_count"))
    # A sum and not a join: NULL keys are a series too.
    return stored.unionByName(calendar).groupBy(*keys, "hour").agg(F.sum("log_count").alias("log_count"))


def seasonal_residual(
    logs: DataFrame,
    keys: Sequence[str] = ("traffic_direction",),
    rows: int = TREND_ROWS,
    empty_hours: bool = False,
) -> DataFrame:
    """Hourly log counts per series split into trend, daily season and residual.

    The trend is a centred mean over ``rows`` hourly rows, the season the mean of
    the detrended counts by hour of day. A series has one row per hour, so the
    windows below are as long as the calendar, whatever the number of logs.

    By default an hour without logs has no row: the trend is over the last ``rows`` hours
    that have logs, and silence is no measurement. With ``empty_hours`` it counts 0 from a
    series' first hour to its last, so the trend spans ``rows`` hours of the calendar and an
    outage shows as a residual.
    """
    hourly = (
        logs.filter(F.col("timestamp").isNotNull())
        .groupBy(*keys, F.date_trunc("hour", "timestamp").alias("hour"))
        .agg(F.count(F.lit(1)).alias("log_count"))
    )
    if empty_hours:
        hourly = with_empty_hours(hourly, keys)
    centred = Window.partitionBy(*keys).orderBy("hour").rowsBetween(-(rows // 2), rows - rows // 2 - 1)
    same_hour = Window.partitionBy(*keys, F.hour("hour"))
    return (
        hourly.withColumn("trend", F.avg("log_count").over(centred))
        .withColumn("seasonal", F.avg(F.col("log_count") - F.col("trend")).over(same_hour))
        .withColumn("residual", F.col("log_count") - F.col("trend") - F.col("seasonal"))
    )
