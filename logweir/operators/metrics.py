"""Sliding-window metrics per source.

A window slides by a minute and lasts five, so each log counts in five windows,
and two of the measures are exact distinct counts. Grouping the raw rows by
window would copy each row five times and, for the two distinct counts, three
times again. Both are avoided:

* Sums, extrema and counts are taken once per pane (one slide). The much smaller
  pane rows are then added up per window.
* For a distinct count only the panes in which a value occurs matter. They are
  kept as bits of one long per value and stretch of time, so this step has a
  fixed-size state and combines on the map side like any sum. The windows a
  value counts in are the bits smeared over the window's length.

No step collects the values of a group: a source that owns a third of all rows
is spread over the tasks by its destinations and ports, and everything keyed by
the source alone is added up before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.functions.network import FAILED
from logweir.settings import Thresholds, WindowSpec

KEYS = ("source_ip", "traffic_direction", "severity")
MICROS = 1_000_000
BITS = 64


@dataclass(frozen=True)
class Measure:
    """A named aggregate of one column: count, sum, avg, max, min, failed or distinct."""

    name: str
    kind: str
    column: str | None = None


# Output names and order are fixed.
MEASURES = (
    Measure("log_count", "count"),
    Measure("total_bytes_sent", "sum", "bytes_sent"),
    Measure("total_bytes_received", "sum", "bytes_received"),
    Measure("avg_response_time", "avg", "response_time_ms"),
    Measure("max_response_time", "max", "response_time_ms"),
    Measure("min_response_time", "min", "response_time_ms"),
    Measure("unique_destinations", "distinct", "destination_ip"),
    Measure("unique_ports", "distinct", "destination_port"),
    Measure("failed_connections", "failed", "connection_status"),
    Measure("avg_risk_score", "avg", "risk_score"),
    Measure("max_risk_score", "max", "risk_score"),
)
SIMPLE_KEYS = ("source_ip",)
SIMPLE_MEASURES = (
    Measure("log_count", "count"),
    Measure("avg_response_time", "avg", "response_time"),
    Measure("max_response_time", "max", "response_time"),
)
SIMPLE_SPEC = WindowSpec(watermark=30)


def additive(measures: Sequence[Measure]) -> list[Measure]:
    return [m for m in measures if m.kind != "distinct"]


def distinct(measures: Sequence[Measure]) -> list[Measure]:
    return [m for m in measures if m.kind == "distinct"]


def partial(measures: Sequence[Measure], only: Column | None = None) -> list[Column]:
    """Aggregates that can be added up later; ``only`` limits the rows they see."""
    out = []
    for m in additive(measures):
        if m.kind == "failed":
            value = F.when(F.col(m.column) == FAILED, 1).otherwise(0)
        else:
            value = F.lit(1) if m.column is None else F.col(m.column)
        if only is not None:
            value = F.when(only, value)
        if m.kind == "avg":
            out += [F.sum(value).alias(f"{m.name}__sum"), F.count(value).alias(f"{m.name}__n")]
        else:
            take = {"count": F.count, "sum": F.sum, "failed": F.sum, "max": F.max, "min": F.min}[m.kind]
            out.append(take(value).alias(m.name))
    return out


def merged(measures: Sequence[Measure]) -> list[Column]:
    """The aggregates that add the partial ones up."""
    out = []
    for m in additive(measures):
        if m.kind == "avg":
            out += [F.sum(f"{m.name}__{part}").alias(f"{m.name}__{part}") for part in ("sum", "n")]
        else:
            out.append({"max": F.max, "min": F.min}.get(m.kind, F.sum)(m.name).alias(m.name))
    return out


def finished(keys: Sequence[str], measures: Sequence[Measure]) -> list[Column]:
    """Final columns in their fixed order."""
    out = [F.col("window"), *[F.col(k) for k in keys]]
    for m in measures:
        if m.kind == "avg":
            out.append(F.try_divide(f"{m.name}__sum", f"{m.name}__n").alias(m.name))
        elif m.kind == "distinct":
            out.append(F.coalesce(F.col(m.name), F.lit(0)).cast("bigint").alias(m.name))
        else:
            out.append(F.col(m.name))
    return out


def inputs(keys: Sequence[str], measures: Sequence[Measure]) -> list[str]:
    """The columns a set of measures reads."""
    return list(dict.fromkeys([*keys, *[m.column for m in measures if m.column is not None]]))


def _step(number: str, step: int) -> Column:
    """Index of the step a number falls into, also before the epoch."""
    return F.expr(f"({number} - pmod({number}, {step})) div {step}")


def _by_window(logs: DataFrame, spec: WindowSpec, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """The plain form, for a slide that does not divide the window or has too many panes."""
    window = F.window("timestamp", f"{spec.duration} seconds", f"{spec.slide} seconds")
    counted = [F.count_distinct(F.col(m.column)).alias(m.name) for m in distinct(measures)]
    return logs.groupBy(window.alias("window"), *keys).agg(*partial(measures), *counted)


def _by_pane(logs: DataFrame, spec: WindowSpec, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    k, values = spec.panes, distinct(measures)
    # A stretch holds `starts` window starts and, behind them, the panes those
    # windows still reach: together the 64 bits of a long.
    starts = BITS - k + 1
    pane = _step("unix_micros(timestamp)", spec.slide * MICROS)
    rows = logs.filter(F.col("timestamp").isNotNull()).select(pane.alias("pane"), *inputs(keys, measures))

    names = [f"value{i}" for i in range(1, len(values) + 1)]
    if values:
        spread = _spread(rows, values, k, starts)
    else:
        spread = rows.select("*", F.lit(0).alias("kind"), F.col("pane").alias("slot"), F.lit(0).alias("bit"))
    bits = F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")
    packed = spread.groupBy(*keys, "kind", "slot", *names).agg(*partial(measures, F.col("kind") == 0), bits)

    # From slots to windows.
    smeared = reduce(lambda a, b: a.bitwiseOR(b), [F.shiftrightunsigned("bits", j) for j in range(k)])
    measured = F.col("kind") == 0
    first = F.when(measured, F.col("slot") - (k - 1)).otherwise(F.col("slot") * starts)
    length = F.when(measured, k).otherwise(starts)
    covered = F.when(measured, F.lit(-1).cast("bigint")).otherwise(smeared)
    windows = (
        packed.withColumn("covered", covered)
        .withColumn("first", first)
        .withColumn("start", F.explode(F.sequence(F.col("first"), F.col("first") + length - 1)))
        .filter(F.expr("shiftrightunsigned(covered, cast(start - first as int)) & 1") == 1)
    )
    counted = [F.count_if(F.col("kind") == i).alias(m.name) for i, m in enumerate(values, 1)]
    slide = spec.slide * MICROS
    window = F.struct(
        F.timestamp_micros(F.col("start") * slide).alias("start"),
        F.timestamp_micros((F.col("start") + k) * slide).alias("end"),
    )
    return (
        windows.groupBy("start", *keys)
        .agg(*merged(measures), *counted)
        .withColumn("window", window)
    )


def _spread(rows: DataFrame, values: Sequence[Measure], k: int, starts: int) -> DataFrame:
    """Each row once per purpose, told apart by ``kind``.

    Kind 0 carries the additive measures and goes to its pane. Kind i carries the
    row's i-th distinct value and goes to its stretch; a pane near the start of a
    stretch is also seen by the last windows of the stretch before.
    """
    types = {m.column: rows.schema[m.column].dataType for m in values}

    def part(kind: int, slot: Column, bit: Column) -> Column:
        fields = [F.lit(kind).alias("kind"), slot.alias("slot"), bit.cast("int").alias("bit")]
        for i, m in enumerate(values, 1):
            value = F.col(m.column) if i == kind else F.lit(None).cast(types[m.column])
            fields.append(value.alias(f"value{i}"))
        return F.struct(*fields)

    kinds = ", ".join(f"value{i}: {types[m.column].simpleString()}" for i, m in enumerate(values, 1))
    nothing = F.array().cast(f"array<struct<kind: int, slot: bigint, bit: int, {kinds}>>")
    pane, stretch, previous = F.col("pane"), F.col("stretch"), F.col("previous")
    parts = F.array(part(0, pane, F.lit(0)))
    for i, m in enumerate(values, 1):
        here, there = (part(i, slot, pane - slot * starts) for slot in (stretch, previous))
        present = F.col(m.column).isNotNull()
        found = F.when(present & (stretch == previous), F.array(here)).when(present, F.array(here, there))
        parts = F.concat(parts, found.otherwise(nothing))
    slots = {"stretch": _step("pane", starts), "previous": _step(f"(pane - {k - 1})", starts)}
    return rows.withColumns(slots).select("*", F.inline(parts))


def window_metrics(
    logs: DataFrame,
    spec: WindowSpec = WindowSpec(),
    keys: Sequence[str] = KEYS,
    measures: Sequence[Measure] = MEASURES,
) -> DataFrame:
    """Measures per window and key of a batch table; NULL keys form groups."""
    plain = spec.panes is None or spec.panes > BITS // 2
    form = _by_window if plain else _by_pane
    return form(logs, spec, keys, measures).select(*finished(keys, measures))


def derive(
    metrics: DataFrame, spec: WindowSpec = WindowSpec(), thresholds: Thresholds = Thresholds()
) -> DataFrame:
    """Rates and the three threshold booleans of a metrics row."""
    return (
        metrics.withColumn("failure_rate", F.col("failed_connections").cast("double") / F.col("log_count"))
        .withColumn(
            "bytes_per_second", (F.col("total_bytes_sent") + F.col("total_bytes_received")) / spec.duration
        )
        .withColumn("is_high_volume", F.col("log_count") > thresholds.log_count)
        .withColumn("is_high_latency", F.col("avg_response_time") > thresholds.avg_response_ms)
        .withColumn("is_suspicious_failure_rate", F.col("failure_rate") > thresholds.failure_rate)
    )


def log_metrics(
    logs: DataFrame, spec: WindowSpec = WindowSpec(), thresholds: Thresholds = Thresholds()
) -> DataFrame:
    """All 20 metric columns of enriched logs."""
    return derive(window_metrics(logs, spec), spec, thresholds)


def simple_metrics(logs: DataFrame, spec: WindowSpec = SIMPLE_SPEC) -> DataFrame:
    """The variant keyed by source alone: count, mean and largest response time."""
    return window_metrics(logs, spec, SIMPLE_KEYS, SIMPLE_MEASURES)
