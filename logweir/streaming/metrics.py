"""Window metrics of an unbounded table.

A stream refuses a distinct aggregate, and a set per window and source would be
one state row without a bound. Both forms below are exact and keep one small
state row per distinct value, spread over all state partitions:

* append: two chained aggregations. The first groups by window, key and value,
  and combines on the map side; the second counts its rows. Spark allows the
  chain in append mode only.
* update: values pass two deduplications, first among the records of the same
  salt, so that the copies of one hot value do not meet in a single task, then
  overall. What passes is counted together with the other measures in one
  aggregation. A deduplication has no map-side step, hence the salt. The result is
  complete in itself, for any sink.
* panes (update mode, for a sink that keeps the open ones, see
  ``sinks.open_windows_writer``): a batch adds its logs to panes, one row per pane, key and
  value, and windows are made of panes. A log makes one row a value in place of one for
  each of its windows, and no state store is needed. The sink knows which windows are closed,
  so a late log counts in those of its windows that are open, though they share a pane.

The other two forms use no panes: Spark's state could not tell the windows of a pane apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweir.functions.network import FAILED
from logweir.operators.metrics import (
    KEYS,
    MEASURES,
    MICROS,
    SIMPLE_KEYS,
    SIMPLE_MEASURES,
    SIMPLE_SPEC,
    Measure,
    additive,
    derive,
    distinct,
    finished,
    inputs,
    merged,
    partial,
)
from logweir.operators.records import fields
from logweir.settings import Thresholds, WindowSpec

# More salts spread a hot value over more tasks and keep more state for it: one
# row per salt in which it occurs.
SALTS = 64
# The fields of a log the metrics read; a stream parses no others.
LOG_INPUT = fields(*inputs(KEYS, MEASURES))


def _value_rows(logs: DataFrame, values: Sequence[Measure], first: int) -> Column:
    """Array of (kind, value1, value2, ...), kind i carrying the i-th value only."""

    def part(kind: int) -> Column:
        fields = [F.lit(kind).alias("kind")]
        for i, m in enumerate(values, 1):
            value = F.col(m.column) if i == kind else F.lit(None).cast(logs.schema[m.column].dataType)
            fields.append(value.alias(f"value{i}"))
        return F.struct(*fields)

    return F.array(*[part(kind) for kind in range(first, len(values) + 1)])


def _salt(logs: DataFrame, salts: int) -> Column:
    """Set by the record's place in the queue, so a task that runs again agrees. One
    partition may hold all records of a hot source; its offsets still spread them."""
    if "offset" in logs.columns:
        place = F.xxhash64(*[c for c in ("topic", "partition", "offset") if c in logs.columns])
    else:
        place = F.spark_partition_id()
    return F.pmod(place, F.lit(salts)).cast("int").alias("salt")


def _counted(values: Sequence[Measure]) -> list[Column]:
    return [F.count_if(F.col(f"value{i}").isNotNull()).alias(m.name) for i, m in enumerate(values, 1)]


def window_metrics(
    logs: DataFrame,
    spec: WindowSpec = WindowSpec(),
    keys: Sequence[str] = KEYS,
    measures: Sequence[Measure] = MEASURES,
    mode: str = "append",
    approximate: bool = False,
    salts: int = SALTS,
) -> DataFrame:
    """The batch measures on a stream, for a sink in the given output mode.

    ``approximate`` replaces the exact distinct counts by sketches of fixed size.
    """
    window = F.window("timestamp", f"{spec.duration} seconds", f"{spec.slide} seconds").alias("window")
    late = f"{spec.watermark} seconds"
    marked = logs.withWatermark("timestamp", late)
    rows = marked.select(window, *inputs(keys, measures))
    values = distinct(measures)
    names = [f"value{i}" for i in range(1, len(values) + 1)]
    grouping = ["window", *keys]
    used = reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in names], F.col("kind") == 0)

    if approximate or not values:
        sketched = [F.approx_count_distinct(F.col(m.column)).alias(m.name) for m in values]
        grouped = rows.groupBy(*grouping).agg(*partial(measures), *sketched)
    elif mode == "append":
        spread = rows.select("*", F.inline(_value_rows(logs, values, 0))).filter(used)
        once = spread.groupBy(*grouping, "kind", *names).agg(*partial(measures, F.col("kind") == 0))
        grouped = once.groupBy(*grouping).agg(*merged(measures), *_counted(values))
    else:
        needed = [*keys, *[m.column for m in values]]
        seen = (
            marked.select(window, *dict.fromkeys(needed), _salt(logs, salts))
            .select(*grouping, "salt", F.inline(_value_rows(logs, values, 1)))
            .filter(used)
        )
        unique = (
            seen.dropDuplicates([*grouping, "kind", *names, "salt"])
            .dropDuplicates([*grouping, "kind", *names])
            .drop("salt")
        )
        plain = rows.withColumn("kind", F.lit(0))
        both = plain.unionByName(unique, allowMissingColumns=True)
        grouped = both.groupBy(*grouping).agg(*partial(measures, F.col("kind") == 0), *_counted(values))
    return grouped.select(*finished(keys, measures))


def _single(measures: Sequence[Measure], only: Column) -> list[Column]:
    """What ``partial`` gives for one row, for ``merged`` to add up."""
    out = []
    for m in additive(measures):
        if m.kind == "failed":
            value = F.when(F.col(m.column) == FAILED, 1).otherwise(0).cast("bigint")
        else:
            value = F.lit(1).cast("bigint") if m.column is None else F.col(m.column)
        value = F.when(only, value)
        if m.kind == "avg":
            counted = F.when(value.isNotNull(), 1).otherwise(0).cast("bigint")
            out += [value.alias(f"{m.name}__sum"), counted.alias(f"{m.name}__n")]
        else:
            out.append(value.alias(m.name))
    return out


def merged_panes(
    opened: DataFrame | None,
    logs: DataFrame,
    spec: WindowSpec = WindowSpec(),
    keys: Sequence[str] = KEYS,
    measures: Sequence[Measure] = MEASURES,
) -> DataFrame:
    """The panes that were open with a batch of logs added.

    ``opened`` has the columns of this result. A pane and key has a row with its sums (``kind`` 0)
    and one for each value of the i-th distinct count (``kind`` i). ``last_event`` is the
    latest event time of a row; ``changed`` tells the rows of the batch. Logs are combined before
    they are shuffled.
    """
    values = distinct(measures)
    names = [f"value{i}" for i in range(1, len(values) + 1)]
    used = reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in names], F.col("kind") == 0)
    event, width = F.unix_micros("timestamp"), gcd(spec.duration, spec.slide) * MICROS
    pane = (event - F.pmod(event, F.lit(width))).alias("pane")
    rows = logs.filter(F.col("timestamp").isNotNull()).select(pane, event.alias("last_event"), *inputs(keys, measures))
    spread = rows.select("*", F.inline(_value_rows(logs, values, 0))).filter(used)
    grouping = ["pane", *keys, "kind", *names]
    parts = spread.select(*grouping, *_single(measures, F.col("kind") == 0), "last_event", F.lit(True).alias("changed"))
    if opened is not None:
        parts = parts.unionByName(opened.withColumn("changed", F.lit(False)))
    return parts.groupBy(*grouping).agg(
        *merged(measures), F.max("last_event").alias("last_event"), F.max("changed").alias("changed")
    )


def pane_windows(
    panes: DataFrame,
    spec: WindowSpec = WindowSpec(),
    keys: Sequence[str] = KEYS,
    measures: Sequence[Measure] = MEASURES,
    after: int | None = None,
) -> DataFrame:
    """The windows of :func:`merged_panes` that end ``after`` a time (microseconds), and whether
    they ``changed``.

    A value's pane stands for the windows that no earlier pane of the value lies in, so each
    window meets a value once, and what is shuffled by window is counted before.
    """
    values = distinct(measures)
    duration, slide = spec.duration * MICROS, spec.slide * MICROS
    width = gcd(spec.duration, spec.slide) * MICROS
    of_value = Window.partitionBy(*keys, "kind", *[f"value{i}" for i in range(1, len(values) + 1)]).orderBy("pane")
    before = F.when(F.col("kind") > 0, F.lag("pane").over(of_value))
    least = F.greatest(F.col("pane") + (width - duration), before + 1)
    first = least + F.pmod(-least, F.lit(slide))
    last = F.col("pane") - F.pmod(F.col("pane"), F.lit(slide))
    placed = panes.filter(F.col("pane").isNotNull()).withColumns({"first": first, "last": last}).filter("first <= last")
    spread = placed.withColumn("start", F.explode(F.sequence("first", "last", F.lit(slide))))
    if after is not None:
        spread = spread.filter(F.col("start") + duration > after)
    grouped = spread.groupBy("start", *keys).agg(
        *merged(measures),
        *[F.count_if(F.col("kind") == i).alias(m.name) for i, m in enumerate(values, 1)],
        F.max("changed").alias("changed"),
    )
    bounds = [F.timestamp_micros(F.col("start") + n).alias(edge) for n, edge in ((0, "start"), (duration, "end"))]
    return grouped.withColumn("window", F.struct(*bounds)).drop("start")


def log_metrics(
    logs: DataFrame,
    spec: WindowSpec = WindowSpec(),
    thresholds: Thresholds = Thresholds(),
    mode: str = "append",
    approximate: bool = False,
) -> DataFrame:
    return derive(window_metrics(logs, spec, mode=mode, approximate=approximate), spec, thresholds)


def simple_metrics(logs: DataFrame, spec: WindowSpec = SIMPLE_SPEC) -> DataFrame:
    return window_metrics(logs, spec, SIMPLE_KEYS, SIMPLE_MEASURES)
