"""Isolation forest (Liu, Ting, Zhou 2008) over window metrics.

Trees are grown on small samples, one Spark group per tree, so a group's size is
set by the sample and not by the data. The finished forest is bounded by trees x
sample size; it is the only thing that passes the driver. Scoring is a vectorised
function over the partitions.

Each tree draws its own rows, independently and at every size of the table with the
same chance per row. All choices come from digests of (seed, tree, row or node), so
any engine grows the same forest.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.operators.alerts import alert_id
from logweir.settings import materialize

# Send the small helpers below with the tasks: executors need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values.
CONTAMINATION = 0.1
TREES = 100
SEED = 42
SAMPLE = 256
FEATURES = (
    "log_count",
    "avg_response_time",
    "failure_rate",
    "total_bytes_sent",
    "unique_destinations",
    "unique_ports",
    "max_risk_score",
)
EULER = 0.5772156649015329
# Scores have nine digits: three steps of a thousand find any quantile of them.
DIGITS, STEPS = 9, 1000


def _expected_depth(n: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 2.0)
    depth = 2.0 * (np.log(big - 1.0) + EULER) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, depth, np.where(n == 2, 1.0, 0.0))


def _chance(*parts: object) -> float:
    """A number in [0, 1) with 52 bits, from a digest."""
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 2.0**52


def _grow(points: np.ndarray, seed: int, tree: int) -> list[tuple]:
    """Nodes of one tree as (feature, cut, left, right, size); feature -1 is a leaf.

    A node's path of L and R decides its feature, among those that vary, and its cut.
    """
    limit = int(np.ceil(np.log2(max(len(points), 2))))
    nodes: list[list] = []
    todo = [(points, "", None)]
    while todo:
        part, path, parent = todo.pop()
        me = len(nodes)
        if parent is not None:
            nodes[parent[0]][parent[1]] = me
        low, high = part.min(axis=0), part.max(axis=0)
        varied = np.flatnonzero(high > low)
        if len(path) >= limit or len(varied) == 0:
            nodes.append([-1, 0.0, -1, -1, len(part)])
            continue
        feature = int(varied[int(_chance(seed, tree, path, "feature") * len(varied))])
        cut = float(low[feature] + _chance(seed, tree, path, "cut") * (high[feature] - low[feature]))
        left = part[:, feature] <= cut
        nodes.append([feature, cut, -1, -1, len(part)])
        if not left.all():
            todo.append((part[~left], path + "R", (me, 3)))
            todo.append((part[left], path + "L", (me, 2)))
        else:  # the cut was rounded up to the highest value
            nodes[me] = [-1, 0.0, -1, -1, len(part)]
    return [tuple(node) for node in nodes]


def _path_length(points: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Depth of the leaf each point falls into, corrected for the leaf's size."""
    at = np.zeros(len(points), dtype=int)
    depth = np.zeros(len(points))
    while True:
        feature = nodes[at, 0].astype(int)
        inner = feature >= 0
        if not inner.any():
            return depth + _expected_depth(nodes[at, 4])
        rows = np.flatnonzero(inner)
        here = nodes[at[rows]]
        goes_left = points[rows, feature[rows]] <= here[:, 1]
        at[rows] = np.where(goes_left, here[:, 2], here[:, 3]).astype(int)
        depth[rows] += 1


def _draw(*parts: Column) -> Column:
    """:func:`_chance` as a column."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long") / F.lit(2.0**52)


def _trees_of(share: float, trees: int, seed: int) -> Column:
    """The trees that draw a row, as an array, each with chance ``share``.

    The gaps between them are drawn, so a row that no tree takes costs one draw.
    """
    if share >= 1.0:
        return F.sequence(F.lit(0), F.lit(trees - 1))
    scale = F.lit(float(np.log1p(-share)))

    def gap(k: Column) -> Column:
        return F.floor(F.ln(1.0 - _draw(F.lit(seed), F.col("id"), k)) / scale).cast("double")

    first = gap(F.lit(0))
    one = F.array(first.cast("int"))
    start = F.struct(first.alias("last"), one.alias("drawn"))

    def more(state: Column, k: Column) -> Column:
        after = state["last"] + 1.0 + gap(k)
        drawn = F.when(after < trees, F.concat(state["drawn"], F.array(after.cast("int")))).otherwise(state["drawn"])
        return F.when(state["last"] < trees, F.struct(after.alias("last"), drawn.alias("drawn"))).otherwise(state)

    if trees == 1:
        every = one
    else:
        every = F.aggregate(F.sequence(F.lit(1), F.lit(trees - 1)), start, more)["drawn"]
    return F.when(first < trees, every)


def features_of(features: Sequence[str]) -> list[Column]:
    """NULL and NaN are 0, in growing and in scoring."""
    return [F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f) for f in features]


def grow_forest(
    rows: DataFrame,
    features: Sequence[str] = FEATURES,
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = SEED,
) -> DataFrame:
    """One row per tree: (tree, size, nodes). ``rows`` needs an ``id`` column.

    Every row enters each tree with the chance sample / rows, whatever the size of the
    table, so a tree has about ``sample`` rows and trees may share some.
    """
    share = min(1.0, sample / max(rows.count(), 1))
    drawn = rows.select("id", *features_of(features)).select(
        "id", *features, F.explode(_trees_of(share, trees, seed)).alias("tree")
    )

    def grow(part: pd.DataFrame) -> pd.DataFrame:
        tree = int(part["tree"].iloc[0])
        nodes = _grow(part[list(features)].to_numpy(dtype=float), seed, tree)
        flat = [float(x) for node in nodes for x in node]
        return pd.DataFrame({"tree": [tree], "size": [len(part)], "nodes": [flat]})

    return drawn.groupBy("tree").applyInPandas(grow, "tree int, size int, nodes array<double>")


def cut_at(scores: DataFrame, share: float, steps: int = STEPS) -> int | None:
    """The ``share`` quantile of whole numbers ``v`` in [0, steps**3], exactly: the smallest
    value that has the share of all rows at or below it, found digit by digit."""
    total = scores.count()
    if not total:
        return None
    rank, low = int(np.ceil(share * total)), 0
    for width in (steps**2, steps, 1):
        inside = scores.filter(F.col("v").between(low, low + width * (steps + 1) - 1))
        digits = inside.groupBy(F.floor((F.col("v") - low) / width).alias("digit")).count().orderBy("digit").collect()
        for row in digits:
            if row["count"] >= rank:
                low += row["digit"] * width
                break
            rank -= row["count"]
    return low


def isolation_scores(
    metrics: DataFrame,
    features: Sequence[str] = FEATURES,
    contamination: float = CONTAMINATION,
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = SEED,
) -> DataFrame:
    """Metrics with ``isolation_score`` (nine digits) and ``is_isolated`` for the top share.

    ``metrics`` is read several times: pass a stored table. The scored rows are
    stored as well, since both the cut and the result need them.
    """
    keyed = metrics.withColumn("window_start", F.col("window.start"))
    named = keyed.withColumn(
        "id", alert_id(F.col("source_ip"), F.col("traffic_direction"), F.col("severity"))
    ).drop("window_start")
    grown = grow_forest(named, features, trees, sample, seed).collect()
    if len(grown) != trees and not named.isEmpty():
        raise ValueError(f"only {len(grown)} of {trees} trees drew a row; raise the sample")
    forest = [(row["size"], np.array(row["nodes"]).reshape(-1, 5)) for row in grown]
    shared = metrics.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        trees_grown = shared.value
        for columns in batches:
            points = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            depth = np.zeros(len(points))
            for size, nodes in trees_grown:
                depth += _path_length(points, nodes) / max(float(_expected_depth(size)), 1.0)
            yield pd.Series(np.power(2.0, -depth / len(trees_grown)))

    found = named.withColumn("isolation_score", F.round(score(*features_of(features)), DIGITS))
    scored = materialize(found, "isolation-scores")
    whole = F.round(F.col("isolation_score") * float(STEPS**3)).cast("long")
    cut = cut_at(scored.select(whole.alias("v")), 1 - contamination)
    return scored.withColumn("is_isolated", whole > F.lit(cut).cast("long")).drop("id")
