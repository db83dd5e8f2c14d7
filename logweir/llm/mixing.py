"""Mixing sources to target weights: entropy balancing, then rounding into copies.

Of all document rates that meet the token targets, the exponentially tilted ones change the
corpus least. Their multipliers solve a convex dual by Newton steps: Spark sums tokens,
gradient and Hessian, the driver solves one small system with a row per constraint. The
driver holds a few numbers per source; sources are entries of a recipe, not data.

Rates become whole copies without loss of the total: a document gets the rate's whole part,
and one copy more if its hash lies under a cut. Cuts are set per source from the largest
documents down to the smallest, and what one size class misses is carried to the next.

Defined results: a null text has size 0; null is a source of its own and the last one; a
source of size 0 has target 0; rows with one id get the same decision; an empty table gives
no rows; columns of the input that clash with the made ones give way to them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import materialize

WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
#: Hash bins of a size class: a cut is exact to one bin.
BINS = 1024
#: Rows of the cuts table that are sent to all tasks at most.
SENT_CUTS = 50_000
STEPS = 100
TOLERANCE = 1e-12


def size(text: str = "text") -> Column:
    """Words of a text; words end at ASCII white space."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[int] = WEIGHTS, most: float = MAX_COPIES) -> list[float]:
    """Shares of the total by weight; a share above ``most`` sizes is cut and the excess
    goes to the others by weight, until none is above."""
    total = float(sum(sizes))
    weight = [float(weights[i % len(weights)]) for i in range(len(sizes))]
    target = [0.0] * len(sizes)
    full: set[int] = set()
    while len(full) < len(sizes):
        left = total - sum(most * sizes[i] for i in full)
        free = [i for i in range(len(sizes)) if i not in full]
        unit = left / sum(weight[i] for i in free)
        over = [i for i in free if unit * weight[i] > most * sizes[i]]
        for i in free:
            target[i] = unit * weight[i]
        if not over:
            break
        full.update(over)
    for i in full:
        target[i] = float(most * sizes[i])
    return target


def balance(cells: DataFrame, goals: Sequence[float]) -> np.ndarray:
    """Multipliers of the tilted rates.

    ``cells`` (slots array<int>, tokens) has one row for each combination of constraints that
    documents fall under; ``goals`` is the tokens wanted of each slot, all above 0.
    """
    goal = np.asarray(goals, dtype=float)
    multipliers = np.zeros(len(goal))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[int, int], float] = {}
            for slots, tokens in zip(batch["slots"].to_pylist(), batch["tokens"].to_pylist(), strict=True):
                tilted = tokens * math.exp(sum(multipliers[s] for s in slots))
                for s in slots:
                    for t in slots:
                        found[s, t] = found.get((s, t), 0.0) + tilted
            yield pa.RecordBatch.from_pydict(
                {"s": [k[0] for k in found], "t": [k[1] for k in found], "tilted": list(found.values())},
                schema=pa.schema([("s", pa.int32()), ("t", pa.int32()), ("tilted", pa.float64())]),
            )

    for _ in range(STEPS if len(goal) else 0):
        parts = cells.mapInArrow(sums, "s int, t int, tilted double")
        hessian = np.zeros((len(goal), len(goal)))
        for row in parts.groupBy("s", "t").agg(F.sum("tilted").alias("tilted")).collect():
            hessian[row["s"], row["t"]] = row["tilted"]
        gradient = np.diag(hessian) - goal
        if np.all(np.abs(gradient) <= TOLERANCE * goal):
            break
        step = np.linalg.lstsq(hessian, gradient, rcond=None)[0]
        multipliers = multipliers - np.clip(step, -2.0, 2.0)
    return multipliers


@dataclass(frozen=True)
class Mix:
    """The solved mix: a row for each source and size class."""

    cuts: DataFrame  # source, source_size, target, whole, size_class, cut
    rows: int
    most: int


def _size_class(words: Column) -> Column:
    return F.when(words > 0, F.floor(F.log2(words))).otherwise(-1).cast("int")


def _bin(key: str, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), F.lit(BINS)).cast("int")


def _cuts(classes: pd.DataFrame, rate: float) -> list[tuple[int, int]]:
    """(size class, cut) of one source: bins below the cut give one copy more."""
    share, missing, found = rate - math.floor(rate), 0.0, []
    for size_class, part in sorted(classes.groupby("size_class"), key=lambda x: -x[0]):
        tokens = np.zeros(BINS)
        tokens[part["bin"].to_numpy()] = part["tokens"].to_numpy()
        wanted = share * tokens.sum() + missing
        reached = np.concatenate([[0.0], np.cumsum(tokens)])
        cut = int(np.argmin(np.abs(reached - wanted)))
        missing = wanted - reached[cut]
        found.append((int(size_class), cut))
    return found


def solve(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MAX_COPIES, seed: int = 4, key: str = "doc_id"
) -> Mix:
    """Rates and cuts for ``sized`` (key, source, size), which is read several times."""
    spark = sized.sparkSession
    totals = [(r["source"], r["n"]) for r in sized.groupBy("source").agg(F.sum("size").alias("n")).collect()]
    totals.sort(key=lambda x: (x[0] is None, x[0] or ""))
    goal = targets([n for _, n in totals], weights, most)
    live = [i for i, t in enumerate(goal) if t > 0]
    slot = spark.createDataFrame([(totals[i][0], [k]) for k, i in enumerate(live)], "source string, slots array<int>")
    cells = (
        sized.groupBy(F.col("source").alias("of"))
        .agg(F.sum("size").cast("double").alias("tokens"))
        .join(slot, F.col("of").eqNullSafe(F.col("source")))
        .select("slots", "tokens")
    )
    multipliers = balance(materialize(cells, "mix-cells"), [goal[i] for i in live])
    rates = [0.0] * len(goal)
    for k, i in enumerate(live):
        rates[i] = min(float(np.exp(multipliers[k])), float(most))
    rate_of = dict(zip([s for s, _ in totals], rates, strict=True))

    def cut(part: pd.DataFrame) -> pd.DataFrame:
        source = part["source"].iloc[0]
        source = None if pd.isna(source) else source
        return pd.DataFrame(
            [(source, c, b) for c, b in _cuts(part, rate_of[source])], columns=["source", "size_class", "cut"]
        )

    bins = sized.groupBy("source", _size_class(F.col("size")).alias("size_class"), _bin(key, seed).alias("bin")).agg(
        F.sum("size").alias("tokens")
    )
    found = bins.groupBy("source").applyInPandas(cut, "source string, size_class int, cut int").collect()
    about = {s: (n, t, math.floor(r)) for (s, n), t, r in zip(totals, goal, rates, strict=True)}
    return Mix(
        spark.createDataFrame(
            [(r["source"], *about[r["source"]], r["size_class"], r["cut"]) for r in found],
            "source string, source_size long, target double, whole int, size_class int, cut int",
        ),
        len(found),
        most,
    )


def copies(docs: DataFrame, mix: Mix, words: Column, seed: int = 4, key: str = "doc_id") -> DataFrame:
    """Each row of ``docs`` with __size, __source_size, __target and __copies."""
    cuts = mix.cuts.select(*[F.col(c).alias(f"__{c}") for c in mix.cuts.columns])
    # With few sources texts need no shuffle to meet the cuts; with very many Spark joins by source.
    cuts = F.broadcast(cuts) if mix.rows <= SENT_CUTS else cuts
    rows = docs.withColumn("__size", words).withColumn("__bin", _bin(key, seed))
    joined = rows.join(
        cuts, F.col("source").eqNullSafe(F.col("__source")) & (_size_class(F.col("__size")) == F.col("__size_class"))
    )
    number = F.least(F.col("__whole") + (F.col("__bin") < F.col("__cut")).cast("int"), F.lit(mix.most))
    return joined.withColumn("__copies", number)


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies of every document."""
    sized = materialize(docs.select("doc_id", "source", size().alias("size")), "mix-sizes")
    found = copies(sized, solve(sized, weights, most), F.col("size"))
    return found.select(
        "doc_id",
        "size",
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("size") * F.col("__copies")).alias("taken"),
        F.col("__copies").alias("copies"),
    )


def mix_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    mix = solve(materialize(docs.select("doc_id", "source", size().alias("size")), "mix-sizes"), weights, most)
    again = F.explode(F.array_repeat(F.lit(0), F.col("__copies")))
    return copies(docs, mix, size()).withColumn("__copy", again).select(*docs.columns)
