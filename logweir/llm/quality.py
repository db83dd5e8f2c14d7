"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text train a small network on the non-negative unbiased
risk: the risk of calling unlabelled text bad, less the share of it that the positives explain,
never below zero. The share of good text among the unlabelled (the class prior) is estimated
from the same two samples; labelled negatives are not used.

Inputs are what a text looks like: shapes of its words, kinds of characters, repetition. They
are taken from whole texts in one pass and stored, a few hundred bytes a row. The features'
mean and spread and the masses of unlabelled text above a score's cuts, from which the prior
is estimated, are counted by Spark over the stored features of all documents that are not
held out. Only the gradient steps work on samples (``POSITIVES``, ``UNLABELLED`` rows); these are
the rows with the smallest hashes, so reruns agree, and an id that very many rows share brings no
more than the bound.

Defined results: a null text is an empty one and gets a score like any other; without
positives (under four) all scores are 0.5; repeated rows get the same score; an empty table gives no rows;
a null id counts as not held out, but is never learnt from.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import materialize, utf8

#: Bounds of the samples of the gradient steps.
POSITIVES = 6000
UNLABELLED = 12000
#: Buckets for word shapes.
SHAPES = 64
HIDDEN = 24
STEPS = 1500
BATCH = 512
THRESHOLD = 0.3
#: Times the class prior is estimated anew.
ROUNDS = 2
FOLDS = 5

_CLASSES = bytearray(range(256))
for _b in range(256):
    if 97 <= _b <= 122 or _b >= 128:
        _CLASSES[_b] = ord("a")
    elif 65 <= _b <= 90:
        _CLASSES[_b] = ord("A")
    elif 48 <= _b <= 57:
        _CLASSES[_b] = ord("0")
CLASSES = bytes(_CLASSES)
STATS = 11


def features(text: bytes) -> np.ndarray:
    """What the text looks like: statistics, then shares of word shapes."""
    out = np.zeros(STATS + SHAPES, dtype=np.float32)
    words = text.split()
    n, size = len(words), max(len(text), 1)
    if not n:
        return out
    kinds = np.frombuffer(text.translate(CLASSES), dtype=np.uint8)
    count = np.bincount(kinds, minlength=256)
    kept = np.ones(len(kinds), dtype=bool)
    kept[1:] = kinds[1:] != kinds[:-1]
    shapes = kinds[kept].tobytes().split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    out[:STATS] = (
        np.log1p(n),
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        len(set(lines)) / max(len(lines), 1),
        np.log1p(n / max(len(lines), 1)),
        sum(map(len, words)) / n / 10,
        count[ord("A")] / size,
        count[ord("0")] / size,
        (size - count[ord("a")] - count[ord("A")] - count[ord("0")] - count[32] - count[10]) / size,
        (n - len(set(words))) / np.sqrt(n) / 10,
        len(max(words, key=len)) / 50,
    )
    seen: dict[bytes, int] = {}
    for s in shapes:
        seen[s] = seen.get(s, 0) + 1
    for s, k in seen.items():
        out[STATS + zlib.crc32(s) % SHAPES] += k / len(shapes)
    return out


class Scorer:
    """Standardised features through one hidden layer."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        width = len(mean)
        self.mean, self.scale = mean, scale
        self.w = [
            rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)),
            np.zeros(HIDDEN),
            rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
            np.zeros(1),
        ]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -5, 5)

    def raw(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(z @ self.w[0] + self.w[1])
        return hidden @ self.w[2] + self.w[3][0], hidden

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(self.scaled(x))[0], -30, 30)))

    def gradient(self, z: np.ndarray, at_output: np.ndarray) -> list[np.ndarray]:
        _, hidden = self.raw(z)
        back = np.outer(at_output, self.w[2]) * (1 - hidden**2)
        return [z.T @ back, back.sum(0), hidden.T @ at_output, np.array([at_output.sum()])]


def _sigmoid(g: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(g, -30, 30)))


def _softplus(g: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, g)


Moments = tuple[np.ndarray, np.ndarray]


def train(
    positives: np.ndarray, unlabelled: np.ndarray, prior: float | None, seed: int = 1, moments: Moments | None = None
) -> Scorer:
    """Minimise the non-negative risk; without a prior, tell positives from unlabelled.

    ``moments`` are the features' mean and spread, by default those of the samples.
    """
    if moments is None:
        both = np.concatenate([positives, unlabelled]).astype(float)
        moments = both.mean(0), both.std(0)
    model = Scorer(moments[0], moments[1] + 1e-3, seed)
    p, u = model.scaled(positives.astype(float)), model.scaled(unlabelled.astype(float))
    rng = np.random.default_rng(seed + 1)
    first, second = [np.zeros_like(w) for w in model.w], [np.zeros_like(w) for w in model.w]
    for step in range(1, STEPS + 1):
        zp, zu = p[rng.integers(0, len(p), BATCH)], u[rng.integers(0, len(u), BATCH)]
        gp, gu = model.raw(zp)[0], model.raw(zu)[0]
        if prior is None:
            at_p, at_u = -_sigmoid(-gp) / BATCH, _sigmoid(gu) / BATCH
        else:
            negative = _softplus(gu).mean() - prior * _softplus(gp).mean()
            if negative >= 0:
                at_p = prior * (-_sigmoid(-gp) - _sigmoid(gp)) / BATCH
                at_u = _sigmoid(gu) / BATCH
            else:  # climb back: the network has begun to tell these very samples apart
                at_p, at_u = prior * _sigmoid(gp) / BATCH, -_sigmoid(gu) / BATCH
        grads = [a + b for a, b in zip(model.gradient(zp, at_p), model.gradient(zu, at_u), strict=True)]
        rate = 0.01 * 0.5 * (1 + np.cos(np.pi * step / STEPS))
        for k, grad in enumerate(grads):
            grad = grad + 1e-4 * model.w[k]
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad**2
            model.w[k] = model.w[k] - rate * (first[k] / (1 - 0.9**step)) / (
                np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
            )
    return model


#: Shares of the unlabelled rows, not trained on, that score at least as much as each cut.
Above = Callable[[Scorer, np.ndarray], np.ndarray]


def _ratio(model: Scorer, positives: np.ndarray, above: Above) -> float:
    """The least ratio of the masses above a cut; cuts lie in the positives' lower tail."""
    p = np.sort(model.score(positives))
    cuts = np.quantile(p, [0.0, 0.001, 0.002, 0.004, 0.008, 0.016, 0.03, 0.06, 0.12, 0.25, 0.5])
    above_p = 1 - np.searchsorted(p, cuts) / len(p)
    return float(np.clip((above(model, cuts) / above_p).min(), 0.02, 0.98))


def class_prior(
    positives: np.ndarray,
    unlabelled: np.ndarray,
    seed: int = 1,
    above: Above | None = None,
    moments: Moments | None = None,
) -> float:
    """Share of positives among the unlabelled.

    Above any cut of any score, unlabelled text has at least the share's part of the positives'
    mass, so the ratio of the two masses bounds the share from above; it is tight where few
    bad texts lie above the cut. One half of each sample trains the scores, first those that
    tell the samples apart, then those of the risk at the bound so far. The ratio is that of the
    positives' other half and of what ``above`` counts, by default the unlabelled sample's
    other half; with ``above`` the whole unlabelled sample trains.
    """
    trained, seen = (positives[::2], unlabelled), positives[1::2]
    if above is None:
        trained, rest = (positives[::2], unlabelled[::2]), unlabelled[1::2]

        def above(model: Scorer, cuts: np.ndarray) -> np.ndarray:
            return 1 - np.searchsorted(np.sort(model.score(rest)), cuts) / len(rest)

    prior = _ratio(train(*trained, None, seed, moments), seen, above)
    for _ in range(ROUNDS):
        prior = min(prior, _ratio(train(*trained, prior, seed, moments), seen, above))
    return prior


def fold(doc_id: str = "doc_id", folds: int = FOLDS) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def featured(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, x (the features' bytes) of every row; stored."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(b.as_py()).tobytes() for b in batch["body"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(rows, pa.binary())], names=["doc_id", "held_out", "x"]
            )

    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    rows = docs.select(doc_id, F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), utf8("text").alias("body"))
    return materialize(rows.mapInArrow(made, "doc_id long, held_out boolean, x binary"), "quality-features")


def _array(found: Iterable[bytes]) -> np.ndarray:
    return np.array([np.frombuffer(x, dtype=np.float32) for x in found]).reshape(-1, STATS + SHAPES)


def _sample(rows: DataFrame, most: int, seed: int) -> np.ndarray:
    """Features of the ``most`` rows with the smallest hashes."""
    drawn = F.xxhash64("doc_id", "x", F.lit(seed))
    total = rows.count()
    if total > 2 * most:
        # Twice as many rows as are wanted have such hashes: the others stay in their tasks.
        rows = rows.where(drawn < F.lit(int(2**64 * (2 * most / total)) - 2**63))
    taken = rows.orderBy(drawn, "doc_id", "x").limit(most).select("doc_id", "x")
    return _array(bytes(r["x"]) for r in sorted(taken.collect(), key=lambda r: (r["doc_id"], bytes(r["x"]))))


def moments_of(rows: DataFrame) -> Moments:
    """Mean and spread of each feature over all rows."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, STATS + SHAPES))
        n = 0
        for batch in batches:
            x = _array(b.as_py() for b in batch["x"]).astype(float)
            total += x.sum(0), (x * x).sum(0)
            n += len(x)
        columns = {"k": np.arange(total.shape[1]), "s": total[0], "q": total[1], "n": np.full(total.shape[1], n)}
        yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})

    sums = rows.select("x").mapInArrow(summed, "k long, s double, q double, n long")
    found = sums.groupBy("k").agg(F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum("n").alias("n")).orderBy("k").collect()
    n = max(found[0]["n"], 1) if found else 1
    mean, square = (np.array([r[c] for r in found]) / n for c in ("s", "q"))
    # In single precision, in which the order of addition does not show.
    return mean.astype(np.float32).astype(float), np.sqrt(np.maximum(square - mean**2, 0)).astype(np.float32).astype(float)


def shares_above(rows: DataFrame, model: Scorer, cuts: np.ndarray) -> np.ndarray:
    """The share of all rows that score at least as much as each cut."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above, n = np.zeros(len(cuts), np.int64), 0
        for batch in batches:
            score = np.sort(model.score(_array(b.as_py() for b in batch["x"])))
            above += len(score) - np.searchsorted(score, cuts)
            n += len(score)
        columns = {"k": np.arange(len(cuts)), "above": above, "n": np.full(len(cuts), n)}
        yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})

    sums = rows.select("x").mapInArrow(counted, "k long, above long, n long").groupBy("k")
    found = sums.agg(F.sum("above").alias("above"), F.sum("n").alias("n")).orderBy("k").collect()
    return np.array([r["above"] / max(r["n"], 1) for r in found])


def fit(rows: DataFrame, labels: DataFrame, seed: int = 1) -> Scorer | None:
    """Learn from the positives and from all documents, neither held out; ``rows`` are featured."""
    mine = rows.where("doc_id is not null and not held_out")
    good = labels.where(F.col("quality") == 1).select(F.col("doc_id").cast("long").alias("__good")).distinct()
    p = _sample(mine.join(good, F.col("doc_id") == F.col("__good"), "left_semi"), POSITIVES, seed)
    # One half of the rows trains the scores whose masses are counted in the other half.
    half = F.pmod(F.xxhash64("doc_id", "x", F.lit(seed + 2)), F.lit(2))
    u = [_sample(mine.where(half == k), UNLABELLED // 2, seed + 1) for k in (0, 1)]
    if len(p) < 4 or not all(map(len, u)) or sum(map(len, u)) < 4:
        return None
    moments, counted = moments_of(mine), mine.where(half == 1)

    def above(model: Scorer, cuts: np.ndarray) -> np.ndarray:
        return shares_above(counted, model, cuts)

    prior = class_prior(p, u[0], seed, above, moments)
    return train(p, np.concatenate(u), prior, seed, moments)


def _scored(rows: DataFrame, model: Scorer | None, kept: list[str], column: str, read) -> DataFrame:
    """The ``kept`` columns of every row with its ``score``; ``read`` makes features of ``column``."""
    schema = rows.select(*kept).withColumn("score", F.lit(0.5)).schema

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                score = np.full(len(batch), 0.5)
            else:
                score = model.score(_array(read(b.as_py()) for b in batch[column]))
            columns = [batch[c] for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(score, pa.float64())], names=[*kept, "score"])

    return rows.mapInArrow(made, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    rows = featured(docs.select("doc_id", "text"))
    found = _scored(rows, fit(rows, labels, seed), ["doc_id", "held_out"], "x", bytes)
    return found.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, seed: int = 1) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts."""
    model = fit(featured(docs.select("doc_id", "text")), labels, seed)
    # Names of their own, whatever the caller's columns are called.
    names = [f"__{i}" for i in range(len(docs.columns))]
    text = names[[c.lower() for c in docs.columns].index("text")]
    own = docs.toDF(*names).withColumn("__body", utf8(text))
    kept = _scored(own, model, names, "__body", lambda text: features(text).tobytes())
    return kept.where(F.col("score") >= THRESHOLD).select(*names).toDF(*docs.columns)
