"""Positive-unlabelled quality: estimate of the prior, held-out accuracy, edge cases."""

import zlib

import numpy as np
import pytest

from logweir.llm import quality
from logweir.llm.common import table


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


@pytest.fixture(scope="module")
def tables(spark):
    return [table(spark, "/root/testdata/sf0.01", n) for n in ("documents", "labels")]


def test_held_out_documents(tables):
    docs, labels = tables
    found = {r["doc_id"]: r for r in quality.quality_scores(docs, labels).collect()}
    assert len(found) == docs.count()
    right = good = bad = kept = dropped = 0
    for r in labels.collect():
        mine = found[r["doc_id"]]
        assert mine["held_out"] == held_out(r["doc_id"])
        assert 0 <= mine["score"] <= 1
        assert mine["predicted"] == (mine["score"] >= 0.3)
        if mine["held_out"]:
            right += mine["predicted"] == r["quality"]
            good, kept = good + r["quality"], kept + r["quality"] * mine["predicted"]
            bad, dropped = bad + 1 - r["quality"], dropped + (1 - r["quality"]) * (1 - mine["predicted"])
    assert kept >= 0.97 * good
    assert dropped >= 0.8 * bad


def test_held_out_labels_and_negatives_are_not_used(tables):
    docs, labels = tables
    before = {r["doc_id"]: r["score"] for r in quality.quality_scores(docs, labels).collect()}
    fold = quality.fold()
    turned = labels.withColumn("quality", quality.F.when(fold == 0, 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    without = turned.where((fold == 0) | (quality.F.col("quality") == 1))
    assert {r["doc_id"]: r["score"] for r in quality.quality_scores(docs, without).collect()} == pytest.approx(before)


def test_class_prior_of_a_known_mixture():
    rng = np.random.default_rng(2)
    good, bad = rng.normal(0, 1, (6000, 6)), rng.normal(3, 1, (6000, 6))
    mixed = np.where(rng.random((4000, 1)) < 0.7, good[2000:], bad[:4000])
    assert quality.class_prior(good[:2000], mixed) == pytest.approx(0.7, abs=0.05)


def test_risk_goes_back_up_when_negative():
    """With one point in both samples and a prior of nearly 1 nothing may be called bad."""
    model = quality.train(np.ones((50, 3)), np.ones((50, 3)), 0.98)
    assert (model.score(np.ones((1, 3))) > 0.9).all()


def test_odd_rows(spark):
    texts = ["Good words in a line.\nAnd more of them here."] * 30 + ["a$$$ b### c%%% d***"] * 10
    data = [(i, t, "x") for i, t in enumerate(texts)] + [(90, None, "x"), (91, "", "x"), (None, texts[0], "x"), (3, texts[3], "x")]
    data += [(92, "long " * 100_000, "x"), (93, "\x00\t", "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, Score string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    found = quality.quality_scores(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.collect()
    assert len(rows) == len(data)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and held_out(r["doc_id"])) for r in rows)
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    good = sorted((r["doc_id"] for r in rows if r["predicted"]), key=str)
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == good


def test_without_positives_or_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in quality.quality_scores(docs, labels).collect()] == [0.5, 0.5]
    assert quality.quality_scores(docs.limit(0), labels).count() == 0


def test_columns_named_as_the_operator_names_its_own(tables, spark):
    docs, labels = tables
    small = docs.limit(120)
    names = ["sampled", "x", "held_out", "score", "body", "__good", "__body", "k", "n", "__0", "fold"]
    wide = small.select("*", *[quality.F.lit(i).alias(n) for i, n in enumerate(names)])
    plain = sorted(map(tuple, quality.quality_scores(small, labels).collect()))
    assert sorted(map(tuple, quality.quality_scores(wide, labels).collect())) == plain
    kept = quality.keep_good(wide, labels)
    assert kept.columns == wide.columns
    rows = kept.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r[0] for r in plain if r[3] == 1)
    assert all([r[n] for n in names] == list(range(len(names))) for r in rows)


def test_statistics_cover_all_rows(spark):
    """Moments and masses of more rows than a sample holds; an id that a third of them share."""
    rng = np.random.default_rng(5)
    n = quality.UNLABELLED + 6000
    x = rng.normal(2, 3, (n, quality.STATS + quality.SHAPES)).astype(np.float32)
    data = [(7 if i % 3 == 0 else i, v.tobytes()) for i, v in enumerate(x)]
    rows = spark.createDataFrame(data, "doc_id long, x binary").repartition(4)
    mean, spread = quality.moments_of(rows)
    assert mean == pytest.approx(x.mean(0), rel=1e-4) and spread == pytest.approx(x.std(0), rel=1e-4)
    model = quality.Scorer(mean, spread, 3)
    cuts = np.quantile(model.score(x), [0.1, 0.5, 0.99])
    want = [(model.score(x) >= c).mean() for c in cuts]
    assert quality.shares_above(rows, model, cuts) == pytest.approx(want)
    assert len(quality._sample(rows.where("doc_id = 7"), 500, 1)) == 500
    again = quality._sample(rows.repartition(7), 500, 1)
    assert np.array_equal(quality._sample(rows, 500, 1), again)
