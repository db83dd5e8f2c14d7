"""Language-model scores: counts exactly, gradients numerically, gain over the base score."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from logweir.llm import language, recurrent


def words(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower()), None]


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def check(rows, data):
    count = Counter(w for i, t, *_ in data if not held_out(i) for w in words(t))
    n, v = sum(count.values()), len(count)
    want = []
    for i, t, *_ in data:
        mine = words(t)
        base = sum(np.log10((count[w] + 1) / (n + v + 1)) for w in mine)
        want.append((str(i), held_out(i), len(mine), sum(count[w] > 0 for w in mine), n, round(base, 6)))
    got = [(str(r[0]), r[1], r[2], r[3], r[4], round(r[5], 6)) for r in rows]
    assert sorted(got) == sorted(want)


def test_scores_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = language.scores(docs).collect()
    check(rows, [tuple(r) for r in docs.collect()])
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > 0.97 * sum(r["base_score"] for r in out)  # both are below 0
    assert np.mean([r["score"] > r["base_score"] for r in out]) > 0.9


def test_odd_rows_and_a_small_dictionary(spark, monkeypatch):
    data = [(i, f"The cat {i % 5} sat on É{i} the\x0bmat{i % 9}", "x") for i in range(60)]
    data += [(100, None, "x"), (101, "", "x"), (None, "the cat", "x"), (4, "the cat", "x"), (102, "unseen words only here", "x")]
    data += [(103, "again " * 30_000, "x"), data[2], data[2]]
    docs = spark.createDataFrame(data, "doc_id long, text string, score string")
    found = {}
    for size in (language.DICTIONARY, 6):
        monkeypatch.setattr(language, "DICTIONARY", size)
        monkeypatch.setattr(language, "HEAD", 5)
        rows = language.scores(docs, rounds=1).collect()
        check(rows, data)
        found[size] = sorted((str(r["doc_id"]), r["score"]) for r in rows)
    assert [x[1] for x in found[6]] == pytest.approx([x[1] for x in found[400_000]])


def test_without_training_texts_or_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert language.scores(docs).count() == 0
    alone = next(i for i in range(100) if held_out(i))
    (row,) = language.scores(spark.createDataFrame([(alone, "a b")], "doc_id long, text string")).collect()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (3, 0, 0)
    assert np.isfinite(row["score"])


@pytest.fixture
def network():
    vocabulary = recurrent.Vocabulary(150, 3)
    rng = np.random.default_rng(4)
    weights = recurrent.initial(vocabulary, rng.integers(1, 50, vocabulary.size).astype(float))
    weights = {k: (v + rng.normal(0, 0.3, v.shape)).astype(np.float64) for k, v in weights.items()}
    texts = [rng.integers(0, vocabulary.size, n).astype(np.int32) for n in (9, 4, 1, 7)]
    return vocabulary, weights, texts


def normalised(vocabulary, weights, text):
    """Step by step, with every probability written out."""
    h, total, last = np.zeros(recurrent.STATE), 0.0, 0
    s = recurrent.STATE
    for t in text:
        a, g = weights["emb"][last] @ weights["in"] + weights["in_bias"], h @ weights["rec"]
        z, r = 1 / (1 + np.exp(-(a[:s] + g[:s]))), 1 / (1 + np.exp(-(a[s : 2 * s] + g[s : 2 * s])))
        n = np.tanh(a[2 * s :] + r * g[2 * s :])
        h = (1 - z) * n + z * h
        classes = np.exp(h @ weights["cls"] + weights["cls_bias"])
        c = int(vocabulary.class_of(np.array([t]))[0])
        total += np.log(classes[c] / classes.sum())
        if t < vocabulary.head:
            first = c * recurrent.WIDTH
            e = np.exp(weights["word"][first : first + recurrent.WIDTH] @ h + weights["word_bias"][first : first + recurrent.WIDTH])
            total += np.log(e[t - first] / e.sum())
        last = t
    return total


def test_score_is_the_texts_probability(network, monkeypatch):
    vocabulary, weights, texts = network
    want = [normalised(vocabulary, weights, t.tolist()) for t in texts]
    for lanes, window in ((384, 16), (2, 1)):  # the state is carried over lanes and windows
        monkeypatch.setattr(recurrent, "LANES", lanes)
        monkeypatch.setattr(recurrent, "WINDOW", window)
        assert recurrent.score(vocabulary, weights, texts) == pytest.approx(want, rel=1e-5)


def test_gradient_is_the_numeric_one(network):
    vocabulary, weights, texts = network
    target, previous, _, begin = recurrent.lanes_of(texts, 3)
    h = np.zeros((target.shape[1], recurrent.STATE))
    grad, _ = recurrent._gradient(vocabulary, weights, target, previous, begin, h)

    def loss(w):
        return -recurrent.score(vocabulary, w, texts).sum() / sum(map(len, texts))

    rng = np.random.default_rng(0)
    for name in weights:
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in weights[name].shape)
            if name == "emb":
                at = (int(texts[0][2]), at[1])
            moved = {k: v.copy() for k, v in weights.items()}
            moved[name][at] += 1e-2
            high = loss(moved)
            moved[name][at] -= 2e-2
            assert grad[name][at] == pytest.approx((high - loss(moved)) / 2e-2, abs=3e-4)


def test_long_texts_are_learnt_with_the_state_before_each_piece(network, monkeypatch):
    """Gradients of the output layer do not tell whether texts were cut."""
    vocabulary, weights, texts = network
    found = []
    monkeypatch.setattr(recurrent.Learner, "_move", lambda self, grad: found.append(grad))
    for piece in (recurrent.PIECE, 4):
        monkeypatch.setattr(recurrent, "PIECE", piece)
        learner = recurrent.Learner(vocabulary, weights, 0.01)
        learner.take(texts)
        learner.finish()
        assert learner.learnt == sum(map(len, texts))
    whole, cut = found
    for name in ("cls", "cls_bias", "word", "word_bias"):
        assert cut[name] == pytest.approx(whole[name], abs=1e-6)


def test_the_network_tells_2048_words_apart(spark):
    counts = spark.createDataFrame([(f"w{i}".encode(), 1) for i in range(3000)], "word binary, n long")
    assert language.lexicon(counts)[0].vocabulary.head == 2048


def test_words_of_megabytes_stay_out_of_the_dictionary(spark):
    """Texts of one long word each, some of them the same, are counted and scored exactly."""
    rows = [(i, f"{i % 7}" + "x" * 400_000) for i in range(30)] + [(100 + i, "a b c") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts = language.word_counts(docs.where(~language.is_held_out()).select(language.utf8("text").alias("body")))
    lexicon = language.lexicon(counts)[0]
    assert max(map(len, lexicon.words)) <= language.LONGEST
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    times = {}
    for t in train:
        for w in [*t.split(), "\n"]:
            times[w] = times.get(w, 0) + 1
    n, v = sum(times.values()), len(times)
    for r in language.scores(docs, rounds=1).collect():
        tokens = [*dict(rows)[r["doc_id"]].split(), "\n"]
        assert r["n_known"] == sum(t in times for t in tokens) and r["train_tokens"] == n
        assert r["base_score"] == pytest.approx(sum(np.log10((times.get(t, 0) + 1) / (n + v + 1)) for t in tokens))
        assert np.isfinite(r["score"]) and r["score"] < 0
