"""Targets, balance and rounding of the mix."""

import re

import numpy as np
import pytest

from logweir.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """Reshare the excess a little at a time."""
    total, weight = sum(sizes), [weights[i % len(weights)] for i in range(len(sizes))]
    low, high = 0.0, total + 1.0
    for _ in range(200):
        unit = (low + high) / 2
        if sum(min(unit * w, most * s) for w, s in zip(weight, sizes, strict=True)) < total:
            low = unit
        else:
            high = unit
    return [min(high * w, most * s) for w, s in zip(weight, sizes, strict=True)]


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1000, 1, 1], [5, 0, 7, 900, 3], [1], [0, 0], [1, 2, 3, 4, 10_000]])
def test_targets(sizes):
    found = mixing.targets(sizes)
    assert found == pytest.approx(brute_targets(sizes), abs=1e-6)
    assert sum(found) == pytest.approx(sum(sizes))


def test_balance_of_two_margins(spark):
    cells = spark.createDataFrame(
        [([0, 2], 100.0), ([0, 3], 50.0), ([1, 2], 30.0), ([1, 3], 80.0)], "slots array<int>, tokens double"
    )
    goal = [120.0, 140.0, 90.0, 170.0]
    m = mixing.balance(cells, goal)
    rate = {(a, b): np.exp(m[a] + m[b]) for a in (0, 1) for b in (2, 3)}
    tokens = {(0, 2): 100, (0, 3): 50, (1, 2): 30, (1, 3): 80}
    for slot, want in enumerate(goal):
        assert sum(tokens[k] * rate[k] for k in tokens if slot in k) == pytest.approx(want)


def rows():
    found = []
    for i in range(400):
        source = None if i % 11 == 0 else f"s{i % 3}" if i % 5 else "Z"
        text = None if i % 50 == 0 else "" if i % 49 == 0 else "w x\tb " * (1 + i * 7 % 60)
        found.append((i, text, source, "extra"))
    return [*found, found[7], found[7], (None, "null id", "s1", "extra"), (999, "word " * 30_000, "s2", "extra")]


def test_mix_comes_near_its_targets(spark):
    data = rows()
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, `TARGET` string")
    found = mixing.mixed(docs).collect()
    assert len(found) == len(data)
    sizes = {}
    for _, text, source, _ in data:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = dict(zip(order, brute_targets([sizes[s] for s in order]), strict=True))
    of = {i: s for i, _, s, _ in data}
    taken = dict.fromkeys(order, 0)
    for r in found:
        assert r["source_size"] == sizes[of[r["doc_id"]]]
        assert r["target"] == pytest.approx(target[of[r["doc_id"]]])
        assert r["taken"] == r["size"] * r["copies"] <= 3 * r["size"]
        taken[of[r["doc_id"]]] += r["taken"]
    for s in order:
        # s2 has one text of most of its words; the others are fine-grained.
        assert abs(taken[s] - target[s]) <= (30_000 if s == "s2" else 60)
    assert sorted(found, key=str) == sorted(mixing.mixed(docs).collect(), key=str)


def test_documents_are_repeated(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, source string, copies string")
    number = {}
    for r in mixing.mixed(docs).collect():
        number[r["doc_id"]] = r["copies"]
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    times = {}
    for r in mixed.collect():
        assert r["copies"] == "extra"
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert times == {i: n * (3 if i == 7 else 1) for i, n in number.items() if n}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mixed(docs).count() == 0
    assert mixing.mix_documents(docs).columns == docs.columns
