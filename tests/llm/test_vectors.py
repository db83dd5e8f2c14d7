"""Embedding near-duplicates against all pairs."""

import numpy as np
import pytest

from logweir.llm import vectors


def brute(ids, data):
    def fit(i):
        v = data[i]
        return ids[i] is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = {i: set() for i in range(len(ids))}
    by_size = {}
    for i in filter(fit, range(len(ids))):
        by_size.setdefault(len(data[i]), []).append(i)
    for mine in by_size.values():
        e = np.array([data[i] for i in mine], dtype=float)
        e /= np.abs(e).max(axis=1, keepdims=True)
        e /= np.linalg.norm(e, axis=1)[:, None]
        for a, b in zip(*np.nonzero(e @ e.T >= vectors.COSINE), strict=True):
            if a != b:
                links[mine[a]].add(mine[b])
    out, seen = [], set()
    for start in links:
        if start in seen:
            continue
        members, todo = {start}, [start]
        while todo:
            for y in links[todo.pop()] - members:
                members.add(y)
                todo.append(y)
        seen |= members
        least = None if ids[start] is None else min(ids[x] for x in members)
        out += [(ids[x], len(links[x]), least, ids[x] is not None and ids[x] == least) for x in members]
    return sorted(out, key=str)


def made():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 64))
    data = [(base[k % 12] + rng.normal(size=64) * 0.3 * (k % 5)).tolist() for k in range(240)]
    data += [data[0]] * 20 + [None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [None] + [1.0] * 63, [float("inf")] * 64]
    data += [[1e300] * 64, [1e-300] * 64, [1.0] * 64, [1.0, 2.0], [2.0, 4.0], [1.0], [-3.0], [5.0]]
    ids = list(range(len(data)))[::-1]
    ids[5], ids[7] = None, ids[8]
    return ids, data


@pytest.mark.parametrize("chunk", [vectors.CHUNK, 7])
def test_links_of_all_pairs(spark, chunk):
    ids, data = made()
    rows = spark.createDataFrame([(i, v, "x") for i, v in zip(ids, data, strict=True)], "vec_id long, embedding array<double>, kept string")
    found = vectors.near_vectors(rows, chunk=chunk)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(ids, data)


def test_single_precision(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(40, 24)).astype(np.float32)
    data = [(base[k % 40] + rng.normal(size=24) * 0.25).astype(np.float32).tolist() for k in range(160)]
    rows = spark.createDataFrame(list(enumerate(data)), "vec_id long, embedding array<float>")
    want = brute(list(range(160)), data)
    assert sum(r[1] > 0 for r in want) > 20
    assert sorted(map(tuple, vectors.near_vectors(rows).collect()), key=str) == want


def test_a_linked_pair_keeps_some_blocks_budget():
    rng = np.random.default_rng(3)
    own = vectors.space(64, vectors.COSINE)
    a = rng.normal(size=(500, 64))
    b = a + rng.normal(size=(500, 64)) * rng.choice([0.05, 0.3, 0.45], (500, 1))
    a, b = (x / np.linalg.norm(x, axis=1)[:, None] for x in (a, b))
    linked = (a * b).sum(axis=1) >= vectors.COSINE
    assert 50 < linked.sum() < 500
    first = own.first_block(own.rotated(a), own.rotated(b))
    apart = np.add.reduceat((own.rotated(a) - own.rotated(b)) ** 2, own.edges[:-1], axis=1)
    assert (apart[np.arange(500), first] <= own.budgets[first] * (1 + 1e-8))[linked].all()


def test_empty_table(spark):
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
