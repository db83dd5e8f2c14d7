"""SimHash: fingerprints, links and components against all pairs."""

import random
import re

import pytest
import xxhash

from logweir.llm import simhash
from logweir.llm.components import components


def fingerprint(text, width=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(data):
    prints = [(i, fingerprint(t)) for i, t, *_ in data]
    root = {i: i for i, _ in prints if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, f in prints:
        for j, g in prints:
            if i is not None and j is not None and (f ^ g).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted(((i, f"{f:016x}", None if i is None else find(i)) for i, f in prints), key=str)


def data():
    rng = random.Random(5)
    vocabulary = [f"w{k}é" if k % 9 == 0 else f"W{k}" for k in range(300)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([3, 30, 200]))] for _ in range(12)]
    rows = []
    for k in range(150):
        words = list(rng.choice(bases))
        for _ in range(rng.randrange(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((k * 7 % 150, " ".join(words), "x"))
    rows += [(200, None, "x"), (201, "", "x"), (202, " \t\x0b ", "x"), (None, rows[0][1], "x"), rows[3], rows[3]]
    return [*rows, (203, "the " * 50_000, "x"), (204, "a b", "x"), (205, "one\x0btwo", "x")]


@pytest.mark.parametrize("group", [1024, 3])
def test_components_of_all_pairs(spark, group):
    rows = data()
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    found = simhash.near_copies(docs, group=group)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_close_fingerprints_share_a_first_key():
    rng = random.Random(1)
    masks = simhash.key_masks(4)
    assert len(masks) == 35
    for _ in range(500):
        differ = sum(1 << b for b in rng.sample(range(64), 4))
        assert any(differ & m == 0 for m in masks)


def test_one_of_each_component_stays(spark):
    rows = data()
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    found = simhash.drop_near_copies(docs)
    assert found.columns == docs.columns
    want = sorted([i for i in {i for i, _, c in brute(rows) if i is not None and i == c}] + [None], key=str)
    assert sorted((r["doc_id"] for r in found.collect()), key=str) == want


def test_unlike_texts_of_one_id_all_stay(spark):
    """A third of all rows share an id; their texts are copies of three unlike ones."""
    words = [[f"w{k}x{i}" for i in range(60)] for k in range(90)]
    texts = [" ".join(w) for w in words]
    near = " ".join(words[80][:-1])
    data = [(5, texts[k % 3], k) for k in range(40)] + [(100 + k, texts[k], 0) for k in range(3, 80)]
    data += [(300, texts[80], 0), (299, near, 0), (299, texts[81], 0), (None, texts[0], 0), (6, texts[0], 0), (7, None, 0), (8, "", 0)]
    docs = spark.createDataFrame(data, "doc_id long, text string, node int").repartition(5)
    found = simhash.drop_near_copies(docs, distance=12)
    assert found.columns == docs.columns
    rows = sorted(((r["doc_id"], r["text"]) for r in found.collect()), key=str)
    want = [(5, texts[k]) for k in range(3)] + [(100 + k, texts[k]) for k in range(3, 80)]
    want += [(299, near), (299, texts[81]), (None, texts[0]), (7, None)]
    assert rows == sorted(want, key=str)


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 80)] + [(7, 7)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in found} == {**dict.fromkeys(range(80), 0), **dict.fromkeys(range(100, 161), 100)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_copies(docs).count() == 0
    assert simhash.drop_near_copies(docs).count() == 0
