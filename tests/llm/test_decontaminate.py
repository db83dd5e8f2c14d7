"""Decontamination: the index against all items, leaks against all pairs."""

import random

import numpy as np
import pytest

from logweir.llm import decontaminate as d


def brute(docs, items):
    found = set()
    for i, text, *_ in docs:
        words = d.tokens(text or "")
        for k, item in items:
            wanted = d.tokens(item or "")
            if not wanted:
                continue
            if len(wanted) < d.SHINGLE:
                hit = any(words[a : a + len(wanted)] == wanted for a in range(len(words)))
                if hit:
                    found.add((i, k))
                continue
            held, whole = d.shingles(words), d.shingles(wanted)
            cut = len(wanted) - max(len(wanted) // 4, d.SHINGLE)
            parts = [d.shingles(wanted[:cut]), d.shingles(wanted[cut:])] if cut >= d.SHINGLE else [whole, whole]
            if len(whole & held) >= 0.8 * len(whole) and all(2 * len(p & held) >= len(p) for p in parts):
                found.add((i, k))
    return found


def test_documents_of_the_tables(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [tuple(r) for r in items.collect()])
    for size in (20_000, 7):  # in one round and in many
        found = d.leaked_items(docs, items, items=size).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == want
        assert len(found) == len(want) > 20


def made():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(400)]
    weights = [1 / (k + 1) for k in range(400)]
    items = [(k, " ".join(rng.choices(vocabulary, weights, k=rng.choice([3, 8, 30, 60])))) for k in range(60)]
    items += [(60, None), (61, ""), (62, "the of and the"), (5, "another text of item five, that is here"), (None, "an item without any id at all")]
    docs = []
    for k in range(120):
        words = rng.choices(vocabulary, weights, k=rng.choice([0, 5, 50, 400]))
        if k % 2:
            item = (rng.choice(items)[1] or "").split()
            if k % 6 == 1 and item:
                item[rng.randrange(len(item))] = "changed"
            if k % 10 == 3:
                item = item[: len(item) * 9 // 10]
            at = rng.randrange(len(words) + 1)
            words[at:at] = item
        docs.append((k, " ".join(words).upper() if k % 4 == 1 else "\n ".join(words), "x"))
    docs += [(None, items[4][1], "x"), (3, docs[3][1], "x"), (200, None, "x"), (201, "", "x")]
    return [*docs, (202, "w1 w2 " * 30_000 + items[2][1], "x")], items


def test_made_documents(spark):
    rows, items = made()
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items)
    found = d.leaked_items(docs, benchmark)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want
    kept = d.drop_leaks(docs, benchmark, items=9)
    assert kept.columns == docs.columns
    leaked = {i for i, _ in want}
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((r[0] for r in rows if r[0] not in leaked), key=str)
    assert d.drop_leaks(docs, benchmark.limit(0)).count() == len(rows)
    assert d.leaked_items(docs.limit(0), benchmark).count() == 0


@pytest.mark.parametrize("threshold", [0.2, 0.5, 0.9])
def test_search_finds_all_above_the_threshold(threshold):
    rows, items = made()
    index = d.Index([d.Item(i, d.tokens(t)) for i, t in items if d.tokens(t or "")])
    n = len(index.items)
    for _, text, *_ in rows[:60]:
        held = {index.term[w] for w in d.tokens(text or "") if w in index.term}
        score = np.zeros(n)
        for (t, _), found in index.lists.items():
            if t in held:
                for i, x in found:
                    score[i] += x
        terms = np.array(sorted(t for t in held if index.rare[t]), dtype=np.int64)
        _, opened = index.open_blocks(1, np.zeros(len(terms), dtype=np.int64), terms, threshold)
        got = {i for b in opened.tolist() for i, _ in index.search(held, b, threshold)}
        assert {i for i in range(n) if score[i] >= threshold} == got
