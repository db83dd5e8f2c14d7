"""Runs of words and their grammar against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logweir.llm import periodic
from logweir.llm.queries import op12_periodic
from logweir.llm.recompression import Grammar


def extension(seq, a, b, step):
    n = 0
    while 0 <= a < len(seq) and 0 <= b < len(seq) and seq[a] == seq[b]:
        a, b, n = a + step, b + step, n + 1
    return n


def brute_runs(words, times=4, least=6):
    """Every maximal stretch of every period, the smallest period of each."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            n = extension(words, i, i + q, 1)
            if n + q >= max(least, times * q):
                found.setdefault((i, n + q), q)
            i += n + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, plant=False):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if plant and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = (None,) * 4
    if runs:
        top = runs[0]
        for r in runs:
            if r[1] * top[2] > top[1] * r[2]:
                top = r
        best = (*top, 1000 * top[1] // top[2])
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, *[hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)])


def dense(seq):
    return np.unique(np.array(seq, np.int64), return_inverse=True)[1]


@given(st.lists(st.integers(0, 3), min_size=1, max_size=8), st.integers(1, 40), st.lists(st.integers(0, 3), max_size=30))
@settings(max_examples=150, deadline=None)
def test_extensions_equal_comparison(piece, repeats, tail):
    seq = piece * repeats + tail + piece * 2
    grammar = Grammar(dense(seq))
    rng = np.random.default_rng(len(seq))
    a, b = rng.integers(0, len(seq), 60), rng.integers(0, len(seq), 60)
    a, b = np.minimum(a, b), np.maximum(a, b)
    a, b = a[a < b], b[a < b]
    if not len(a):
        return
    assert grammar.right(a, b).tolist() == [extension(seq, x, y, 1) for x, y in zip(a, b, strict=True)]
    assert grammar.left(a, b).tolist() == [extension(seq, x - 1, y - 1, -1) for x, y in zip(a, b, strict=True)]


def test_grammar_of_long_repeats_is_small():
    unit = np.random.default_rng(3).integers(0, 50, 997)
    seq = np.tile(unit, 60)
    grammar = Grammar(dense(seq))
    assert sum(len(level.symbols) for level in grammar.levels) < 8 * len(seq)
    at = np.arange(0, 50_000, 1009)
    assert grammar.right(at, at + 997).tolist() == (len(seq) - 997 - at).tolist()
    assert grammar.left(at, at + 997).tolist() == at.tolist()


@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=5), st.integers(2, 4), st.integers(2, 8))
@settings(max_examples=200, deadline=None)
def test_runs_equal_brute_force(texts, times, least):
    check(texts, times, least)


@given(st.integers(1, 5), st.integers(1, 12), st.integers(0, 9999))
@settings(max_examples=150, deadline=None)
def test_runs_in_nested_repeats(symbols, repeats, seed):
    rng = np.random.default_rng(seed)
    unit = rng.integers(0, symbols, rng.integers(1, 6)).tolist()
    inner = unit * repeats
    text = (inner + rng.integers(0, symbols, 3).tolist()) * int(rng.integers(1, 7)) + unit
    check([text, text[::-1], [], text[3:]], 4, 6)
    check([text, text[1:]], 2, 2)


def check(texts, times, least):
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    codes = np.array([x for t in texts for x in t], np.int32)
    found = list(zip(*(x.tolist() for x in periodic.word_runs(codes, offsets, times, least)), strict=True))
    assert found == [(i, *r) for i, t in enumerate(texts) for r in brute_runs(t, times, least)]


def test_candidates_in_small_parts(monkeypatch):
    monkeypatch.setattr(periodic, "CANDIDATES", 7)
    check([[0] * 50 + [1, 2] * 20 + [0] * 9, [], [3] * 6, [1, 2, 3] * 5], 4, 6)


TEXTS = [
    None,
    "",
    " \t\n ",
    "a",
    "a a a a a",
    "a a a a a a",
    "x " + "a b " * 4 + "a y",
    "ha " * 500 + "end",
    ("a b " * 4 + "c ") * 5,
    "a b a b a b a b a b a b",
    "a\x0ba\x0ca\ra\ta\na a",
    "é ß é ß é ß é ß é",
    " ".join(f"w{i}" for i in range(300)) + " x y z" * 7,
]


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, str(r)))


def test_every_row(spark):
    data = [(k, t) for k, t in enumerate(TEXTS)] + [(3, TEXTS[7]), (3, TEXTS[7]), (None, TEXTS[6]), (-5, TEXTS[8])]
    rows = [(a, b, "x", 1, [2]) for a, b in data]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, h int, words array<int>").repartition(3)
    found = periodic.digests(docs)
    want = [brute_row(a, b) for a, b in data]
    assert found.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    ]
    assert ordered(map(tuple, found.collect())) == ordered(want)
    texts = {r["doc_id"]: r["collapsed"] for r in periodic.collapse(docs).filter("doc_id = 6").collect()}
    assert texts == {6: "x a b y"}
    planted = periodic.digests(periodic.with_planted_runs(docs))
    assert planted.count() == len(data)


def test_a_very_long_text_of_one_word(spark):
    docs = spark.createDataFrame([(1, "na " * 300_000)], "doc_id long, text string")
    row = periodic.digests(docs).first()
    assert (row["n_runs"], row["start"], row["length"], row["period"]) == (1, 0, 300_000, 1)


def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = [brute_row(r["doc_id"], r["text"], plant=True) for r in docs]
    assert sum(r[1] > 0 for r in want) > 10
    assert ordered(map(tuple, op12_periodic(spark, sf).collect())) == ordered(want)


def test_defined_bounds(spark):
    assert periodic.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError, match="repeats"):
        periodic.collapse(spark.createDataFrame([], "doc_id long, text string"), times=1)
