"""Encoding by lexicon and merges against the library, and the lexicon's own properties."""

import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logweir.llm import transducer, wordbpe
from logweir.llm.queries import op11_transducer, word_tokenizer_path

ODD = [
    "",
    " \n\t ",
    "The cat's hat isn't theirs; we'LL they'Re I'm 'sup ''s !'s d'd",
    "a<|endoftext|>B <|startoftext|><|endoftext|> c <|ENDOFTEXT|> <|endoftext|",
    "é é Å ẞ İstanbul ΣΑΣ Σ. ǅ ﬁ ª º µ",
    "\u0085x y z​w\x1cq\x1fr\x00s\x7ft",
    "１２ ² ½ 12 3.4 Ⅷ ٣",
    "漢字かな交じり 한국어 кириллица Ёж ελληνικά עברית",
    "🙂🙃 👩‍👩‍👧 é́ n̂",
    "$%&*!!! ---- ... a.b,c;d «x» ¡y! ©®±´¶·¸×÷",
    "na" * 40 + " " + "!" * 90,
    "x" * 5_000,
    "ab" * 3_000 + "é" * 500,
    "abc\xadabc ſ ŉ",
    "word " * 20_000,
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_tokenizer_path())


@pytest.fixture(scope="module")
def rule():
    return wordbpe.rules(word_tokenizer_path())


def lexicon(rule, words, path):
    merged = wordbpe._merger(rule)
    path.write_bytes(transducer.compiled([(w, tuple(merged(w))) for w in sorted(words)], rule.merges, rule.symbols))
    return str(path)


@pytest.fixture(scope="module")
def coders(rule, tmp_path_factory, spark, sf):
    """With no word known, with some, and with many."""
    folder = tmp_path_factory.mktemp("lexicons")
    texts = [r[0] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    words = sorted({w.encode() for t in texts for w in rule.words(t) if len(w.encode()) <= 64})
    chosen = [[], words[::3] + [b"the" * 9], words]
    return texts, [wordbpe.Coder(rule, lexicon(rule, set(w), folder / f"{i}.bin")) for i, w in enumerate(chosen)]


def test_ids_equal_the_library(coders, library):
    texts, made = coders
    texts = texts + ODD
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for code in made:
        assert code(texts).to_pylist() == want


@given(st.text(alphabet="aAbtThe 'sSdélLΣσİı<|endoftext>1½.!\ń ‍漢🙂", max_size=60))
@settings(max_examples=300, deadline=None)
def test_ids_of_any_text(coders, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    assert [code([text]).to_pylist()[0] for code in coders[1]] == [want] * 3


def test_ids_of_random_characters(coders, library):
    rng = random.Random(5)
    points = [c for c in range(0x20, 0x3000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(chr(rng.choice(points)) for _ in range(200)) for _ in range(300)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert coders[1][1](texts).to_pylist() == want


def test_every_usual_character_alone_and_in_words(coders, library):
    usual = [chr(c) for c in range(0x20, 0x9FA6) if wordbpe.UNUSUAL.search(chr(c)) is None]
    texts = [f"a{c}b {c} {c}1 {c.upper()}{c}" for c in usual]
    assert len(texts) > 21_000
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert coders[1][0](texts).to_pylist() == want


def machine_size(words):
    """States of the smallest machine: different remainders of outputs, counted by definition."""

    def rest(prefix):
        tails = {w[len(prefix) :]: ids for w, ids in words.items() if w.startswith(prefix)}
        outs = list(tails.values())
        n = 0
        while all(len(o) > n and o[n] == outs[0][n] for o in outs):
            n += 1
        return frozenset((w, o[n:]) for w, o in tails.items())

    prefixes = {w[:k] for w in words for k in range(len(w) + 1)}
    # The start keeps its outputs on its arcs.
    return len({rest(p) for p in prefixes if p}) + 1


@given(
    st.dictionaries(
        st.binary(min_size=1, max_size=5).map(lambda b: bytes(x % 3 + 97 for x in b)),
        st.lists(st.integers(0, 2), min_size=1, max_size=4).map(tuple),
        max_size=25,
    )
)
@settings(max_examples=300, deadline=None)
def test_transducer_is_minimal_and_right(words):
    states = transducer.minimal(sorted(words.items()))
    assert len(states) == machine_size(words)

    def read(word):
        tail, arcs = states[-1]
        out = ()
        for b in word:
            step = [(to, ids) for x, to, ids in arcs if x == b]
            if not step:
                return None
            out += step[0][1]
            tail, arcs = states[step[0][0]]
        return None if tail is None else out + tail

    for n in range(1, 5):
        for word in map(bytes, itertools.product(b"abc", repeat=n)):
            assert read(word) == words.get(word)


@given(st.lists(st.sets(st.integers(0, 40), max_size=9), max_size=30))
@settings(max_examples=200, deadline=None)
def test_rows_do_not_overlap(rows):
    rows = [np.array(sorted(r), np.int64) for r in rows]
    base, cells = transducer.overlay(rows, 41)
    used = [int(b + c) for b, r in zip(base, rows, strict=True) for c in r]
    assert len(set(used)) == len(used)
    assert base.min(initial=0) >= 0 and (base + 41 <= cells).all()


def test_unsorted_words_and_foreign_files_are_refused(tmp_path):
    with pytest.raises(ValueError, match="sorted"):
        transducer.minimal([(b"b", (1,)), (b"a", (2,))])
    (tmp_path / "x").write_bytes(b"\0" * 64)
    with pytest.raises(ValueError, match="not a lexicon"):
        transducer.Lexicon(str(tmp_path / "x"))


def row(library, doc_id, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return doc_id, len(ids), *[hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded)]


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("share", [wordbpe.SHARE, 50, 1])
def test_every_row(spark, library, share):
    data = [(k, t) for k, t in enumerate(ODD)] + [(3, "a b"), (3, "a b"), (None, "c c c"), (-1, None)]
    rows = [(a, b, "x", [1], 2) for a, b in data]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, ids array<int>, n int").repartition(3)
    found = wordbpe.digests(docs, word_tokenizer_path(), share)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert ordered(found.collect()) == ordered(row(library, a, b) for a, b in data)


def test_query_equals_the_library(spark, library, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert ordered(op11_transducer(spark, sf).collect()) == ordered(row(library, *r) for r in docs)


def test_frequent_words_are_bounded_by_their_share(spark):
    text = "the " * 50 + " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150)) + " " + "q" * 80
    docs = spark.createDataFrame([(1, text), (2, text), (3, None)], "doc_id long, text string")
    counts = wordbpe.word_counts(docs.repartition(2), word_tokenizer_path())
    assert {r["word"]: r["n"] for r in counts.collect()}["the"] == 100
    assert wordbpe.frequent(counts, 10) == [b"the"]
    assert len(wordbpe.frequent(counts, 1000)) == 151  # not the long one
    assert wordbpe.frequent(counts, 1) == []


def test_decoding_numbers_that_are_no_tokens(spark, library):
    lists = [[320, 49407, 99999, -1, 0], [], [5], None]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(lists)], "doc_id long, ids array<int>")
    found = {r["doc_id"]: r["decoded"] for r in wordbpe.decode(rows, word_tokenizer_path()).collect()}
    valid = [[i for i in x or [] if 0 <= i < 49408] for x in lists]
    assert [found[k] or "" for k in range(4)] == [library.decode(x, skip_special_tokens=False) for x in valid]


def test_empty_table_and_bytes_that_are_not_text(spark, library):
    assert wordbpe.digests(spark.createDataFrame([], "doc_id long, text string"), word_tokenizer_path()).count() == 0
    docs = spark.sql("select 1L as doc_id, cast(x'61ff62' as string) as text")
    assert ordered(wordbpe.digests(docs, word_tokenizer_path()).collect()) == [row(library, 1, "a�b")]


def test_other_tokenizers_are_refused():
    from logweir.llm.queries import tokenizer_path

    with pytest.raises((ValueError, KeyError)):
        wordbpe.Rules(tokenizer_path())


def test_list_of_no_texts(coders):
    assert coders[1][0]([]).to_pylist() == []
    assert coders[1][0](["", " "]).type == pa.list_(pa.int32())
