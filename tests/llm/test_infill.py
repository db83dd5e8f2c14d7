"""Fill-in-the-middle against lists of lines, and the text rebuilt from its output."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logweir.llm import infill

TEXTS = [
    None,
    "",
    "\n",
    "\n\n\n",
    "one",
    "one\n",
    "one\ntwo",
    "é\nüß\n漢字\n🙂 end",
    "a <P> b\nc",
    "<S>",
    "x\n<M>\ny",
    "<P\nS>\n<\n>M>\n<S",
    "<\n<S\n<M\n<P",
    "\x0b\x0d\x8a\n\x0aĊਊ",
    "\r\nx\r\n",
    "line\n" * 30_000 + "end",
    "漢" * 200_000,
]


def brute(doc_id, text, how=infill.Infill()):
    body = text or ""
    digest = hashlib.sha256(f"{how.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", body)
    n = len(units)
    a, b = sorted(x % (n + 1) for x in h[:2])
    marks = (how.prefix, how.suffix, how.middle)
    if not body or any(m in body for m in marks) or h[2] % 100 >= how.percent:
        return doc_id, n, "plain", None, None, body
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < how.suffix_first:
        form, out = "spm", how.suffix + suffix + how.prefix + prefix + how.middle + middle
    else:
        form, out = "psm", how.prefix + prefix + how.suffix + suffix + how.middle + middle
    return doc_id, n, form, len(prefix), len(middle), out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, str(r[1:])))


@given(st.lists(st.text(alphabet="\n\x8aabĊé漢🙂", max_size=40), min_size=1, max_size=6), st.integers(0, 2**32))
@settings(max_examples=200, deadline=None)
def test_cuts_equal_lists_of_lines(texts, draw):
    bodies = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, bodies)])
    data = np.frombuffer(b"".join(bodies), np.uint8)
    draws = np.array([[(draw * 7919 + i) % 2**32, (draw * 104729 + 3 * i) % 2**32] for i in range(len(texts))])
    lines, first, second, prefixed, amid = infill.cuts(data, offsets, draws)
    for i, text in enumerate(texts):
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        a, b = sorted(int(x) % (len(units) + 1) for x in draws[i])
        prefix, middle = "".join(units[:a]), "".join(units[a:b])
        assert lines[i] == len(units)
        assert first[i] - offsets[i] == len(prefix.encode())
        assert second[i] - first[i] == len(middle.encode())
        assert (prefixed[i], amid[i]) == (len(prefix), len(middle))


@pytest.mark.parametrize(
    "how", [infill.Infill(), infill.Infill(3, 60, 20, "[pre]", "[suf]", "[mid]")], ids=["default", "other"]
)
def test_every_row(spark, how):
    data = [(k, t) for k, t in enumerate(TEXTS * 4)] + [(5, "a\nb\nc"), (5, "a\nb\nc"), (None, "a\nb\nc"), (-3, "x\ny")]
    rows = [(a, b, "x", 7, 0.5) for a, b in data]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, n int, digest double").repartition(3)
    want = [brute(a, b, how) for a, b in data]
    made = infill.transform(docs, how)
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert ordered(map(tuple, made.collect())) == ordered(want)
    found = infill.digests(docs, how)
    assert ordered(map(tuple, found.collect())) == ordered(
        (*w[:5], sha(w[5]), sha(t or "")) for w, (_, t) in zip(want, data, strict=True)
    )
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_bytes_that_are_not_text_come_back(spark):
    docs = spark.sql(r"select id as doc_id, cast(x'610aff0a80c30a62' as string) as text from range(20)")
    want = hashlib.sha256(bytes.fromhex("610aff0a80c30a62")).hexdigest()
    found = infill.digests(docs).collect()
    assert {r["restored_sha256"] for r in found} == {want}
    assert {r["n"] for r in found} == {4}


def test_marks_that_overlap_are_refused():
    for marks in (("<P>", "<P>", "<M>"), ("ab", "bc", "x"), ("", "<S>", "<M>"), ("a", "xay", "z")):
        with pytest.raises(ValueError, match="overlap"):
            infill.Infill(7, 100, 50, *marks)


def test_empty_table(spark):
    assert infill.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
