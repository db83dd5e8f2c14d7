"""Benchmark decontamination: a BM25 index of the test items, asked by every passage.

Every document is cut into overlapping passages twice as long as the longest item, so an
item's words always lie within one passage. A passage asks the index for all items whose
BM25 score reaches ``THRESHOLD`` of the score that the item gives itself. Items are held in
blocks, and each term knows its largest impact in each block: a block whose bound stays
under the threshold is skipped, for all passages of a batch at once; in the others the
posting lists are walked with pivots (WAND). Very common terms are not walked to find
candidates; what they can add at most is part of the bound, so nothing above the threshold
is lost.

A candidate counts as a leak if the passage holds ``OVERLAP`` of the item's distinct
five-word shingles, and ``PART`` of those of its question and of its answer, each. An item
without columns of its own for them has its last quarter of words as answer.

The index is made for at most ``ITEMS`` items at a time and sent to the tasks; a larger
benchmark takes several rounds over the documents, whose results are united.

Defined results: null and empty texts and items leak nothing; an item under five words is
one shingle; ids may repeat and then stand for all their rows; rows with a null document id
are reported under null; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
OVERLAP = 0.8
PART = 0.5
THRESHOLD = 0.5
K1, B = 1.2, 0.75
#: Items of a block of posting lists, of a round, and the share of items that makes a term common.
BLOCK = 8
ITEMS = 20_000
COMMON = 0.1
#: Tokens that are searched together.
HELD_TOKENS = 400_000
WORD = re.compile(r"\w+")


def tokens(text: str) -> list[str]:
    return WORD.findall(text.lower())


def shingles(words: Sequence[str]) -> set[tuple[str, ...]]:
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}


@dataclass
class Item:
    item_id: int
    words: list[str]
    whole: set = field(default_factory=set)
    question: set = field(default_factory=set)
    answer: set = field(default_factory=set)

    def __post_init__(self):
        cut = len(self.words) - max(len(self.words) // 4, SHINGLE)
        self.whole = shingles(self.words)
        self.question = shingles(self.words[:cut]) if cut >= SHINGLE else self.whole
        self.answer = shingles(self.words[cut:]) if cut >= SHINGLE else self.whole

    def overlaps(self, passage: set) -> tuple[float, float, float]:
        return tuple(len(part & passage) / len(part) for part in (self.whole, self.question, self.answer))


class Index:
    """Posting lists with block maxima; impacts are shares of an item's score of itself."""

    def __init__(self, items: list[Item]):
        self.items = items
        n = len(items)
        length = np.array([len(i.words) for i in items], dtype=float)
        self.longest = int(length.max(initial=1))
        mean = float(length.mean()) if n else 1.0
        held = [Counter(i.words) for i in items]
        spread = Counter(t for c in held for t in c)
        self.term = {t: k for k, t in enumerate(spread)}
        idf = {t: float(np.log1p((n - d + 0.5) / (d + 0.5))) for t, d in spread.items()}
        lists: list[list[tuple[int, float]]] = [[] for _ in self.term]
        self.self_score = np.zeros(n)
        for i, count in enumerate(held):
            norm = K1 * (1 - B + B * length[i] / mean)
            impact = {t: idf[t] * k * (K1 + 1) / (k + norm) for t, k in count.items()}
            self.self_score[i] = sum(impact.values())
            for t, x in impact.items():
                lists[self.term[t]].append((i, x / self.self_score[i]))
        common = {self.term[t] for t, d in spread.items() if d > max(COMMON * n, BLOCK)}
        self.rare = np.array([t not in common for t in range(len(lists))], dtype=bool)
        # Postings of a term within a block.
        self.lists: dict[tuple[int, int], list[tuple[int, float]]] = {}
        for t, found in enumerate(lists):
            for i, x in found:
                self.lists.setdefault((t, i // BLOCK), []).append((i, x))
        # What the common terms can add to the items of a block.
        rest = np.zeros(n)
        for t in common:
            for i, x in lists[t]:
                rest[i] += x
        self.blocks = -(-n // BLOCK)
        self.rest = np.array([rest[b * BLOCK : (b + 1) * BLOCK].max(initial=0.0) for b in range(self.blocks)])
        # Block maxima of the rare terms, one run of entries for each term.
        starts, block, most = [0], [], []
        for t, found in enumerate(lists):
            best: dict[int, float] = {}
            if self.rare[t]:
                for i, x in found:
                    best[i // BLOCK] = max(best.get(i // BLOCK, 0.0), x)
            block.extend(best)
            most.extend(best.values())
            starts.append(len(block))
        self.starts = np.array(starts)
        self.block, self.most = np.array(block, dtype=np.int64), np.array(most)

    def open_blocks(
        self, passages: int, passage: np.ndarray, term: np.ndarray, threshold: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """(passage, block) pairs whose bound reaches the threshold, from distinct (passage, term)."""
        count = self.starts[term + 1] - self.starts[term]
        row = np.repeat(np.arange(len(term)), count)
        at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + self.starts[term][row]
        key = passage[row] * self.blocks + self.block[at]
        found, place = np.unique(key, return_inverse=True)
        bound = np.bincount(place, weights=self.most[at]) + self.rest[found % self.blocks]
        found = found[bound >= threshold - 1e-9]
        # Items that common terms alone can bring over the threshold are open to every passage.
        always = np.flatnonzero(self.rest >= threshold - 1e-9)
        if len(always):
            every = (np.arange(passages)[:, None] * self.blocks + always).ravel()
            found = np.union1d(found, every)
        return found // self.blocks, found % self.blocks

    def search(self, terms: set[int], block: int, threshold: float) -> list[tuple[int, float]]:
        """(item, score) of the block's items that reach the threshold, by WAND."""
        parts = [self.lists[t, block] for t in terms if (t, block) in self.lists]
        lists = [[max(x for _, x in part), 0, part] for part in parts]
        found = []
        while lists:
            lists.sort(key=lambda e: e[2][e[1]][0])
            bound, pivot = 0.0, None
            for most, at, part in lists:
                bound += most
                if bound >= threshold - 1e-9:
                    pivot = part[at][0]
                    break
            if pivot is None:
                break
            if lists[0][2][lists[0][1]][0] == pivot:
                score = 0.0
                for entry in lists:
                    if entry[2][entry[1]][0] == pivot:
                        score += entry[2][entry[1]][1]
                        entry[1] += 1
                if score >= threshold - 1e-9:
                    found.append((pivot, score))
            else:
                for entry in lists:
                    while entry[1] < len(entry[2]) and entry[2][entry[1]][0] < pivot:
                        entry[1] += 1
            lists = [e for e in lists if e[1] < len(e[2])]
        return found


def leaks(index: Index, texts: list[str], threshold: float = THRESHOLD) -> list[tuple[int, int, float, float, float, float]]:
    """(text, item, score, overlap, question overlap, answer overlap) of verified candidates."""
    if not index.items:
        return []
    stride, term_of = index.longest, index.term
    words = [tokens(t) for t in texts]
    ids = np.array([term_of.get(w, -1) for x in words for w in x], dtype=np.int64)
    lengths = np.array([len(x) for x in words])
    if not len(ids):
        return []
    first = np.cumsum(lengths) - lengths
    text_of = np.repeat(np.arange(len(words)), lengths)
    position = np.arange(len(ids)) - first[text_of]
    # Passage k of a text has the words [k * stride, (k + 2) * stride).
    passages = np.maximum(-(-lengths // stride) - 1, 1)
    passage0 = np.cumsum(passages) - passages
    k = position // stride
    known = (ids >= 0) & index.rare[np.maximum(ids, 0)]
    keys = []
    for shift in (0, 1):
        at = known & (k - shift >= 0) & (k - shift < passages[text_of])
        keys.append((passage0[text_of[at]] + k[at] - shift) * len(term_of) + ids[at])
    key = np.unique(np.concatenate(keys))
    open_passage, open_block = index.open_blocks(
        int(passages.sum()), key // len(term_of), key % len(term_of), threshold
    )
    best: dict[tuple[int, int], tuple[float, float, float, float]] = {}
    last, held, passage_shingles = -1, set(), set()
    for p, b in zip(open_passage.tolist(), open_block.tolist(), strict=True):
        text = int(np.searchsorted(passage0, p, side="right") - 1)
        if p != last:
            start = (p - int(passage0[text])) * stride
            passage_words = words[text][start : start + 2 * stride]
            held = {term_of[w] for w in passage_words if w in term_of}
            passage_shingles, last = None, p
        for item, score in index.search(held, b, threshold):
            if passage_shingles is None:
                passage_shingles = shingles(passage_words)
                short = set()
            wanted = index.items[item]
            size = len(wanted.words)
            if size < SHINGLE:
                short = {tuple(passage_words[i : i + size]) for i in range(len(passage_words) - size + 1)}
            whole, question, answer = wanted.overlaps(passage_shingles if size >= SHINGLE else short)
            if whole >= OVERLAP and question >= PART and answer >= PART:
                row = (whole, score, question, answer)
                best[text, item] = max(best.get((text, item), row), row)
    return [(t, i, s, w, q, a) for (t, i), (w, s, q, a) in sorted(best.items())]


def item_rounds(benchmark: DataFrame, items: int = ITEMS) -> Iterator[Index]:
    """Indexes of at most about ``items`` items, together of all."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    rounds = -(-rows.count() // items)
    for r in range(rounds):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)) == r).collect()
        held = [Item(x["item_id"], tokens(x["text"])) for x in sorted(part, key=lambda x: (x["item_id"] or 0, x["text"]))]
        yield Index([i for i in held if i.words])


def _batches(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Slices of bounded text, so that very long texts do not meet in one search."""
    for batch in batches:
        start, size = 0, 0
        for i, text in enumerate(batch[column]):
            n = len(text.as_py() or "") // 5 if text.is_valid else 0
            if size and size + n > HELD_TOKENS:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < len(batch):
            yield batch.slice(start)


def leaked_items(docs: DataFrame, benchmark: DataFrame, items: int = ITEMS) -> DataFrame:
    """doc_id, item_id, score, overlap, question_overlap, answer_overlap of every leak."""
    schema = "doc_id long, item_id long, score double, overlap double, question_overlap double, answer_overlap double"
    kinds = [pa.int64(), pa.int64(), *[pa.float64()] * 4]
    names = [c.split()[0] for c in schema.split(", ")]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def searcher(index: Index):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _batches(batches, "text"):
                ids = batch["doc_id"].to_pylist()
                found = [
                    (ids[t], index.items[i].item_id, s, w, q, a)
                    for t, i, s, w, q, a in leaks(index, batch["text"].to_pylist())
                ]
                if found:
                    columns = zip(zip(*found, strict=True), kinds, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], names=names)

        return search

    out = docs.sparkSession.createDataFrame([], schema)
    for index in item_rounds(benchmark, items):
        out = out.union(rows.mapInArrow(searcher(index), schema))
    most = [F.max(c).alias(c) for c in names[2:]]
    return out.groupBy("doc_id", "item_id").agg(*most)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, items: int = ITEMS) -> DataFrame:
    """The rows of ``docs`` that hold no test item."""

    def keeper(index: Index):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in _batches(batches, "text"):
                bad = {t for t, *_ in leaks(index, [x or "" for x in batch["text"].to_pylist()])}
                yield batch.filter(pa.array([i not in bad for i in range(len(batch))], pa.bool_()))

        return keep

    for index in item_rounds(benchmark, items):
        docs = docs.mapInArrow(keeper(index), docs.schema)
    return docs
