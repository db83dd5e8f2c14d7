"""Periodic runs of words, found by recompression and cut to their first period.

A run is a stretch of words with smallest period q, at least ``times`` periods and ``least``
words long, that no neighbouring word extends. Such a stretch holds ``times`` neighbouring points
of the grid 0, q, 2q, ... with the same word, so the candidates of a text of n words are the
grid points of every period up to n / times at which that many equal words follow: n log n
places, most of which one comparison rejects. Texts with candidates are compressed into a
run-length grammar (``recompression``), which gives the exact extension to both sides of every
candidate. Equal stretches found with a multiple of their period keep the smallest one.

Texts are handled whole in the task that reads them, PIECE bytes of text, or one longer text, at
once, and CANDIDATES places at a time; nothing is shuffled, so neither hot sources nor groups of
copies meet in a task. Words of different documents never match.

Defined results: words are what stands between ASCII white space; a null, empty or blank text has
no words and no runs; rows with one id, or one text, are found alike, each for itself; bytes that
are not UTF-8 are parts of words; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import pieces, utf8
from logweir.llm.recompression import Grammar

TIMES, LEAST = 4, 6
PIECE = 4 << 20
CANDIDATES = 1 << 20
RUNS = "array<struct<start: long, length: long, period: long>>"


def _candidates(codes: np.ndarray, offsets: np.ndarray, times: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, place, period) of grid points with ``times`` equal words, in parts."""
    sizes = np.diff(offsets)
    longest = sizes // times
    text = np.repeat(np.arange(len(sizes)), longest)
    period = np.arange(len(text)) - np.repeat(np.cumsum(longest) - longest, longest) + 1
    points = (sizes[text] - 1) // period - times + 2
    ends = np.cumsum(points)
    row = 0
    while row < len(text):
        done = int(ends[row - 1]) if row else 0
        stop = max(int(np.searchsorted(ends, done + CANDIDATES, side="right")), row + 1)
        part, count = slice(row, stop), points[row:stop]
        q = np.repeat(period[part], count)
        k = np.arange(len(q)) - np.repeat(ends[part] - count - done, count)
        place = np.repeat(offsets[text[part]], count) + k * q
        of = np.repeat(np.arange(row, stop), count)
        for j in range(1, times):
            same = np.flatnonzero(codes[place] == codes[place + j * q])
            place, q, of = place[same], q[same], of[same]
        if len(place):
            yield text[of], place, q
        row = stop


def _smallest(start: np.ndarray, length: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """One row for each stretch, with its smallest period, in order."""
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    return start[first], length[first], period[first]


def word_runs(
    codes: np.ndarray, offsets: np.ndarray, times: int = TIMES, least: int = LEAST
) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of every run, by text, start and period.

    ``codes`` are numbers of words, texts begin at ``offsets``; starts count from the text's own.
    """
    codes = codes.astype(np.int64)
    some = np.zeros(len(offsets) - 1, bool)
    for text, _, _ in _candidates(codes, offsets, times):
        some[text] = True
    none = np.zeros(0, np.int64)
    if not some.any():
        return none, none, none, none
    texts = np.flatnonzero(some)
    sizes = np.diff(offsets)[texts]
    kept = np.concatenate([[0], np.cumsum(sizes)])
    of = np.repeat(np.arange(len(texts)), sizes)
    codes = codes[np.arange(kept[-1]) + np.repeat(offsets[texts] - kept[:-1], sizes)]
    # Words of different texts have different symbols.
    grammar = Grammar(np.unique(of * (int(codes.max()) + 1) + codes, return_inverse=True)[1])
    found = [none, none, none]
    for _, place, q in _candidates(codes, kept, times):
        left = grammar.left(place, place + q)
        length = left + q + grammar.right(place, place + q)
        whole = np.flatnonzero(length >= np.maximum(least, times * q))
        stretch = (place - left)[whole], length[whole], q[whole]
        found = _smallest(*(np.concatenate(x) for x in zip(found, stretch, strict=True)))
    start, length, period = found
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    text = np.searchsorted(kept, start, side="right") - 1
    return texts[text], start - kept[text], length, period


def collapse(docs: DataFrame, times: int = TIMES, least: int = LEAST) -> DataFrame:
    """doc_id, runs and the text without the words that a run repeats.

    Of every run the first period stays, unless another run drops words of it; the words left
    are joined by one space. ``runs`` are in order of start and period; words count from 0.
    """
    if times < 2:
        raise ValueError("a run repeats at least once")
    schema = f"doc_id long, runs {RUNS}, collapsed binary"

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "body", PIECE):
            words = [body.split() for body in batch["body"].to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
            flat = pa.array(chain.from_iterable(words), pa.binary())
            codes = flat.dictionary_encode().indices.to_numpy()
            text, start, length, period = word_runs(codes, offsets, times, least)
            drops = np.zeros(len(flat) + 1, np.int32)
            np.add.at(drops, offsets[text] + start + period, 1)
            np.add.at(drops, offsets[text] + start + length, -1)
            stays = np.cumsum(drops[:-1]) == 0
            out = words
            for t in np.unique(text).tolist():
                out[t] = compress(words[t], stays[offsets[t] : offsets[t + 1]].tolist())
            rows = pa.StructArray.from_arrays(
                [pa.array(start), pa.array(length), pa.array(period)], names=["start", "length", "period"]
            )
            bounds = np.searchsorted(text, np.arange(len(words) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "runs": pa.ListArray.from_arrays(pa.array(bounds), rows),
                    "collapsed": pa.array([b" ".join(w) for w in out], pa.binary()),
                }
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("body"))
    made = rows.mapInArrow(found, schema)
    return made.withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: str) -> Column:
    """The run of ``runs`` with most repetitions, exactly; of equal ones the first."""

    def better(best: Column, run: Column) -> Column:
        more = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | more, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUNS.removeprefix("array<").removesuffix(">")), better)


def digests(docs: DataFrame, times: int = TIMES, least: int = LEAST) -> DataFrame:
    """A row for each document: its runs' number, the strongest one, digests of runs and text."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    rows = collapse(docs, times, least).withColumn("best", strongest("runs"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The query's input: the words of a tenth of the texts repeat from some word on.

    The tenth, the first repeated word and the period follow from a checksum of the id.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.expr("h div 10")
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size("words")
    first = F.expr("cast(g % size(words) as int)")
    period = F.expr("cast(1 + (size(words) - a) div (3 + g % 8) as int)")
    rows = docs.select("doc_id", "text", h.alias("h")).withColumn("g", g)
    picked = rows.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    placed = picked.withColumn("a", F.when(n > 0, first)).withColumn("p", F.when(n > 0, period))
    times = F.expr("cast((size(words) - a) div p + 1 as int)")
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times))
    repeated = F.slice(F.concat(F.slice("words", F.lit(1), F.col("a")), again), F.lit(1), n)
    text = F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.col("text"))
    return placed.select("doc_id", text.alias("text"))
