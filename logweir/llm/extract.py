"""Main text of web pages by repeated runs of each host.

The text of a host's pages, outside what is marked as article, is one token stream a page, cut
at block borders. A run is boilerplate if it has ``RUN`` tokens or more, or is a whole shorter
block, and stands on a ``SHARE`` of the host's pages (``LEAST`` at least, or all of a smaller
host); or if it has ``LONG`` tokens or more and stands on two pages with different titles.
Exact copies are one page. What is left is main text.

No array is sorted: hashes of the prefixes of all suffixes, of ``RUN`` and ``LONG`` tokens, stand
in for it. The tokens that repeated runs of a length or more cover are those that repeated
prefixes of just that length cover, so both ways remove the same tokens.

Markup is used where it is explicit. Text inside an article element (or, without one, main) is kept even if
pages share it, for a passage that two articles quote, or a copied article, is no boilerplate;
it does not enter the streams. Text inside menus, headers, footers, sidebars, notices, adverts,
forms and reader comments goes even if it is unique on its host. On a page that marks an
article, unmarked text around it goes as well. Text of main around articles is in the streams; if
its blocks of a run or more hold more tokens that are not repeated than the articles do, it is the
story and stays with them, else it goes.

Spark shuffles the text outside articles once, by host and digest of the page, then a hash and a
few numbers for each suffix, combined on the map side, so a run that a third of all pages share
costs each task one row. The repeated prefixes are sent to the tasks
if there are at most ``HELD`` of them (8 bytes each), and pages are cleaned where they are
read; beyond that, suffixes join them by a shuffle and their positions meet the pages by a row
number. Both ways give the same rows.

Defined results: null html has empty text; an address without a host shares one nameless host;
pages without title are told apart by their text; pages with the same text are one for the counts;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import materialize
from logweir.llm.lines import host
from logweir.llm.markup import ARTICLE, MAIN, Block, blocks, title

RUN, LONG = 6, 50
SHARE, LEAST = 0.1, 3
#: Repeated prefixes that are sent to the tasks.
HELD = 2_000_000

#: Kind of the entries that count pages; odd factors that mix two hashes.
HOST = 2
MIX = np.array([0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0xBF58476D1CE4E5B9], dtype=np.uint64)


def _hash(text: str, seed: int) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed)


def _prefixes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the prefixes of ``size`` tokens of all suffixes, by doubling."""
    have = 1
    while have < size:
        step = min(have, size - have)
        hashes = (hashes[:-step] * MIX[0] ^ (hashes[step:] + MIX[1])) * MIX[2]
        hashes ^= hashes >> np.uint64(29)
        have += step
    return hashes


def suffixes(site: str, words: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each prefix inside a block: its hash, first token and length.

    ``words`` has the tokens of each block; a block shorter than a run is an entry as a whole.
    """
    seed = _hash(site, 0) >> 1
    stream = [w for x in words for w in x]
    of = {w: _hash(w, seed) for w in set(stream)}
    hashes = np.array([of[w] for w in stream], dtype=np.uint64)
    sizes = np.array([len(x) for x in words], dtype=np.int64)
    block = np.repeat(np.arange(len(words)), sizes)
    keys, starts, lengths = [], [], []
    for size in (RUN, LONG):
        inside = np.flatnonzero(block[: len(block) - size + 1] == block[size - 1 :]) if len(block) >= size else block[:0]
        if len(inside):
            keys.append(_prefixes(hashes, size)[inside])
            starts.append(inside)
            lengths.append(np.full(len(inside), size))
    short = np.flatnonzero(sizes < RUN)
    keys.append(np.array([_hash("\n" + " ".join(words[k]), seed) for k in short.tolist()], dtype=np.uint64))
    starts.append((np.cumsum(sizes) - sizes)[short])
    lengths.append(sizes[short])
    return np.concatenate(keys).view(np.int64), np.concatenate(starts), np.concatenate(lengths)


def _marked(page: list[Block]) -> int:
    return max((b.article for b in page if not b.boilerplate), default=0)


def _outside(page: list[Block]) -> list[Block]:
    """Blocks whose text enters the streams: main's text is in them around articles only."""
    least = ARTICLE if _marked(page) == ARTICLE else MAIN
    return [b for b in page if b.article < least]


def main_text(page: list[Block], covered: np.ndarray) -> tuple[str, int]:
    """Text that stays, and the number of tokens outside articles that repeated runs cover."""
    marked = _marked(page)
    outside = {id(b) for b in _outside(page)}
    words = [b.text.split(" ") for b in page]
    left, at = [], 0
    for block, own in zip(page, words, strict=True):
        if id(block) in outside:
            gone = covered[at : at + len(own)].tolist()
            at += len(own)
            left.append([w for w, g in zip(own, gone, strict=True) if not g])
        else:
            left.append(own)
    if marked == ARTICLE:
        text = [(b.article, len(own), len(x)) for b, own, x in zip(page, words, left, strict=True) if not b.boilerplate]
        around = sum(n for article, size, n in text if article == MAIN and size >= RUN)
        if around > sum(n for article, _, n in text if article == ARTICLE):
            marked = MAIN
    kept = [" ".join(x) for b, x in zip(page, left, strict=True) if x and not b.boilerplate and b.article >= marked]
    return " ".join(kept), int(covered.sum())


def _covered(page: list[Block], starts: np.ndarray, lengths: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    depth = np.zeros(sum(b.text.count(" ") + 1 for b in _outside(page)) + 1, dtype=np.int64)
    np.add.at(depth, starts[repeated], 1)
    np.add.at(depth, (starts + lengths)[repeated], -1)
    return np.cumsum(depth)[:-1] > 0


def _entries(batch: pa.RecordBatch) -> Iterator[tuple[int, list[Block], np.ndarray, np.ndarray, np.ndarray]]:
    for row, (site, html) in enumerate(zip(batch["site"].to_pylist(), batch["html"].to_pylist(), strict=True)):
        page = list(blocks(html))
        yield row, page, *suffixes(site, [b.text.split(" ") for b in _outside(page)])


def _signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def repeated_prefixes(pages: DataFrame) -> DataFrame:
    """``pages`` (site, html) -> key: prefixes of boilerplate runs."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for site, html in zip(batch["site"].to_pylist(), batch["html"].to_pylist(), strict=True):
                page = list(blocks(html))
                text, outside = "\n".join(b.text for b in page), "\n".join(b.text for b in _outside(page))
                digest = _signed(_hash(f"{text}\n\n{outside}", 2))
                out.append((site, digest, _signed(_hash(title(html) or text, 1)), outside))
            if out:
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
                arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["site", "digest", "name", "outside"])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = (batch[c].to_pylist() for c in ("site", "name", "outside"))
            for site, name, outside in zip(*columns, strict=True):
                own, _, lengths = suffixes(site, [x.split(" ") for x in outside.split("\n")] if outside else [])
                own, first = np.unique(own, return_index=True)
                of = _signed(_hash(site, 3))
                # The host's own entry counts its pages.
                keys = np.append(own, of)
                kind = np.append((lengths[first] == LONG).astype(np.int64), HOST)
                out.append((keys, np.full(len(keys), of), np.full(len(keys), name), kind))
            if out:
                arrays = [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["key", "of", "name", "kind"])

    rows = pages.mapInArrow(parsed, "site string, digest long, name long, outside string")
    distinct = rows.groupBy("site", "digest").agg(F.min("name").alias("name"), F.min("outside").alias("outside"))
    found = distinct.select("site", "name", "outside").mapInArrow(made, "key long, of long, name long, kind long")
    counted = found.groupBy("key", "of", "kind").agg(
        F.count("*").alias("n"), F.min("name").alias("least"), F.max("name").alias("most")
    )
    stored = materialize(counted.where((F.col("n") > 1) | (F.col("kind") == HOST)), "counted-prefixes")
    hosts = stored.where(F.col("kind") == HOST).select(F.col("of").alias("host"), F.col("n").alias("total"))
    need = F.greatest(F.lit(SHARE) * F.col("total"), F.least(F.lit(LEAST), F.col("total")))
    short = stored.where("kind = 0").join(hosts, F.col("of") == F.col("host")).where(F.col("n") >= need)
    return short.select("key").union(stored.where("kind = 1 and least <> most").select("key"))


TEXT = "text string, n_chars long, n_repeated long"
TEXT_KINDS = (pa.string(), pa.int64(), pa.int64())


def _cleaned(pages: DataFrame, repeated: DataFrame) -> DataFrame:
    """Pages cleaned in one pass with the repeated prefixes at hand."""
    keys = np.sort(repeated.toArrow()["key"].to_numpy())
    shared = pages.sparkSession.sparkContext.broadcast(keys)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            out = []
            for _, page, own, starts, lengths in _entries(batch):
                at = np.searchsorted(known, own)
                hit = known[np.minimum(at, len(known) - 1)] == own if len(known) else np.zeros(len(own), dtype=bool)
                text, n = main_text(page, _covered(page, starts, lengths, hit))
                out.append((text, len(text), n))
            texts = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), TEXT_KINDS, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], *texts], names=["page_id", "url", "text", "n_chars", "n_repeated"]
            )

    return pages.select("page_id", "url", "site", "html").mapInArrow(made, f"page_id long, url string, {TEXT}")


def _cleaned_by_join(pages: DataFrame, repeated: DataFrame) -> DataFrame:
    """The same with a shuffle: suffixes meet the repeated prefixes, and their hits the pages."""
    rows = materialize(pages.withColumn("row", F.monotonically_increasing_id()), "numbered-pages")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["row"].to_pylist()
            found = [(np.full(len(own), ids[r]), np.arange(len(own)), own) for r, _, own, _, _ in _entries(batch)]
            if found:
                arrays = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=["row", "at", "key"])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r, page, own, starts, lengths in _entries(batch):
                hit = np.zeros(len(own), dtype=bool)
                hit[batch["hits"][r].as_py() or []] = True
                text, n = main_text(page, _covered(page, starts, lengths, hit))
                out.append((text, len(text), n))
            texts = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), TEXT_KINDS, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], *texts], names=["page_id", "url", "text", "n_chars", "n_repeated"]
            )

    hits = rows.select("row", "site", "html").mapInArrow(places, "row long, at long, key long").join(repeated, "key")
    of_row = hits.groupBy(F.col("row").alias("of")).agg(F.collect_list("at").alias("hits"))  # at most a page's tokens
    joined = rows.join(of_row, F.col("row") == F.col("of"), "left").select("page_id", "url", "site", "html", "hits")
    return joined.mapInArrow(made, f"page_id long, url string, {TEXT}")


def main_texts(pages: DataFrame, held: int = HELD) -> DataFrame:
    """page_id, url, text, n_chars and n_repeated of every page."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url"),
        F.coalesce(host("url"), F.lit("")).alias("site"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    repeated = materialize(repeated_prefixes(rows.select("site", "html")), "repeated-prefixes")
    way = _cleaned if repeated.count() <= held else _cleaned_by_join
    return way(rows, repeated)
