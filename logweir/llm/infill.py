"""Fill-in-the-middle: a text's lines are cut into prefix, middle and suffix and reordered.

The units are lines, each with its line feed; the rest behind the last line feed is a line too.
Two draws from a digest of the document id say how many lines the prefix and the prefix with
the middle hold, two more whether a text stays plain and which of the two orders it takes, so a
run that is repeated, on any machine, gives the same rows.

Texts are never split into lists of lines. The bytes of many texts are viewed as 64-bit words
(eight bytes a word): arithmetic on whole words marks the bytes that end a unit, a bit count a
word and its running sum give the ends before each word, a search in the sums finds the word
that holds a wanted end, and byte sums by one multiplication select it in the word. Code points
are counted alike, by marking the bytes that continue one.

No shuffle and no state between rows: every row is a narrow map, so a hot source or a lost
executor costs nothing extra. A task holds PIECE bytes of text, or one longer text, at once.

Defined results: a null or empty text is plain and empty, with no lines; a null id draws as an
empty text; rows with one id draw alike, each on its own text; bytes that are not UTF-8 are
kept, and every byte that does not continue a code point counts as one; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import flat_bytes, pieces, utf8

PIECE = 4 << 20
PLAIN, PREFIX_FIRST, SUFFIX_FIRST = "plain", "psm", "spm"


@dataclass(frozen=True)
class Infill:
    """``percent`` of the texts are cut, ``suffix_first`` percent of those begin with the suffix."""

    seed: int = 7
    percent: int = 100
    suffix_first: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        marks = (self.prefix, self.suffix, self.middle)
        # A mark that ends as another begins could be found astride a border.
        astride = any(a[-k:] == b[:k] for a in marks for b in marks for k in range(1, min(len(a), len(b))))
        if len(set(marks)) < 3 or "" in marks or astride or any(a != b and a in b for a in marks for b in marks):
            raise ValueError("marks must be three texts that cannot overlap each other")


EVERY, FIRST, LOW = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080), np.uint64(0x7F7F7F7F7F7F7F7F)
LINE_FEEDS = np.uint64(0x0A0A0A0A0A0A0A0A)


def words_of(data: np.ndarray) -> np.ndarray:
    """The bytes as little-endian words, with one more word at least than they fill."""
    padded = np.zeros((len(data) // 8 + 1) * 8, np.uint8)
    padded[: len(data)] = data
    return padded.view("<u8")


def line_feeds(words: np.ndarray) -> np.ndarray:
    """The top bit of each byte that is a line feed."""
    other = words ^ LINE_FEEDS
    return ~((other & LOW) + LOW | other | LOW)


def continued(words: np.ndarray) -> np.ndarray:
    """The top bit of each byte that continues a code point (10xxxxxx)."""
    return words & ~(words << np.uint64(1)) & FIRST


class Marks:
    """Rank and select over bytes marked by their top bits."""

    def __init__(self, marked: np.ndarray):
        self.marked = marked
        self.before = np.zeros(len(marked) + 1, np.int64)
        np.cumsum(np.bitwise_count(marked), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Marked bytes before each position."""
        word, bits = at >> 3, ((at & 7) << 3).astype(np.uint64)
        lower = self.marked[word] & ((np.uint64(1) << bits) - np.uint64(1))
        return self.before[word] + np.bitwise_count(lower)

    def after(self, k: np.ndarray) -> np.ndarray:
        """The position behind the k-th marked byte, counted from 1."""
        word = np.searchsorted(self.before, k, side="left") - 1
        within = (k - self.before[word]).astype(np.uint64)
        # Byte i of the product holds the marked bytes of the word up to i: 8 at most.
        sums = (self.marked[word] >> np.uint64(7)) * EVERY
        reached = ((sums | FIRST) - within * EVERY) & FIRST
        return word * 8 + 9 - np.bitwise_count(reached).astype(np.int64)


def cuts(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, ...]:
    """(lines, first cut, second cut, code points of prefix, of middle) of each text.

    ``draws`` has two numbers a text; cuts are byte positions in ``data``.
    """
    words = words_of(data)
    starts, ends = offsets[:-1], offsets[1:]
    marked = line_feeds(words)
    last = ends[ends > starts] - 1
    np.bitwise_or.at(marked, last >> 3, np.uint64(0x80) << ((last & 7) << 3).astype(np.uint64))
    units = Marks(marked)
    first = units.rank(starts)
    lines = units.rank(ends) - first
    wanted = np.sort(draws % (lines + 1)[:, None], axis=1)
    places = []
    for k in wanted.T:
        at = starts.copy()
        some = np.flatnonzero(k)
        at[some] = units.after(first[some] + k[some])
        places.append(at)
    points = Marks(continued(words))
    begun = [at - points.rank(at) for at in (starts, *places)]
    return lines, places[0], places[1], begun[1] - begun[0], begun[2] - begun[1]


def transform(docs: DataFrame, how: Infill = Infill()) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars, output of every document."""
    marks = [m.encode() for m in (how.prefix, how.suffix, how.middle)]
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "body", PIECE):
            data, offsets = flat_bytes(batch["body"])
            draws = np.stack([batch[f"h{k}"].to_numpy() for k in (1, 2)], axis=1)
            lines, first, second, prefixed, amid = cuts(data, offsets, draws)
            stays, turned = batch["stays"].to_pylist(), batch["turned"].to_pylist()
            text = data.tobytes()
            forms, out = [], []
            for i, (start, a, b, end) in enumerate(zip(offsets, first, second, offsets[1:], strict=False)):
                body = text[start:end]
                if stays[i] or not body or any(m in body for m in marks):
                    forms.append(PLAIN)
                    out.append(body)
                    continue
                parts = (marks[0], text[start:a]), (marks[1], text[b:end])
                forms.append(SUFFIX_FIRST if turned[i] else PREFIX_FIRST)
                ordered = parts[::-1] if turned[i] else parts
                out.append(b"".join((*ordered[0], *ordered[1], marks[2], text[a:b])))
            plain = np.array([f == PLAIN for f in forms])
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "n": pa.array(lines),
                    "form": pa.array(forms, pa.string()),
                    "prefix_chars": pa.array(prefixed, mask=plain),
                    "middle_chars": pa.array(amid, mask=plain),
                    "output": pa.array(out, pa.binary()),
                }
            )

    doc_id = F.col("doc_id").cast("long")
    digest = F.sha2(F.concat(F.lit(f"{how.seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    drawn = docs.select(doc_id.alias("doc_id"), utf8("text").alias("body"), digest.alias("digest"))

    def draw(k: int) -> Column:
        return F.conv(F.substring("digest", 8 * k - 7, 8), 16, 10).cast("long")

    rows = drawn.select(
        "doc_id",
        "body",
        draw(1).alias("h1"),
        draw(2).alias("h2"),
        (draw(3) % 100 >= how.percent).alias("stays"),
        (draw(4) % 100 < how.suffix_first).alias("turned"),
    )
    made = rows.mapInArrow(cut, schema)
    return made.withColumn("output", F.col("output").cast("string"))


def restored(output: str, form: str, how: Infill = Infill()) -> Column:
    """The text that an output of ``transform`` was made from, by its form."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        """What stands behind the marks ``first``, ``second`` and that of the middle."""
        whole = F.expr(f"substring({output}, {len(first) + 1})")
        one = F.substring_index(whole, second, 1)
        rest = F.substr(whole, F.char_length(one) + F.lit(len(second) + 1))
        two = F.substring_index(rest, how.middle, 1)
        return one, two, F.substr(rest, F.char_length(two) + F.lit(len(how.middle) + 1))

    prefix, suffix, middle = parts(how.prefix, how.suffix)
    late_suffix, late_prefix, late_middle = parts(how.suffix, how.prefix)
    return (
        F.when(F.col(form) == PREFIX_FIRST, F.concat(prefix, middle, suffix))
        .when(F.col(form) == SUFFIX_FIRST, F.concat(late_prefix, late_middle, late_suffix))
        .otherwise(F.col(output))
    )


def digests(docs: DataFrame, how: Infill = Infill()) -> DataFrame:
    """The transformation with digests of each output and of the text rebuilt from it."""
    made = transform(docs, how)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored("output", "form", how).cast("binary"), 256).alias("restored_sha256"),
    )


#: The same rows by lists of lines.
SQL = r"""
with texts as (
  select doc_id, coalesce(text, '') as body, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as digest
  from documents
),
drawn as (
  select *, regexp_extract_all(body, '[^\n]*\n|[^\n]+') as units,
    [cast('0x' || substr(digest, 8 * k - 7, 8) as bigint) for k in [1, 2, 3, 4]] as h
  from texts
),
cut as (
  select *, len(units) as n,
    least(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) as a,
    greatest(h[1] % (len(units) + 1), h[2] % (len(units) + 1)) as b
  from drawn
),
parts as (
  select doc_id, body, n,
    case when body = '' or contains(body, '<P>') or contains(body, '<S>') or contains(body, '<M>')
      or h[3] % 100 >= 100 then 'plain' when h[4] % 100 < 50 then 'spm' else 'psm' end as form,
    array_to_string(units[1:a], '') as prefix,
    array_to_string(units[a + 1:b], '') as middle,
    array_to_string(units[b + 1:n], '') as suffix
  from cut
)
select doc_id, cast(n as bigint) as n, form,
  case when form <> 'plain' then cast(length(prefix) as bigint) end as prefix_chars,
  case when form <> 'plain' then cast(length(middle) as bigint) end as middle_chars,
  sha256(case form when 'plain' then body
    when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
  sha256(body) as restored_sha256
from parts
"""
