"""Token ids as length-delimited binary records, with a separate offset index.

A shard is a file of records in ascending document order. A record is

    length of the body         unsigned 64 bits
    masked checksum of length  unsigned 32 bits
    body                       document id (signed 64), flags (8), tokens (unsigned 32), ids (16 or 32)
    masked checksum of body    unsigned 32 bits
    line feed

all little-endian. Flag 1: the document id is null; flag 2: ids have 32 bits, else 16. The
checksum is CRC-32, masked as in other framed formats, since a checksum of bytes that hold
their own checksum is weak. The line feed lets Spark's text writer write shards: it goes to
any store Spark reaches, and a lost executor's files never become visible.

The index is a Parquet table (shard, position, offset, bytes, doc_id, tokens, ids_crc32) made
from the written shards; with it a reader fetches any record by one ranged read.

Defined results: a null text has only the end id; rows with one id are in the order of a digest
of their texts; a null id comes first; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweir.llm.common import materialize, pieces, utf8, work_folder

END = 0
#: A shard is read whole by one task: it ends at these records, or these bytes and one record.
SHARD_RECORDS, SHARD_BYTES = 4096, 16 << 20
#: Words that stay known to a worker, and bytes of text that it encodes at once.
KNOWN = 400_000
HELD_BYTES = 4 << 20
#: New words that are encoded as one text.
JOINED = 50
FRAME = struct.Struct("<QI")
HEAD = struct.Struct("<qBI")
CHECK = struct.Struct("<I")
NULL_ID, WIDE = 1, 2

#: White space that is not one space, one line feed or two between other characters.
_OTHER = r"\t\f\r\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
ODD_SPACE = f"[{_OTHER}]| [ \\n]|\\n |\\n\\n\\n|^[ \\n]|[ \\n]$"
#: Marks that end a word; behind a letter or digit (of alphabets that every version of Unicode
#: knows) they are a token of their own.
MARKS = ".,!?;:$#%&*"
MARKED = rf"[0-9A-Za-z\x{{c0}}-\x{{d6}}\x{{d8}}-\x{{f6}}\x{{f8}}-\x{{24f}}\x{{410}}-\x{{44f}}\x{{4e00}}-\x{{9fa5}}][{MARKS}]+$"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


class Encoder:
    """Ids of texts by a tokenizers file of the byte-level kind.

    Such a vocabulary never joins a word with the single space or line feed behind it, nor a
    letter with the marks that end its word. So the ids of a text are those of its first word
    and of each word after it with what stands before, and a marked word's are its stem's and
    its marks'. Each distinct word is encoded once and remembered, up to a bound. Texts with
    other white space, or with an added token such as an end mark, are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.wide = max(vocabulary.values()) >= 1 << 16
        self.kind = np.dtype("<u4" if self.wide else "<u2")
        # A character of a byte-level token stands for one byte.
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.whole = "|".join([ODD_SPACE, *map(re.escape, added)])
        # Words are encoded next to each other, which must not make up an added token.
        self.joined = 1 if any(c.isspace() for t in added for c in t) else JOINED
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.starts, self.counts = np.zeros(1, dtype=np.int32), np.zeros(1, dtype=np.int32)
        self.ids = np.zeros(0, dtype=self.kind)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, dtype=self.kind) for f in found]

    def _learn(self, words: list[str]) -> None:
        """Encode words as they stand in a text: behind a space, or from a line feed on."""
        size = self.joined
        groups = [[w if w[:1] == "\n" else " " + w for w in words[i : i + size]] for i in range(0, len(words), size)]
        encoded = self._encode(["".join(g) for g in groups])
        counts = []
        for group, ids in zip(groups, encoded, strict=True):
            ends = np.cumsum([len(w.encode()) for w in group])
            counts.append(np.diff(np.searchsorted(np.cumsum(self.bytes_of[ids]), ends) + 1, prepend=0))
        self._add(words, np.concatenate(encoded), np.concatenate(counts))

    def _add(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        slot, base = len(self.known), len(self.ids)
        self.known.update(zip(words, range(slot, slot + len(words)), strict=True))
        self.starts = np.concatenate([self.starts, (base + np.cumsum(counts) - counts).astype(np.int32)])
        self.counts = np.concatenate([self.counts, counts.astype(np.int32)])
        self.ids = np.concatenate([self.ids, ids])

    def _slots(self, words: pa.Array) -> np.ndarray:
        """(stem, marks) slots of distinct words."""
        marked = pc.match_substring_regex(words, MARKED)
        stems = pc.if_else(marked, pc.utf8_rtrim(words, characters=MARKS), words).dictionary_encode()
        stem, known = stems.dictionary.to_pylist(), self.known
        new = [w for w in stem if w not in known]
        if new:
            self._learn(new)
        slots = np.zeros((len(words), 2), dtype=np.int32)
        slots[:, 0] = np.array([known[w] for w in stem], dtype=np.int32)[stems.indices.to_numpy()]
        at = np.flatnonzero(marked.to_numpy(zero_copy_only=False))
        if len(at):
            full = words.take(pa.array(at)).to_pylist()
            stem_of = stems.indices.to_numpy()[at].tolist()
            # A space before the marks keeps them apart from words; "" holds no ids.
            marks = [" " + w[len(stem[k]) :] for w, k in zip(full, stem_of, strict=True)]
            new = [m for m in dict.fromkeys(marks) if m not in known]
            if new:
                ids = self._encode([m[1:] for m in new])
                self._add(new, np.concatenate(ids), np.array([len(x) for x in ids]))
            slots[at, 1] = [known[m] for m in marks]
        return slots

    def _clean(self, texts: pa.Array) -> list[np.ndarray]:
        if len(self.known) > KNOWN:
            self._forget()
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        first = split.offsets.to_numpy()[:-1] - split.offsets[0].as_py()
        coded = split.flatten().dictionary_encode()
        code = coded.indices.to_numpy()
        slots = self._slots(coded.dictionary)
        # First words have nothing before them.
        heads = self._encode(coded.dictionary.take(pa.array(code[first])).to_pylist())
        counts = self.counts[slots][code]
        starts = self.starts[slots][code]
        head_counts = np.array([len(h) for h in heads], dtype=np.int32)
        starts[first, 0], counts[first, 0] = len(self.ids) + np.cumsum(head_counts) - head_counts, head_counts
        counts[first, 1] = 0
        ends = np.cumsum(counts.sum(axis=1), dtype=np.int64)
        flat = counts.ravel()
        shift = (starts.ravel() - (np.cumsum(flat, dtype=np.int64) - flat)).astype(np.int32)
        at = np.arange(ends[-1], dtype=np.int32) + np.repeat(shift, flat)
        ids = np.concatenate([self.ids, *heads])[at]
        return np.split(ids, ends[first[1:] - 1])

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        odd = pc.match_substring_regex(texts, self.whole)
        out: list[np.ndarray] = [None] * len(texts)
        for part, encode in ((pc.invert(odd), self._clean), (odd, lambda x: self._encode(x.to_pylist()))):
            at = np.flatnonzero(part.to_numpy(zero_copy_only=False))
            if len(at):
                for i, ids in zip(at.tolist(), encode(texts.filter(part)), strict=True):
                    out[i] = ids
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def frame(doc_id: int | None, ids: bytes, wide: bool) -> bytes:
    flags = NULL_ID * (doc_id is None) | WIDE * wide
    body = HEAD.pack(doc_id or 0, flags, len(ids) // (4 if wide else 2)) + ids
    length = struct.pack("<Q", len(body))
    return b"".join((length, CHECK.pack(masked(length)), body, CHECK.pack(masked(body)), b"\n"))


def records(content: bytes) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """(offset, bytes, document id, ids) of each record of a shard; checks the checksums."""
    at, view = 0, memoryview(content)
    while at < len(content):
        size, check = FRAME.unpack_from(content, at)
        if check != masked(view[at : at + 8]):
            raise ValueError(f"length at byte {at} is damaged")
        body = view[at + FRAME.size : at + FRAME.size + size]
        end = at + FRAME.size + size + CHECK.size + 1
        if end > len(content) or CHECK.unpack_from(content, end - 5)[0] != masked(body):
            raise ValueError(f"record at byte {at} is damaged")
        doc_id, flags, n = HEAD.unpack_from(body)
        ids = np.frombuffer(body, dtype="<u4" if flags & WIDE else "<u2", offset=HEAD.size)
        if len(ids) != n:
            raise ValueError(f"record at byte {at} has {len(ids)} ids, not {n}")
        yield at, end - at, None if flags & NULL_ID else doc_id, ids
        at = end


def _strings(body: pa.Array) -> pa.Array:
    if isinstance(body, pa.ChunkedArray):
        body = body.combine_chunks()
    try:
        return body.cast(pa.string())
    except pa.ArrowInvalid:  # bytes that are not UTF-8
        return pa.array([b.decode("utf-8", "replace") for b in body.to_pylist()], pa.string())


def write_shards(
    docs: DataFrame, path: str, tokenizer: str, shard_records: int = SHARD_RECORDS, shard_bytes: int = SHARD_BYTES
) -> None:
    """Write the documents' ids in ascending order of doc_id; a row of the writer is a shard."""

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([END], dtype=encode.kind)

        def row() -> pa.RecordBatch:
            # Without the last line feed, which the writer adds.
            return pa.RecordBatch.from_pydict({"value": pa.array([b"".join(shard)[:-1]], pa.binary())})

        def flush() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            texts = _strings(rows["body"].combine_chunks())
            nonlocal size
            for d, ids in zip(rows["doc_id"].to_pylist(), encode(texts), strict=True):
                shard.append(frame(d, ids.tobytes() + end.tobytes(), encode.wide))
                size += len(shard[-1])
                if len(shard) >= shard_records or size >= shard_bytes:
                    yield row()
                    shard.clear()
                    size = 0

        held: list[pa.RecordBatch] = []
        shard: list[bytes] = []
        size = 0
        for batch in pieces(batches, "body", HELD_BYTES):
            held.append(batch)
            if sum(b.nbytes for b in held) >= HELD_BYTES:
                yield from flush()
                held = []
        if held:
            yield from flush()
        if shard:
            yield row()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("body"))
    # The digest splits the range of an id that very many rows have.
    keyed = rows.withColumn("digest", F.xxhash64("body"))
    ordered = keyed.repartitionByRange("doc_id", "digest").sortWithinPartitions("doc_id", "digest", "body").drop("digest")
    (
        ordered.mapInArrow(framed, "value binary")
        .select(F.col("value").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", 1)
        .text(path)
    )


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record of the shards, in any order: its place, and what its ids sum to."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                found, before = [], 0
                for k, (offset, size, doc_id, ids) in enumerate(records(content.as_py())):
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    found.append((shard, k, offset, size, doc_id, before, len(ids), crc))
                    before += len(ids)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds, strict=True)], names=names
                    )

    names = ["shard", "position", "offset", "bytes", "doc_id", "before", "n_tokens", "ids_crc32"]
    kinds = [pa.string(), *[pa.int64()] * 7]
    schema = "shard string, position long, offset long, bytes long, doc_id long, before long, n_tokens long, ids_crc32 long"
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "content").mapInArrow(parsed, schema)


def write_records(docs: DataFrame, path: str, tokenizer: str, shard_records: int = SHARD_RECORDS) -> DataFrame:
    """Write shards and index under ``path``; return the index with each record's ``start``."""
    spark = docs.sparkSession
    write_shards(docs, f"{path}/shards", tokenizer, shard_records)
    read_shards(spark, f"{path}/shards").write.parquet(f"{path}/index")
    index = spark.read.parquet(f"{path}/index")
    # One row a shard. Names rise with the ranges, so they order shards that share an id.
    shards = index.groupBy("shard").agg(
        F.sum("n_tokens").alias("tokens"),
        F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id", "shard")).alias("first"),
    )
    earlier = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select("shard", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("earlier"))
    starts = index.join(materialize(offsets, "shard-offsets"), "shard")
    return starts.select(
        "doc_id",
        (F.col("earlier") + F.col("before")).alias("start"),
        "n_tokens",
        "ids_crc32",
        "shard",
        "position",
        "offset",
        "bytes",
    )


def token_records(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 as read back from files in the shared folder."""
    path = work_folder(docs.sparkSession, "token-records")
    return write_records(docs, path, tokenizer).select("doc_id", "start", "n_tokens", "ids_crc32")
