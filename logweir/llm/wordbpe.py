"""Encoding and decoding by a byte-pair tokenizer that marks word ends, as its library does.

Text goes through the tokenizer's own steps: added tokens are cut out of the text as it stands;
the rest is normalised (composed, white space, lower case) and split into words; every word's
bytes are merged by the ranked rules, its last byte marked as the end.

1. Words are counted over all documents, combined in the tasks and then by word on Spark.
2. Words of at least one in SHARE of all are compiled, with their ids, into a minimal acyclic
   transducer (``transducer``), along with the merge rules. There can be no more than SHARE such
   words, none of more than LONGEST bytes, so driver and file are bounded at every size. The
   file is written to the shared folder by Spark and handed to the executors as one of the
   job's files, where all workers of a machine map it into memory; an executor that comes later
   fetches it too. It must stay until the application ends.
3. A task reads the words of a piece of text, looks all different ones up together and merges
   those that the lexicon does not know by the same rules, exactly. The lexicon saves merges;
   the ids are the same with any lexicon.

Words of letters, digits and marks that every version of Unicode knows are split by one
expression; a text with any other character goes through the library's own normaliser and
splitter. Encoding and decoding shuffle nothing; the count shuffles a row for each different
word of a task, at most HELD at a time, and its hot words are sums of the tasks.

Defined results: a null or empty text has no ids and decodes to the empty text; bytes that are
not UTF-8 are read as U+FFFD; rows with one id are coded each for itself; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from pathlib import PurePosixPath

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.llm import transducer
from logweir.llm.common import flat_bytes, pieces, utf8, work_folder

PIECE = 2 << 20
SHARE = 400_000
LONGEST = 64
#: Different words a task holds while it counts, and ids of a piece that is decoded.
HELD = 400_000
DECODED = 1 << 20

# Letters whose class, lower case and composed form every version of Unicode agrees on: Latin
# (but for the letters whose lower case is longer or odd), Cyrillic, Han.
LETTERS = (
    "A-Za-zªµºÀ-ÖØ-öø-įı-ňŊ-ž"
    "А-я一-龥"
)
MARKS = "!-/:-@\\[-`{-~¡-©«¬®-±´¶-¸»¿×÷"
UNUSUAL = re.compile(f"[^\t-\r 0-9{LETTERS}{MARKS}]")
# The tokenizer's word expression.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[{MARKS}]+")
#: Before an added token in a list of words: no word holds a space.
ADDED = " "


def byte_symbols() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, others for U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Rules:
    """A tokenizers file: how it splits texts, its merge rules and its tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        odd = [t for t in spec["added_tokens"] if t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"]]
        kinds = ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")
        if model["type"] != "BPE" or odd or any(model.get(k) for k in kinds):
            raise ValueError(f"{path}: only plain byte-pair merges and added tokens are supported")
        if spec["decoder"] is not None or spec["truncation"] or spec["padding"]:
            raise ValueError(f"{path}: decoders, truncation and padding are not supported")
        steps = spec["pre_tokenizer"]["pretokenizers"]
        if steps[0]["pattern"] != {"Regex": SPLIT} or steps[0]["behavior"] != "Removed" or not steps[0]["invert"]:
            raise ValueError(f"{path}: the words are split in another way")
        self.vocabulary: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.bytes_of = byte_symbols()
        end = model["end_of_word_suffix"] or ""
        names = {b: c for c, b in self.bytes_of.items()}
        self.inner = np.array([self.vocabulary[names[b]] for b in range(256)], np.int32)
        self.final = np.array([self.vocabulary[names[b] + end] for b in range(256)], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = np.array(
            [(self.vocabulary[a], self.vocabulary[b], self.vocabulary[a + b]) for a, b in pairs], np.int64
        ).reshape(-1, 3)
        self.symbols = max(self.vocabulary.values()) + 1
        tokens = {i: t for t, i in self.vocabulary.items()} | {i: t for t, i in self.added.items()}
        self.tokens = pa.array([tokens.get(i) for i in range(max(tokens) + 1)], pa.string())

    def _plain(self, text: str) -> list[str]:
        if UNUSUAL.search(text) is None:
            return WORDS.findall(text.lower())
        whole = self.tokenizer.normalizer.normalize_str(text)
        names = (name for name, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(whole))
        return [bytes(map(self.bytes_of.__getitem__, name)).decode() for name in names]

    def words(self, text: str) -> list[str]:
        """The words of a text and, behind a space, its added tokens."""
        if self.cut is None or "<" not in text and all("<" in t for t in self.added):
            return self._plain(text)
        parts = self.cut.split(text)
        out = self._plain(parts[0])
        for token, part in zip(parts[1::2], parts[2::2], strict=True):
            out.append(ADDED + token)
            out += self._plain(part)
        return out


_rules: dict[str, Rules] = {}


def rules(path: str) -> Rules:
    """One for each worker process."""
    if path not in _rules:
        _rules[path] = Rules(path)
    return _rules[path]


def texts_of(batch: pa.RecordBatch) -> list[str]:
    return [b.decode("utf-8", "replace") for b in batch["body"].to_pylist()]


def word_counts(docs: DataFrame, tokenizer: str) -> DataFrame:
    """word (bytes of the normalised text) and its number n over all documents."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = rules(tokenizer)
        held: list[pa.Table] = []

        def summed() -> pa.Table:
            return pa.concat_tables(held).group_by("word").aggregate([("n", "sum")]).rename_columns(["word", "n"])

        for batch in pieces(batches, "body", PIECE):
            words = [w for text in texts_of(batch) for w in rule.words(text) if w[0] != ADDED]
            counts = pa.array(words, pa.string()).value_counts()
            held.append(pa.table({"word": counts.field("values"), "n": counts.field("counts")}))
            if sum(map(len, held)) > HELD:
                held = [summed()]
                if len(held[0]) > HELD // 2:
                    yield from held[0].to_batches()
                    held = []
        if held:
            yield from summed().to_batches()

    rows = docs.select(utf8("text").alias("body"))
    parts = rows.mapInArrow(counted, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, share: int = SHARE, longest: int = LONGEST) -> list[bytes]:
    """Words that make up one in ``share`` of all words, sorted; ``share`` words at most."""
    stored = counts.persist()
    try:
        total = stored.agg(F.sum("n")).first()[0] or 0
        word = F.col("word").cast("binary")
        often = (F.col("n") * share >= total) & (F.length(word) <= longest)
        return sorted(bytes(r[0]) for r in stored.filter(often).select(word).collect())
    finally:
        stored.unpersist()


class Coder:
    """Ids of words by a mapped lexicon, other words by the merge rules."""

    def __init__(self, rule: Rules, path: str):
        self.rule, self.lexicon = rule, transducer.Lexicon(path)

    def _symbols(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        symbols = self.rule.inner[data]
        symbols[ends - 1] = self.rule.final[data[ends - 1]]
        return symbols

    def _merged(self, data: np.ndarray, offsets: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each) of the words ``which``, in their order."""
        starts, sizes = offsets[which], offsets[which + 1] - offsets[which]
        made: list[np.ndarray] = []
        order: list[np.ndarray] = []
        counts = np.zeros(len(which), np.int64)
        low = 0
        for high in (4, 8, 12, 16, 24, 32, transducer.Lexicon.TOGETHER):
            at = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            if not len(at):
                continue
            place = transducer.ranges(starts[at], sizes[at])
            symbols = np.full((len(at), high), -1, np.int32)
            filled = np.arange(high) < sizes[at][:, None]
            symbols[filled] = self._symbols(data[place], np.cumsum(sizes[at]))
            merged = self.lexicon.merge(symbols)
            kept = merged >= 0
            counts[at] = kept.sum(axis=1)
            made.append(merged[kept])
            order.append(np.repeat(at, counts[at]))
        for i in np.flatnonzero(sizes > low).tolist():
            word = data[starts[i] : starts[i] + sizes[i]]
            merged = self.lexicon.merge_long(self._symbols(word, np.array([len(word)])))
            counts[i] = len(merged)
            made.append(merged)
            order.append(np.full(len(merged), i))
        ids = np.concatenate(made) if made else np.zeros(0, np.int32)
        if made:
            ids = ids[np.argsort(np.concatenate(order), kind="stable")]
        return ids, counts

    def distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each word) of different words."""
        data, offsets = flat_bytes(words)
        found, ids, counts = self.lexicon.find(data, offsets)
        added = np.zeros(len(words), bool)
        if len(words):
            added[data[offsets[:-1]] == ord(ADDED)] = True
        rest = np.flatnonzero(~found & ~added)
        merged, merged_counts = self._merged(data, offsets, rest)
        extra = np.flatnonzero(added)
        tokens = np.array([self.rule.added[words[i].as_py()[1:]] for i in extra.tolist()], np.int32)
        all_ids = np.concatenate([ids, merged, tokens])
        starts = np.zeros(len(words), np.int64)
        sizes = counts.copy()
        starts[found] = (np.cumsum(counts) - counts)[found]
        starts[rest], sizes[rest] = len(ids) + np.cumsum(merged_counts) - merged_counts, merged_counts
        starts[extra], sizes[extra] = len(ids) + len(merged) + np.arange(len(extra)), 1
        return all_ids[transducer.ranges(starts, sizes)].astype(np.int32), sizes

    def __call__(self, texts: list[str]) -> pa.Array:
        """A list of ids for each text."""
        words = [self.rule.words(t) for t in texts]
        flat = pa.array([w for ws in words for w in ws], pa.string()).dictionary_encode()
        ids, sizes = self.distinct(flat.dictionary)
        starts = np.cumsum(sizes) - sizes
        code = flat.indices.to_numpy()
        each = sizes[code]
        # Ids before each word, and before each text.
        before = np.concatenate([[0], np.cumsum(each)])
        bounds = before[np.concatenate([[0], np.cumsum([len(ws) for ws in words], dtype=np.int64)])]
        return pa.ListArray.from_arrays(
            pa.array(bounds.astype(np.int32)), pa.array(ids[transducer.ranges(starts[code], each)])
        )


def write_lexicon(spark: SparkSession, words: list[bytes], tokenizer: str) -> str:
    """Compile the words, let Spark write the file to the shared folder; returns its place."""
    rule = rules(tokenizer)
    merger = _merger(rule)
    coded = [(w, tuple(merger(w))) for w in words]
    content = transducer.compiled(coded, rule.merges, rule.symbols)
    folder = work_folder(spark, "lexicon")
    frame = spark.createDataFrame([(content,)], "value binary").coalesce(1)
    frame.select(F.col("value").cast("string").alias("value")).write.text(folder)
    return spark.read.format("binaryFile").load(folder).filter("length > 1").select("path").first()[0]


def _merger(rule: Rules):
    """Ids of one word by the merge rules alone, for the words of a lexicon."""
    ranks = {(a, b): (r, c) for r, (a, b, c) in enumerate(rule.merges.tolist())}

    def merged(word: bytes) -> list[int]:
        ids = [*rule.inner[np.frombuffer(word[:-1], np.uint8)].tolist(), int(rule.final[word[-1]])]
        while len(ids) > 1:
            found = [ranks[p] + (i,) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in ranks]
            if not found:
                break
            _, new, at = min(found, key=lambda x: (x[0], x[2]))
            ids[at : at + 2] = [new]
        return ids

    return merged


_coders: dict[tuple[str, str], Coder] = {}


def coder(tokenizer: str, name: str) -> Coder:
    """One for each worker process; that of an earlier job goes."""
    if (tokenizer, name) not in _coders:
        _coders.clear()
        _coders[tokenizer, name] = Coder(rules(tokenizer), SparkFiles.get(name))
    return _coders[tokenizer, name]


def encode(docs: DataFrame, tokenizer: str, share: int = SHARE) -> DataFrame:
    """doc_id and ids (array<int>) of every document."""
    spark = docs.sparkSession
    path = write_lexicon(spark, frequent(word_counts(docs, tokenizer), share), tokenizer)
    spark.sparkContext.addFile(path)
    name = PurePosixPath(path).name

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(tokenizer, name)
        for batch in pieces(batches, "body", PIECE):
            yield pa.RecordBatch.from_arrays([batch["doc_id"], code(texts_of(batch))], names=["doc_id", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("body"))
    return rows.mapInArrow(encoded, "doc_id long, ids array<int>")


def decode(rows: DataFrame, tokenizer: str) -> DataFrame:
    """The rows (doc_id, ids) with their decoded text: the tokens, special ones too, joined by
    one space; numbers that are no token's are left out."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = rules(tokenizer).tokens
        for batch in batches:
            ends = np.cumsum(pc.list_value_length(batch["ids"]).fill_null(0).to_numpy())
            start = 0
            while start < len(ends):
                before = int(ends[start - 1]) if start else 0
                stop = max(int(np.searchsorted(ends, before + DECODED, side="right")), start + 1)
                part = batch.slice(start, stop - start)
                ids = part["ids"]
                flat = ids.flatten()
                known = pc.if_else(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(tokens))), flat, None)
                names = tokens.take(known)
                valid = np.concatenate([[0], np.cumsum(pc.is_valid(names).to_numpy(zero_copy_only=False))])
                places = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).fill_null(0).to_numpy())])
                lists = pa.ListArray.from_arrays(pa.array(valid[places].astype(np.int32)), names.drop_null())
                text = pc.binary_join(lists, " ")
                yield pa.RecordBatch.from_arrays([part["doc_id"], ids, text], names=["doc_id", "ids", "decoded"])
                start = stop

    return rows.select("doc_id", "ids").mapInArrow(decoded, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, tokenizer: str, share: int = SHARE) -> DataFrame:
    """A row for each document: the number of its ids, digests of them and of their decoding."""

    def sha(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    rows = decode(encode(docs, tokenizer, share), tokenizer)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sha(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        sha(F.col("decoded")).alias("decoded_sha256"),
    )
