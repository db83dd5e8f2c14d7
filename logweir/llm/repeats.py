"""Substring dedup: maximal repeats from a suffix array in parts, and the bytes they cover.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a
smaller id. Texts are UTF-8 bytes; matches never cross documents.

Where suffixes are taken. Every window of ``LENGTH`` bytes has an anchor: among the strings of
``ANCHOR`` bytes in it, the one with the least hash, the last of equals. Equal windows have
equal anchors, so two documents share a window only if they share its anchor. The windows of
one anchor follow each other; with their bytes they are the anchor's context.

1. Documents are dealt into groups by a hash of their id and text. Exact copies of a text with
   a smaller id are known from digests and take no further part.
2. Each group sends each of its anchors once, as 40 bits of its hash, to buckets; a bucket
   returns to the groups those that several groups have.
3. For these, and those that several of its own documents have, a group sends contexts, equal
   ones once. In a bucket the contexts of one anchor, read from the anchor on, are an enhanced
   suffix array; a scan with a stack gives its common-prefix intervals, and testing what stands
   to the left splits them into maximal repeat groups with all their places. Every place whose
   document is not the group's first is covered.
4. The covered spans go back to the groups, which remove them.

What one key holds is bounded: an anchor is one row a group, a shared context one row a group.
An anchor that more than ``HOT`` groups share may still have many different contexts; its
windows are then compared one by one under digests of their own, each once a group, which
gives the same spans. Texts are shuffled once, by group, and that exchange is used again.

Defined results: a null text is empty; rows with a null id keep everything and cover nothing;
rows with one id do not cover each other; a text under ``LENGTH`` bytes keeps everything; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.common import materialize, utf8
from logweir.llm.intervals import maximal_repeats

LENGTH = 50
ANCHOR = 24
#: Bytes of text of a group, of a bucket, and of a chunk whose arrays stay in cache.
GROUP_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
PART_BYTES = 16 << 20
CHUNK_BYTES = 1 << 16
HOT = 256
#: Parts into which the rows of one text are dealt to meet its first id.
SALTS = 32

_BYTE = np.random.default_rng(50).integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
LOW = np.uint64((1 << 40) - 1)
CONTEXT = np.dtype([("h", "<u8"), ("doc", "<i8"), ("row", "<u4"), ("lo", "<u4"), ("left", "u1"), ("size", "<u2")])
SPAN = np.dtype([("row", "<u4"), ("start", "<u4"), ("end", "<u4")])
WINDOW = np.dtype([("key", "S16"), ("doc", "<i8"), ("row", "<u4"), ("start", "<u4")])


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def _hashes(text: np.ndarray, size: int) -> np.ndarray:
    """A mixed polynomial hash of the ``size`` bytes from each position."""
    out, have, block, width = None, 0, _BYTE[text], 1
    rest = size
    while rest:
        if rest & 1:
            part = block[have : have + len(text) - size + 1]
            out = part if out is None else out * _power(width) + part
            have += width
        rest >>= 1
        if rest:
            block = block[:-width] * _power(width) + block[width:]
            width *= 2
    out = out ^ (out >> np.uint64(29))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return out


def _last_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the position of the least, the last of equals."""
    value, at, have = values, np.arange(len(values), dtype=np.int32), 1
    while have < width:
        step = min(have, width - have)
        right = value[step:] <= value[:-step]
        at = np.where(right, at[step:], at[:-step])
        value = np.minimum(value[step:], value[:-step])
        have += step
    return at


def anchors(text: bytes, ends: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, ...]:
    """(hash, place, first window, last window) of the anchors of texts laid end to end."""
    data = np.frombuffer(text, dtype=np.uint8)
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none, none, none
    hashes = _hashes(data, anchor)
    at = _last_least(hashes, length - anchor + 1)
    end = np.repeat(ends, np.diff(ends, prepend=0))[: len(at)]
    valid = np.arange(len(at)) + length <= end
    first = valid.copy()
    first[1:] &= ~(valid[:-1] & (at[1:] == at[:-1]) & (end[1:] == end[:-1]))
    last = valid.copy()
    last[:-1] &= ~(valid[1:] & (at[1:] == at[:-1]) & (end[1:] == end[:-1]))
    lo, hi = np.flatnonzero(first), np.flatnonzero(last)
    place = at[lo].astype(np.int64)
    return hashes[place], place, lo, hi


def _chunks(texts: list[bytes]) -> Iterator[tuple[list[int], bytes, np.ndarray]]:
    held, size = [], 0
    for i, text in enumerate(texts):
        if len(text) < 1:
            continue
        held.append(i)
        size += len(text)
        if size >= CHUNK_BYTES:
            yield held, b"".join([texts[k] for k in held]), np.cumsum([len(texts[k]) for k in held])
            held, size = [], 0
    if held:
        yield held, b"".join([texts[k] for k in held]), np.cumsum([len(texts[k]) for k in held])


class Group:
    """The documents of a group in a fixed order, and which of them take part."""

    def __init__(self, docs: pa.Table, copies: set[tuple[int, bytes]]):
        rows = list(zip(docs["doc_id"].to_pylist(), docs["body"].to_pylist(), strict=True))
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        self.ids = [i for i, _ in rows]
        self.texts = [t for _, t in rows]
        self.copy = [bool(copies) and i is not None and (i, hashlib.md5(t).digest()) in copies for i, t in rows]
        self.taking_part = [t if i is not None and not c else b"" for (i, t), c in zip(rows, self.copy, strict=True)]

    def anchors(self, length: int, anchor: int) -> Iterator[tuple]:
        """(rows, their texts end to end, ends, starts, anchors) of each chunk."""
        for held, text, ends in _chunks(self.taking_part):
            yield held, text, ends, ends - np.diff(ends, prepend=0), anchors(text, ends, length, anchor)


def _key(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and 40 bits of a hash."""
    return ((hashes >> np.uint64(40)) % np.uint64(buckets)) << np.uint64(40) | (hashes & LOW)


def _split(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Runs of equal buckets among sorted keys."""
    cuts = np.searchsorted(keys, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(40))
    for b in range(buckets):
        if cuts[b + 1] > cuts[b]:
            yield b, slice(int(cuts[b]), int(cuts[b + 1]))


def _pack40(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _unpack40(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(data, dtype=np.uint8).reshape(-1, 5)
    return out.view("<u8")[:, 0]


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


NOTES = pa.schema([("g", pa.int64()), ("kind", pa.int32()), ("data", pa.binary()), ("more", pa.binary())])
SENT = pa.schema([("bucket", pa.int64()), *NOTES])
SENT_SQL = "bucket long, g long, kind int, data binary, more binary"
NOTES_SQL = "g long, kind int, data binary, more binary"
#: Kinds of rows: ids of copies; shared anchors; contexts; windows; covered spans.
COPIES, SHARED, CONTEXTS, WINDOWS, SPANS = range(5)


def _notes(notes: pa.Table, kind: int) -> list[tuple[bytes, bytes]]:
    mine = notes.filter(pc.equal(notes["kind"], kind))
    return list(zip(mine["data"].to_pylist(), mine["more"].to_pylist(), strict=True))


def _copies(notes: pa.Table) -> set[tuple[int, bytes]]:
    return {(int.from_bytes(d, "big", signed=True), m) for d, m in _notes(notes, COPIES)}


def _send_anchors(length: int, anchor: int, buckets: int):
    def send(docs: pa.Table, notes: pa.Table) -> pa.Table:
        if not len(docs):
            return _table([], SENT)
        g = docs["g"][0].as_py()
        found = [_key(a[0], buckets) for *_, a in Group(docs, _copies(notes)).anchors(length, anchor)]
        keys = np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.uint64)
        return _table([(b, g, SHARED, _pack40(keys[at] & LOW), None) for b, at in _split(keys, buckets)], SENT)

    return send


def _share_anchors(hot: int):
    def share(rows: pa.Table) -> pa.Table:
        """For each group the anchors of the bucket that other groups have too."""
        bucket = np.uint64(rows["bucket"][0].as_py()) << np.uint64(40)
        pieces = [_unpack40(d) for d in rows["data"].to_pylist()]
        keys, piece = np.concatenate(pieces), np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        times = np.repeat(np.diff(np.r_[starts, len(ordered)]), np.diff(np.r_[starts, len(ordered)]))
        shared = times > 1
        order, times = order[shared], times[shared]
        by_piece = np.argsort(piece[order], kind="stable")
        order, times = order[by_piece], times[by_piece]
        cuts = np.searchsorted(piece[order], np.arange(len(pieces) + 1))
        out = []
        for p, g in enumerate(rows["g"].to_pylist()):
            at = slice(cuts[p], cuts[p + 1])
            if cuts[p + 1] > cuts[p]:
                mine = keys[order[at]] | bucket
                out.append((g, SHARED, mine.astype("<u8").tobytes(), (times[at] > hot).astype(np.uint8).tobytes()))
        return _table(out, NOTES)

    return share


def _send_contexts(length: int, anchor: int, buckets: int, wide: bool = False):
    """``wide``: contexts reach as far as any window with the anchor could, and equal ones are all sent."""

    def send(docs: pa.Table, notes: pa.Table) -> pa.Table:
        if not len(docs):
            return _table([], SENT)
        g = docs["g"][0].as_py()
        group = Group(docs, _copies(notes))
        flags = _notes(notes, SHARED)
        shared = np.concatenate([np.frombuffer(d, "<u8") for d, _ in flags]) if flags else np.zeros(0, dtype=np.uint64)
        hot = np.concatenate([np.frombuffer(m, np.uint8) for _, m in flags]) if flags else np.zeros(0, dtype=np.uint8)
        order = np.argsort(shared)
        shared, hot = shared[order], hot[order]
        parts = list(group.anchors(length, anchor))
        # Anchors that several documents of the group itself have.
        keys = [_key(a[0], buckets) for *_, a in parts]
        owner = [np.asarray(held)[np.searchsorted(ends, a[2], side="right")] for held, _, ends, _, a in parts]
        local = np.zeros(0, dtype=np.uint64)
        if parts:
            pairs = np.unique(np.rec.fromarrays([np.concatenate(keys), np.concatenate(owner)], names="k,o"))
            repeated = pairs.k[1:][pairs.k[1:] == pairs.k[:-1]]
            local = np.unique(repeated)
        first: dict[tuple[int, bytes], int] = {}
        windows: dict[bytes, list[tuple[int, int, int]]] = {}
        covered: list[tuple[int, int, int]] = []
        rows: list[tuple] = []
        blobs: list[bytes] = []
        for (_, text, ends, starts, (hashes, place, lo, hi)), key, docs_of in zip(parts, keys, owner, strict=True):
            number = np.searchsorted(ends, lo, side="right")
            base, past = starts[number], hi + length
            if wide:
                lo, past = np.maximum(base, place - (length - anchor)), np.minimum(ends[number], place + length)
            at = np.minimum(np.searchsorted(shared, key), max(len(shared) - 1, 0))
            is_shared = shared[at] == key if len(shared) else np.zeros(len(key), dtype=bool)
            is_hot = is_shared & (hot[at] > 0) if len(shared) else is_shared
            chosen = np.flatnonzero(is_shared | np.isin(key, local))
            for h, p, a, z, zero, row, warm in zip(
                hashes[chosen].tolist(),
                place[chosen].tolist(),
                lo[chosen].tolist(),
                past[chosen].tolist(),
                base[chosen].tolist(),
                docs_of[chosen].tolist(),
                is_hot[chosen].tolist(),
                strict=True,
            ):
                context, begin = text[a:z], a - zero
                # Rows are in order of their ids, so the first has the smallest.
                own = group.ids[row]
                if not wide and first.setdefault((p - a, context), own) < own:
                    covered.append((row, begin, begin + z - a))
                elif warm:
                    for w in range(len(context) - length + 1):
                        same = windows.setdefault(hashlib.md5(context[w : w + length]).digest(), [])
                        if same and same[0][0] < own:
                            covered.append((row, begin + w, begin + w + length))
                        else:
                            same.append((own, row, begin + w))
                else:
                    rows.append((h, own, row, begin, p - a, z - a))
                    blobs.append(context)
        out = []
        if rows:
            packed = np.array(rows, dtype=CONTEXT)
            key = _key(packed["h"], buckets)
            order = np.argsort(key, kind="stable")
            packed, key = packed[order], key[order]
            for b, at in _split(key, buckets):
                # Column by column, for the shuffle's compression.
                data = b"".join([packed[c][at].tobytes() for c in CONTEXT.names])
                out.append((b, g, CONTEXTS, data, b"".join([blobs[k] for k in order[at].tolist()])))
        if windows:
            packed = np.array([(k, *v) for k, same in windows.items() for v in same], dtype=WINDOW)
            bucket = packed["key"].copy().view("<u8").reshape(-1, 2)[:, 0] % np.uint64(buckets)
            for b in np.unique(bucket).tolist():
                out.append((b, g, WINDOWS, packed[bucket == b].tobytes(), None))
        if covered:
            out.append((g % buckets, g, SPANS, np.array(covered, dtype=SPAN).tobytes(), None))
        return _table(out, SENT)

    return send


def _columns(data: bytes) -> dict[str, np.ndarray]:
    n, at, out = len(data) // CONTEXT.itemsize, 0, {}
    for name in CONTEXT.names:
        kind = CONTEXT[name]
        out[name] = np.frombuffer(data, kind, n, at)
        at += n * kind.itemsize
    return out


def _contexts(rows: pa.Table) -> Iterator[list[tuple]]:
    """The (h, piece, doc, row, lo, left, context) of each anchor that has several."""
    found = zip(*(rows[c].to_pylist() for c in NOTES.names), strict=True)
    pieces = [(g, _columns(data), texts) for g, kind, data, texts in found if kind == CONTEXTS]
    if not pieces:
        return
    joined = {c: np.concatenate([p[1][c] for p in pieces]) for c in CONTEXT.names}
    piece = np.repeat(np.arange(len(pieces)), [len(p[1]["h"]) for p in pieces])
    sizes = joined["size"].astype(np.int64)
    begin = np.concatenate([np.cumsum(p[1]["size"].astype(np.int64)) - p[1]["size"] for p in pieces])
    order = np.argsort(joined["h"], kind="stable")
    h = joined["h"][order]
    cuts = np.flatnonzero(np.r_[True, h[1:] != h[:-1], True])
    fields = (piece, *(joined[c] for c in ("doc", "row", "lo", "left")), begin, begin + sizes)
    columns = [x[order].tolist() for x in fields]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b - a > 1:
            yield [
                (pieces[p][0], doc, row, lo, left, pieces[p][2][x:y])
                for p, doc, row, lo, left, x, y in zip(*(c[a:b] for c in columns), strict=True)
            ]


def _groups(contexts: list[tuple], length: int) -> Iterator[tuple[int, int, list[list[tuple]]]]:
    """(bytes before the anchor, bytes from it on, occurrences at each place) of repeat groups.

    A place is a context; several documents may have an equal one.
    """
    places: dict[tuple[int, bytes], list[tuple]] = {}
    for c in contexts:
        places.setdefault((c[4], c[5]), []).append(c)
    for (left, context), same in places.items():
        if len(same) > 1:
            yield left, len(context) - left, [same]
    if len(places) > 1:
        own = list(places)
        left, right = [c[:n][::-1] for n, c in own], [c[n:] for n, c in own]
        for before, after, at in maximal_repeats(left, right, length):
            yield before, after, [places[own[k]] for k in at]


def _cover(length: int):
    def cover(rows: pa.Table) -> pa.Table:
        """The spans of the bucket's repeats that are not in their first document."""
        spans: dict[int, list[tuple[int, int, int]]] = {}
        for contexts in _contexts(rows):
            for before, after, places in _groups(contexts, length):
                first = min(c[1] for same in places for c in same)
                for same in places:
                    for g, doc, row, lo, left, _ in same:
                        if doc > first:
                            spans.setdefault(g, []).append((row, lo + left - before, lo + left + after))
        notes = list(zip(*(rows[c].to_pylist() for c in ("g", "kind", "data")), strict=True))
        held = [(g, np.frombuffer(d, WINDOW)) for g, kind, d in notes if kind == WINDOWS]
        if held:
            every = np.concatenate([w for _, w in held])
            group = np.repeat([g for g, _ in held], [len(w) for _, w in held])
            _, number = np.unique(every["key"], return_inverse=True)
            least = np.full(number.max() + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, number, every["doc"])
            for k in np.flatnonzero(every["doc"] > least[number]).tolist():
                start = int(every["start"][k])
                spans.setdefault(int(group[k]), []).append((int(every["row"][k]), start, start + length))
        out = [(g, SPANS, np.array(s, dtype=SPAN).tobytes(), None) for g, s in spans.items()]
        out += [(g, SPANS, d, None) for g, kind, d in notes if kind == SPANS]
        return _table(out, NOTES)

    return cover


COUNTS = ("doc_id", "n_bytes", "n_removed", "n_spans")
RESULT = pa.schema([*[(c, pa.int64()) for c in COUNTS], ("kept", pa.binary())])


def _remove(length: int, whole: bool):
    def remove(docs: pa.Table, notes: pa.Table) -> pa.Table:
        group = Group(docs, _copies(notes))
        held = [np.frombuffer(d, SPAN) for d, _ in _notes(notes, SPANS)]
        spans = np.concatenate(held) if held else np.zeros(0, dtype=SPAN)
        spans = spans[np.lexsort((spans["start"], spans["row"]))]
        cuts = np.searchsorted(spans["row"], np.arange(len(group.ids) + 1))
        rows = []
        for r, (doc_id, text, copy) in enumerate(zip(group.ids, group.texts, group.copy, strict=True)):
            if copy and len(text) >= length:
                merged = [(0, len(text))]
            else:
                merged = []
                mine = spans[cuts[r] : cuts[r + 1]]
                for a, b in zip(mine["start"].tolist(), mine["end"].tolist(), strict=True):
                    if merged and a <= merged[-1][1]:
                        merged[-1] = (merged[-1][0], max(merged[-1][1], b))
                    else:
                        merged.append((a, b))
            kept, at = [], 0
            for a, b in merged:
                kept.append(text[at:a])
                at = b
            kept.append(text[at:])
            left = b"".join(kept)
            kept_form = left if whole else hashlib.sha256(left).digest()
            rows.append((doc_id, len(text), len(text) - len(left), len(merged), kept_form))
        return _table(rows, RESULT)

    return remove


class Plan:
    """The stages over one exchange of the texts."""

    def __init__(self, docs: DataFrame, length: int, anchor: int, group_bytes: int, bucket_bytes: int, hot: int):
        id_and_body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("body"))
        digest = F.unhex(F.md5("body"))
        texts = materialize(
            id_and_body.select("doc_id", digest.alias("digest"), F.length("body").alias("n")), "text-digests"
        )
        total = texts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
        groups, self.buckets = max(1, -(-total // group_bytes)), max(1, -(-total // bucket_bytes))
        self.parts = max(8, -(-total // PART_BYTES))
        self.length, self.anchor, self.hot = length, anchor, hot

        def number(doc_id, digest):
            return F.pmod(F.xxhash64(doc_id, digest), F.lit(groups)).cast("long")

        self.docs = id_and_body.withColumn("g", number(F.col("doc_id"), digest)).repartition(self.parts, "g")
        # Of texts that several rows have, the smallest id; once for each salt, so that the rows
        # of one text meet it in SALTS tasks.
        of = texts.where("doc_id is not null").groupBy(F.col("digest").alias("of"))
        first = of.agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last")
        first = materialize(first.withColumn("own", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), "first-copies")
        salted = texts.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        met = salted.join(first, (F.col("digest") == F.col("of")) & (F.col("salt") == F.col("own")))
        copies = met.where("doc_id > first").select("doc_id", "digest")
        self.copies = materialize(
            copies.distinct().select(
                number(F.col("doc_id"), F.col("digest")).alias("g"),
                F.lit(COPIES).alias("kind"),
                F.unhex(F.lpad(F.hex("doc_id"), 16, "0")).alias("data"),
                F.col("digest").alias("more"),
            ),
            "copies",
        )

    def with_notes(self, notes: DataFrame, run, schema: str) -> DataFrame:
        return self.docs.groupBy("g").cogroup(notes.repartition(self.parts, "g").groupBy("g")).applyInArrow(run, schema)

    def sent(self, wide: bool = False) -> DataFrame:
        """Contexts, windows and local spans, dealt to buckets."""
        own = self.with_notes(self.copies, _send_anchors(self.length, self.anchor, self.buckets), SENT_SQL)
        shared = own.groupBy("bucket").applyInArrow(_share_anchors(self.hot), NOTES_SQL)
        return self.with_notes(
            shared.union(self.copies), _send_contexts(self.length, self.anchor, self.buckets, wide), SENT_SQL
        )

    def removed(self, whole: bool) -> DataFrame:
        spans = self.sent().groupBy("bucket").applyInArrow(_cover(self.length), NOTES_SQL)
        schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
        return self.with_notes(spans.union(self.copies), _remove(self.length, whole), schema)


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    anchor: int = ANCHOR,
    group_bytes: int = GROUP_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    hot: int = HOT,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, text (the bytes that stay, as a string) of every row."""
    found = Plan(docs, length, anchor, group_bytes, bucket_bytes, hot).removed(True)
    return found.withColumn("text", F.col("kept").cast("string")).drop("kept")


def removal_digests(
    docs: DataFrame, hot: int = HOT, group_bytes: int = GROUP_BYTES, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    found = Plan(docs, LENGTH, ANCHOR, group_bytes, bucket_bytes, hot).removed(False)
    return found.withColumn("kept_sha256", F.lower(F.hex("kept"))).drop("kept")


def repeat_groups(
    docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """anchor, size, members: the maximal repeats around each anchor with all their occurrences.

    A member is (doc_id, start). Repeats end ``length`` bytes from the anchor; a longer one is a
    chain of groups that overlap. Exact copies are represented by their smallest id. The
    occurrences of an anchor meet in one task, as its groups list them all; to remove what
    very many documents share, ``remove_repeats`` has no need of such lists.
    """
    schema = "anchor long, size long, members array<struct<doc_id: long, start: long>>"
    member = pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64())]))
    out_schema = pa.schema([("anchor", pa.int64()), ("size", pa.int64()), ("members", member)])

    def listed(rows: pa.Table) -> pa.Table:
        out = []
        for contexts in _contexts(rows):
            text = contexts[0][5][contexts[0][4] : contexts[0][4] + anchor]
            key = int.from_bytes(hashlib.md5(text).digest()[:8], "little", signed=True)
            for before, after, places in _groups(contexts, length):
                left, context = places[0][0][4:]
                string = context[left - before : left + after]
                # A string is listed at an anchor of its own windows, which all its occurrences have.
                if before not in anchors(string, np.array([len(string)]), length, anchor)[1]:
                    continue
                members = [{"doc_id": c[1], "start": c[3] + c[4] - before} for same in places for c in same]
                out.append((key, before + after, members))
        return _table(out, out_schema)

    plan = Plan(docs, length, anchor, group_bytes, BUCKET_BYTES, 1 << 60)
    return plan.sent(wide=True).groupBy("bucket").applyInArrow(listed, schema)
