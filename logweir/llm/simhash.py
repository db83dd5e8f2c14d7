"""SimHash near-duplicates: fingerprints, pigeonhole blocks, exact Hamming check, components.

A fingerprint of 64 bits is cut into ``distance + 3`` blocks. Two fingerprints with at most
``distance`` different bits agree on three blocks at least, so they meet under one of the
keys made of three blocks; every pair that meets is checked bit by bit. A pair is looked at
only under the first key that it shares. Only distinct fingerprints are joined, and of the
links under one key just enough are kept to connect what they connect.

A key with more than ``GROUP`` fingerprints is dealt into chunks; each two chunks meet in a
task of their own, so no task holds a whole hot key.

Defined results: a text without words has fingerprint 0 and links like any other; rows with
a null id get a fingerprint, no link and a null component; repeated rows share a component;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweir.llm.common import materialize, utf8
from logweir.llm.components import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
BITS = 64
#: Fingerprints of a key that one task compares.
GROUP = 1024
#: Shingles and rows that a worker holds at once.
HELD_SHINGLES = 200_000
HELD_ROWS = 100_000

#: For each byte, its bits in eight lanes of a byte each: sums of up to 255 fit.
_LANES = np.array([sum((b >> i & 1) << 8 * i for i in range(8)) for b in range(256)], dtype=np.uint64)


def shingle_hashes(text: bytes, width: int = SHINGLE) -> list[int]:
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    spans = zip(starts[: len(words) - width + 1].tolist(), (ends[width - 1 :] - 1).tolist(), strict=True)
    return [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans]


def majority(hashes: list[list[int]]) -> np.ndarray:
    """For each list the bits that are set in more than half; 0 for an empty list."""
    out = np.zeros(len(hashes), dtype=np.uint64)
    full = [i for i, h in enumerate(hashes) if h]
    if not full:
        return out
    counts = np.array([len(hashes[i]) for i in full])
    values = np.concatenate([np.array(hashes[i], dtype="<u8") for i in full])
    ends = np.cumsum(counts)
    runs = [range(e - n, e, 255) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
    lanes = np.add.reduceat(_LANES[values.view(np.uint8).reshape(-1, 8)], [s for r in runs for s in r], axis=0)
    firsts = np.cumsum([0, *[len(r) for r in runs[:-1]]])
    ones = np.add.reduceat(lanes.astype("<u8").view(np.uint8).reshape(-1, BITS).astype(np.int64), firsts, axis=0)
    out[full] = np.packbits(2 * ones > counts[:, None], axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(docs: DataFrame, width: int = SHINGLE, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` (longs) and fp: the fingerprint as a signed long."""
    names = list(carry)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            own = pa.Table.from_batches(taken).combine_chunks()
            columns = [own[c].combine_chunks() for c in names]
            return pa.RecordBatch.from_arrays([*columns, pa.array(majority(hashes).view(np.int64))], names=[*names, "fp"])

        taken, hashes, held = [], [], 0
        for batch in batches:
            done = 0
            for i, body in enumerate(batch["body"], 1):
                found = shingle_hashes(body.as_py(), width)
                hashes.append(found)
                held += len(found) + 1
                if held > HELD_SHINGLES or i == len(batch):
                    taken.append(batch.select(names).slice(done, i - done))
                    done = i
                if held > HELD_SHINGLES:
                    yield flush()
                    taken, hashes, held = [], [], 0
        if hashes:
            yield flush()

    rows = docs.select(*[F.col(c).cast("long").alias(c) for c in names], utf8("text").alias("body"))
    return rows.mapInArrow(made, ", ".join(f"{c} long" for c in [*names, "fp"]))


def block_masks(blocks: int) -> list[int]:
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]


def key_masks(distance: int) -> list[int]:
    """One mask for each choice of three blocks, in lexical order of the choices."""
    return [a | b | c for a, b, c in combinations(block_masks(distance + 3), 3)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def close_pairs(
    group: np.ndarray, key: np.ndarray, chunk: np.ndarray, across: np.ndarray, fp: np.ndarray, distance: int
) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) of pairs of one group within ``distance``, each under its first key.

    Rows are sorted by group. Where ``across`` is set, only pairs of different chunks count.
    """
    blocks = [np.uint64(m) for m in block_masks(distance + 3)]
    choice = {c: k for k, c in enumerate(combinations(range(len(blocks)), 3))}
    table = np.full((1 << len(blocks),), -1)
    for equal in range(1 << len(blocks)):
        first = [b for b in range(len(blocks)) if equal >> b & 1][:3]
        if len(first) == 3:
            table[equal] = choice[tuple(first)]
    last = np.searchsorted(group, group, side="right") - 1
    at, step, found = np.arange(len(group)), 0, []
    while True:
        step += 1
        at = at[last[at] >= at + step]
        if not len(at):
            break
        other = at + step
        differ = fp[at] ^ fp[other]
        good = (np.bitwise_count(differ) <= distance) & (~across[at] | (chunk[at] != chunk[other]))
        i, j, differ = at[good], other[good], differ[good]
        if len(i):
            equal = np.zeros(len(i), dtype=np.int64)
            for b, m in enumerate(blocks):
                equal |= ((differ & m) == 0).astype(np.int64) << b
            mine = table[equal] == key[i]
            found.append((i[mine], j[mine]))
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest position that each of ``n`` positions reaches over the pairs."""
    root = np.arange(n)
    while len(i):
        least = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, least)
        np.minimum.at(root, j, least)
        root = root[root]
        if np.array_equal(before, root):
            break
    return root


def links(classes: DataFrame, distance: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """``classes`` (fp, node), one row for each fingerprint -> links (a, b) between nodes."""
    masks = F.array(*[F.lit(_signed(m)) for m in key_masks(distance)])
    held = F.transform(masks, lambda m: F.col("fp").bitwiseAND(m))
    keyed = classes.select("fp", "node", F.posexplode(held).alias("k", "v"))
    hot = keyed.groupBy("k", "v").count().where(F.col("count") > group)
    hot = materialize(hot.select("k", "v", F.ceil(F.col("count") / group).cast("int").alias("chunks")), "hot-blocks")
    dealt = keyed.join(hot, ["k", "v"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = dealt.withColumn("other", other).select(
        "k", "v", F.least("chunk", "other").alias("x"), F.greatest("chunk", "other").alias("y"), "chunk", "fp", "node"
    )
    place = ["k", "v", "x", "y"]

    def linked(rows: pa.Table) -> pa.RecordBatch:
        column = {c: rows[c].to_numpy() for c in rows.column_names}
        new = np.zeros(len(rows), dtype=bool)
        for c in place:
            new[1:] |= column[c][1:] != column[c][:-1]
        i, j = close_pairs(
            np.cumsum(new), column["k"], column["chunk"], column["x"] != column["y"], column["fp"].view(np.uint64), distance
        )
        root = forest(len(rows), i, j)
        at = np.flatnonzero(root != np.arange(len(rows)))
        return pa.RecordBatch.from_pydict({"a": column["node"][at], "b": column["node"][root[at]]})

    def by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < HELD_ROWS:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            # The last group may go on in the next batch.
            same = np.ones(len(rows), dtype=bool)
            for c in place:
                values = rows[c].to_numpy()
                same &= values == values[-1]
            whole = len(rows) - int(same.sum())
            if whole:
                yield linked(rows.slice(0, whole).combine_chunks())
            held = rows.slice(whole).combine_chunks().to_batches()
        if held:
            yield linked(pa.Table.from_batches(held).combine_chunks())

    sorted_rows = dealt.repartition(*place).sortWithinPartitions(*place)
    return sorted_rows.mapInArrow(by_group, "a long, b long")


def near_copies(docs: DataFrame, width: int = SHINGLE, distance: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row."""
    marked = materialize(fingerprints(docs, width), "fingerprints")
    nodes = marked.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node"))
    classes = materialize(nodes, "fingerprint-classes")
    joined = classes.join(components(links(classes, distance, group)), "node", "left")
    of_class = materialize(
        joined.select(F.col("fp").alias("__fp"), F.coalesce("component", "node").alias("component")), "class-components"
    )
    component = F.when(F.col("doc_id").isNotNull(), F.col("component"))
    return marked.join(of_class, F.col("fp") == F.col("__fp"), "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        component.alias("component_id"),
    )


def drop_near_copies(docs: DataFrame, width: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each group of linked texts; rows with a null id stay.

    Texts are linked, not ids: unlike texts under one id are in groups of their own. Of a group
    the row with the smallest id stays, of several texts of that id one by a digest, and of rows
    that are the same text one.
    """
    doc_id, digest = F.col("doc_id").cast("long"), F.xxhash64(utf8("text"))
    known = docs.where("doc_id is not null")
    rows = known.select(doc_id.alias("doc_id"), "text", digest.alias("__digest"))
    marked = materialize(fingerprints(rows, width, ("doc_id", "__digest")), "fingerprints")
    classes = marked.select("fp", F.col("fp").alias("node")).distinct()
    linked = components(links(materialize(classes, "fingerprint-classes"), distance))
    of_row = marked.join(linked, F.col("fp") == F.col("node"), "left")
    of_row = of_row.withColumn("component", F.coalesce("component", "fp"))
    first = of_row.groupBy("component").agg(F.min(F.struct("doc_id", "__digest")).alias("first"))
    kept = materialize(first.select(F.col("first.doc_id").alias("__kept"), F.col("first.__digest").alias("__same")), "kept-texts")
    chosen = known.join(kept, (doc_id == F.col("__kept")) & (digest == F.col("__same")))
    order = Window.partitionBy("__kept", "__same").orderBy("text")
    chosen = chosen.withColumn("__row", F.row_number().over(order)).where("__row = 1")
    return chosen.select(*docs.columns).union(docs.where("doc_id is null"))
