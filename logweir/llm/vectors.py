"""Embedding near-duplicates: a subspace pigeonhole join over rotated unit vectors.

Unit vectors with cosine at least ``t`` differ by at most ``2 - 2t`` in squared distance. After
a rotation, which spreads a difference evenly, the dimensions are cut into blocks of about
``WIDTH``; each block gets the part of that budget that its dimensions are of all. Two linked
vectors cannot exceed the budget in every block, so in one block at least they are within it.

Each block is a range join in few dimensions: a grid over its first two dimensions, with cells
as wide as twice the block's radius. A vector lives in one cell and visits those that its
radius reaches, four at most. In a cell, residents meet visitors: squared distance over the
block's dimensions first, then the exact cosine in double precision. A pair counts in the cell
of its smaller id and under the first block whose budget it keeps, so it counts once.

The grid is bounded (unit vectors), so the driver knows the number of vectors in each cell. A
full cell is dealt into chunks; every chunk of residents meets every chunk of visitors in a
task of its own. Identical vectors are one vector with a multiplicity. Of the links, a task
returns a count for each vector and a spanning forest, never all pairs.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components,
and those of a null id, have no link and are their own component (null for a null id);
vectors of different lengths have no link; repeated rows are vectors of their own; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.llm.common import materialize
from logweir.llm.components import components
from logweir.llm.simhash import forest

COSINE = 0.9
WIDTH = 8
#: Vectors of a chunk of a cell; residents and visitors that are compared at once, in cache.
CHUNK = 32_768
TILE = (2048, 256)
#: Candidates that are verified at once.
HELD_PAIRS = 20_000
SLACK = 1e-5
#: What a row is in a cell.
HOME, GUEST, BOTH = range(3)


class Space:
    """Rotation, blocks and budgets for one vector length."""

    def __init__(self, dim: int, cosine: float, seed: int = 9):
        self.rotation = np.linalg.qr(np.random.default_rng([seed, dim]).normal(size=(dim, dim)))[0]
        blocks = max(1, round(dim / WIDTH))
        self.edges = [dim * b // blocks for b in range(blocks + 1)]
        self.budgets = (2 - 2 * cosine) * np.diff(self.edges) / dim
        self.radii = np.sqrt(self.budgets) * (1 + SLACK) + SLACK

    def __len__(self) -> int:
        return len(self.budgets)

    def rotated(self, units: np.ndarray) -> np.ndarray:
        # Rounded, so that a vector has the same coordinates whatever it is multiplied with.
        return np.round(units @ self.rotation, 10)

    def block(self, rotated: np.ndarray, b: int) -> np.ndarray:
        return rotated[:, self.edges[b] : self.edges[b + 1]]

    def cells(self, rotated: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Home, first and last cell over the block's grid dimensions."""
        grid, side = self.block(rotated, b)[:, :2], 2 * self.radii[b]
        if grid.shape[1] < 2:
            grid = np.column_stack([grid, np.zeros(len(grid))])
        at = [np.floor((grid + shift) / side).astype(int) for shift in (0, -self.radii[b], self.radii[b])]
        return at[0], at[1], at[2]

    def first_block(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The first block whose budget each pair keeps."""
        apart = np.add.reduceat((a - b) ** 2, self.edges[:-1], axis=1)
        within = apart <= self.budgets * (1 + 1e-9)
        return np.where(within.any(axis=1), within.argmax(axis=1), apart.argmin(axis=1))


@cache
def space(dim: int, cosine: float) -> Space:
    return Space(dim, cosine)


def units(values: pa.Array, kind: str) -> np.ndarray:
    """Unit vectors in double precision from the bytes of equally long vectors."""
    vectors = np.frombuffer(b"".join(values.to_pylist()), dtype=kind).astype(np.float64).reshape(len(values), -1)
    vectors = vectors / np.abs(vectors).max(axis=1, initial=0, keepdims=True)  # for very large or small components
    return vectors / np.sqrt(np.einsum("nd,nd->n", vectors, vectors))[:, None]


def _keyed(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding, key; the key is null for rows that link with nothing."""
    finite = F.forall(
        "embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))
    ) & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    linkable = F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))
    key = F.when(linkable, F.unhex(F.sha2(F.col("embedding").cast("string").cast("binary"), 256)))
    return materialize(rows.withColumn("key", key), "vector-keys")


def _packed(kind: str):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.array(v.as_py(), dtype=kind) for v in batch["embedding"]]
            size = pa.array([len(x) for x in out], pa.int32())
            data = pa.array([x.tobytes() for x in out], pa.binary())
            columns = [batch["node"], batch["times"], size, data]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "times", "dim", "vector"])

    return pack


def _spread(batch: pa.RecordBatch, cosine: float, kind: str) -> Iterator[tuple[int, int, np.ndarray, tuple[int, int], np.ndarray]]:
    """(dim, block, rows, cell, whether the cell is the row's home) for each cell."""
    dims = batch["dim"].to_numpy()
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        if not len(at):
            continue
        own = space(dim, cosine)
        rotated = own.rotated(units(batch["vector"].take(pa.array(at)), kind))
        for b in range(len(own)):
            home, low, high = own.cells(rotated, b)
            spans = [range(low[:, k].min(), high[:, k].max() + 1) for k in (0, 1)]
            for cell in product(*spans):
                there = ((low <= cell) & (high >= cell)).all(axis=1)
                if there.any():
                    yield dim, b, at[there], cell, (home[there] == cell).all(axis=1)


def _links(
    own: Space, b: int, homes: tuple[np.ndarray, ...], visitors: tuple[np.ndarray, ...], cosine: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, links, smallest node reached) of the nodes that have links here."""
    (home, home_times, home_unit), (guest, guest_times, guest_unit) = homes, visitors
    ids = np.unique(np.concatenate([home, guest]))
    times = np.zeros(len(ids), dtype=np.int64)
    times[np.searchsorted(ids, home)], times[np.searchsorted(ids, guest)] = home_times, guest_times
    count, root = np.zeros(len(ids), dtype=np.int64), np.arange(len(ids))
    home_at, guest_at = np.searchsorted(ids, home), np.searchsorted(ids, guest)
    home_rotated, guest_rotated = own.rotated(home_unit), own.rotated(guest_unit)
    most = np.float32(own.radii[b] ** 2)
    # |x - y|^2 as one product: (-2x, |x|^2, 1) with (y, 1, |y|^2).
    x, y = (own.block(r, b).astype(np.float32) for r in (home_rotated, guest_rotated))
    x2, y2 = (np.einsum("nd,nd->n", v, v)[:, None] for v in (x, y))
    left = np.hstack([-2 * x, x2, np.ones_like(x2)])
    right = np.ascontiguousarray(np.hstack([y, np.ones_like(y2), y2]).T)
    corners = product(range(0, len(home), TILE[0]), range(0, len(guest), TILE[1]))
    for top, start in corners:
        apart = left[top : top + TILE[0]] @ right[:, start : start + TILE[1]]
        near = np.flatnonzero(apart <= most)
        for first in range(0, len(near), HELD_PAIRS):
            i, j = np.divmod(near[first : first + HELD_PAIRS], apart.shape[1])
            i, j = i + top, j + start
            later = home[i] < guest[j]
            i, j = i[later], j[later]
            good = np.einsum("nd,nd->n", home_unit[i], guest_unit[j]) >= cosine
            i, j = i[good], j[good]
            mine = own.first_block(home_rotated[i], guest_rotated[j]) == b
            p, q = home_at[i[mine]], guest_at[j[mine]]
            np.add.at(count, p, times[q])
            np.add.at(count, q, times[p])
            if len(p):
                # Links so far, as each position's root, and the new ones.
                used = np.unique(np.concatenate([p, q, root[p], root[q]]))
                ends = (np.searchsorted(used, np.concatenate(x)) for x in ((p, used), (q, root[used])))
                root[used] = used[forest(len(used), *ends)]
    # A root may have got a smaller root since.
    while not np.array_equal(root, root[root]):
        root = root[root]
    linked = np.flatnonzero(count)
    return ids[linked], count[linked], ids[root[linked]]


def near_vectors(vectors: DataFrame, cosine: float = COSINE, chunk: int = CHUNK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    keyed = _keyed(vectors)
    # Single precision is kept as it is; everything else travels in double precision.
    single = vectors.schema["embedding"].dataType.elementType == T.FloatType()
    kind = "<f4" if single else "<f8"
    grouped = keyed.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("node"), F.count("*").alias("times"), F.first("embedding").alias("embedding")
    )
    nodes = materialize(grouped.select("key", "node", "times"), "vector-nodes")
    packed = grouped.select("node", "times", "embedding").mapInArrow(
        _packed(kind), "node long, times long, dim int, vector binary"
    )
    packed = materialize(packed, "vector-bytes")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(d, b, *cell, int(home.sum()), len(rows)) for d, b, rows, cell, home in _spread(batch, cosine, kind)]
            if found:
                columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["dim", "b", "x", "y", "homes", "guests"])

    place = ["dim", "b", "x", "y"]
    cells = packed.mapInArrow(counted, ", ".join(f"{c} long" for c in [*place, "homes", "guests"]))
    sizes = cells.groupBy(*place).agg(F.sum("homes").alias("homes"), F.sum("guests").alias("guests")).collect()
    chunks = {tuple(r[c] for c in place): (-(-r["homes"] // chunk), -(-r["guests"] // chunk)) for r in sizes}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["node"].to_numpy().astype(np.uint64)
            mixed = ((ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)
            for dim, b, rows, cell, home in _spread(batch, cosine, kind):
                of_homes, of_guests = chunks[dim, b, *cell]
                if not of_homes:
                    continue
                roles = [(HOME, rows[home], of_homes, of_guests), (GUEST, rows, of_guests, of_homes)]
                if of_homes == of_guests == 1:
                    roles = [(BOTH, rows[home], 1, 1), (GUEST, rows[~home], 1, 1)]
                for role, chosen, own_chunks, other_chunks in roles:
                    if not len(chosen):
                        continue
                    taken = batch.take(pa.array(chosen))
                    n, at = len(chosen), mixed[chosen] % own_chunks
                    for other in range(other_chunks):
                        fixed = [np.full(n, v, dtype=np.int64) for v in (dim, b, *cell)]
                        meets = [np.full(n, other), at] if role == GUEST else [at, np.full(n, other)]
                        arrays = [*fixed, *meets, np.full(n, role)]
                        yield pa.RecordBatch.from_arrays(
                            [*map(pa.array, arrays), taken["node"], taken["times"], taken["vector"]], names=spread_names
                        )

    spread_names = [*place, "i", "j", "role", "node", "times", "vector"]
    schema = ", ".join(f"{c} long" for c in [*place, "i", "j"]) + ", role long, node long, times long, vector binary"

    def linked(rows: pa.Table) -> pa.Table:
        b, dim = rows["b"][0].as_py(), rows["dim"][0].as_py()
        sides = []
        for side in ((HOME, BOTH), (GUEST, BOTH)):
            mine = rows.filter(pc.is_in(rows["role"], pa.array(side, pa.int64())))
            data = units(mine["vector"], kind) if len(mine) else np.zeros((0, dim))
            sides.append((mine["node"].to_numpy(), mine["times"].to_numpy(), data))
        node, links, root = _links(space(dim, cosine), b, sides[0], sides[1], cosine)
        return pa.table({"a": node, "links": links, "b": root})

    met = packed.mapInArrow(dealt, schema).groupBy(*place, "i", "j").applyInArrow(linked, "a long, links long, b long")
    found = materialize(met, "vector-links")
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    joined = nodes.join(links, F.col("node") == F.col("a"), "left").drop("a")
    reached = components(found.select("a", "b")).withColumnRenamed("node", "of")
    of_node = joined.join(reached, F.col("node") == F.col("of"), "left")
    of_node = of_node.select(
        F.col("key").alias("of_key"),
        (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
        F.coalesce("component", "node").alias("component_id"),
    )
    of_key = materialize(of_node, "vector-components")
    in_class = keyed.where("key is not null").join(of_key, F.col("key") == F.col("of_key"))
    alone = keyed.where("key is null").select("vec_id", F.lit(0).cast("long"), "vec_id")
    every = in_class.select("vec_id", "n_links", "component_id").union(alone)
    return every.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
