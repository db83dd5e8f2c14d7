"""Recompression of sequences into a run-length grammar, and longest common extensions by it.

Rounds alternate between two ways of naming. Block compression names every maximal block of one
symbol; pair compression deals the symbols into left and right ones by a digest and names every
left one with the right one behind it. A round looks at a symbol and its neighbour only, so
equal stretches are named alike but for their edges, and about a quarter of the symbols go in
each pair round. Rounds end when no symbol occurs twice. The levels together hold a small
multiple of the input.

An extension compares two places level by level: upwards while both stand at the border of a
name, over at most one symbol (pairs) or the shorter block (blocks) a level, then downwards
into the names that differ. The number of steps is the number of levels, whatever the length
of the extension. All queries of a call go through the levels together.

The same levels read backwards are those of the reversed sequence and answer extensions to
the left.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Level:
    """Symbols of one level and, below a further level, the name over each.

    ``children`` is where a name's symbols begin, with the end as last entry; ``blocks`` says
    which round made the names.
    """

    symbols: np.ndarray
    parent: np.ndarray | None = None
    children: np.ndarray | None = None
    blocks: bool = False

    def reversed(self) -> Level:
        if self.parent is None:
            return Level(self.symbols[::-1])
        names = len(self.children) - 1
        return Level(
            self.symbols[::-1],
            (names - 1 - self.parent)[::-1],
            (len(self.symbols) - self.children)[::-1],
            self.blocks,
        )


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A bit for each symbol (the finaliser of a public 64-bit generator)."""
    z = x.astype(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) & np.uint64(1)).astype(bool)


def _named(symbols: np.ndarray, starts: np.ndarray, blocks: bool) -> np.ndarray:
    """A number for each group of symbols, equal for equal groups."""
    sizes = np.diff(np.append(starts, len(symbols)))
    first = symbols[starts].astype(np.int64)
    if blocks:
        second = sizes
    else:
        second = np.where(sizes == 2, symbols[np.minimum(starts + 1, len(symbols) - 1)] + 1, 0)
    # Symbols are numbered densely, so the pair fits.
    keys = first * (int(second.max()) + 1) + second
    return np.unique(keys, return_inverse=True)[1]


class Grammar:
    """Extensions within a sequence of dense numbers from 0."""

    def __init__(self, symbols: np.ndarray):
        # Symbols of their own at both ends: no comparison runs over them.
        ends = int(symbols.max(initial=-1)) + 1
        at = np.concatenate([[ends], symbols, [ends + 1]]).astype(np.int64)
        self.size = len(at)
        self.levels: list[Level] = []
        turn = 0
        while int(at.max()) + 1 < len(at):
            blocks = turn % 2 == 0
            if blocks:
                inner = at[1:] == at[:-1]
            else:
                right = _mixed(at, turn)
                inner = ~right[:-1] & right[1:]
            turn += 1
            if not inner.any():
                continue
            begins = np.concatenate([[True], ~inner])
            starts = np.flatnonzero(begins)
            self.levels.append(Level(at, np.cumsum(begins) - 1, np.append(starts, len(at)), blocks))
            at = _named(at, starts, blocks)
        self.levels.append(Level(at))
        self.mirrored = [level.reversed() for level in self.levels]

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from a and from b on are equal; a and b differ."""
        return _common(self.levels, a + 1, b + 1)

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols before a and before b are equal; a and b differ."""
        return _common(self.mirrored, self.size - 1 - a, self.size - 1 - b)


def _common(levels: list[Level], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How far the places a and b of the lowest level agree."""
    origin = a
    live = np.arange(len(a))
    a, b = a.astype(np.int64).copy(), b.astype(np.int64).copy()
    stopped = np.zeros(len(a), np.int64)
    for depth, level in enumerate(levels):
        x, y = a[live], b[live]
        differ = level.symbols[x] != level.symbols[y]
        stopped[live[differ]] = depth
        live, x, y = live[~differ], x[~differ], y[~differ]
        if level.parent is None or not len(live):
            break
        begin = level.children[level.parent[x]] == x
        begin &= level.children[level.parent[y]] == y
        inside = np.flatnonzero(~begin)
        if len(inside):
            x[inside], y[inside], ended = _over(level, x[inside], y[inside])
            at = live[inside[ended]]
            a[at], b[at], stopped[at] = x[inside[ended]], y[inside[ended]], depth
            keep = np.ones(len(live), bool)
            keep[inside[ended]] = False
            live, x, y = live[keep], x[keep], y[keep]
        a[live], b[live] = level.parent[x], level.parent[y]
    # Down again: the names at the places differ.
    for depth in range(len(levels) - 1, 0, -1):
        at = np.flatnonzero(stopped >= depth)
        if not len(at):
            continue
        below = levels[depth - 1]
        x, y = below.children[a[at]], below.children[b[at]]
        same = below.symbols[x] == below.symbols[y]
        if below.blocks:
            sizes = np.minimum(below.children[a[at] + 1] - x, below.children[b[at] + 1] - y)
            step = np.where(same, sizes, 0)
        else:
            step = same.astype(np.int64)
        a[at], b[at] = x + step, y + step
    return a - origin


def _over(level: Level, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Advance equal places, not both at a border, to the next common border or difference."""
    if level.blocks:
        left, right = level.children[level.parent[x] + 1] - x, level.children[level.parent[y] + 1] - y
        step = np.minimum(left, right)
        return x + step, y + step, left != right
    x, y = x + 1, y + 1
    ended = level.symbols[x] != level.symbols[y]
    # Behind an equal symbol both are at a border or neither is; a pair has two symbols.
    step = (~ended & (level.children[level.parent[x]] != x)).astype(np.int64)
    return x + step, y + step, ended
